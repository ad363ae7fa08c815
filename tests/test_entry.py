import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import rows

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "labels", "conversations", "benchmark"]


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["thread", "tag", "count", "weight", "rank"]


def norm(v):
    return f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("key", ["token_counts", "clean_data", "tfidf", "naive_bayes", "auto_tag", "knn_classify",
                                 "strip_html", "nb_gridsearch", "kfold_summary", "topic_relevance"])
def test_oracle_parity_sf0001(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sp = E.queries()[key](spark, SF).toPandas()
    dk = con.execute(E.oracle_sql()[key]).df()
    cols = sorted(sp.columns)
    assert cols == sorted(dk.columns)
    a = sorted(tuple(norm(x) for x in r) for r in sp[cols].itertuples(index=False))
    b = sorted(tuple(norm(x) for x in r) for r in dk[cols].itertuples(index=False))
    assert a == b


def test_partition_invariance(spark):
    q = E.queries()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    out = {}
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out[n] = [rows(q[k](spark, SF)) for k in ("token_counts", "thread_tag_weights", "similar_by_word")]
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out["1"] == out["8"]

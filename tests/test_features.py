import math

from pyspark.sql import functions as F

from tagloom.operators import features
from conftest import rows


def test_tfidf_smooth_idf_l2(spark):
    df = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["b", "c"])], "id long, tokens array<string>")
    tf = features.bag_of_words(df)
    got = {(r["id"], r["term"]): r["tfidf"] for r in features.tfidf(tf).collect()}
    ia, ib = math.log(3 / 2) + 1, math.log(3 / 3) + 1
    w1 = {"a": 2 * ia, "b": ib}
    n1 = math.sqrt(sum(v * v for v in w1.values()))
    assert abs(got[(1, "a")] - w1["a"] / n1) < 1e-12
    assert abs(got[(1, "b")] - w1["b"] / n1) < 1e-12
    w2 = {"b": ib, "c": ia}
    n2 = math.sqrt(sum(v * v for v in w2.values()))
    assert abs(got[(2, "c")] - w2["c"] / n2) < 1e-12


def test_tfidf_vectors_match_long_form(spark):
    df = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["b", "c"])], "id long, tokens array<string>")
    cv, transform = features.tfidf_vectors(df)
    vocab = cv.vocabulary
    vec = {r["id"]: r["features"].toArray() for r in transform(df).collect()}
    long = {(r["id"], r["term"]): r["tfidf"] for r in features.tfidf(features.bag_of_words(df)).collect()}
    for (i, t), v in long.items():
        assert abs(vec[i][vocab.index(t)] - v) < 1e-9


def test_bag_from_text(spark):
    df = spark.createDataFrame([(1, "Bb a, a!")], "id long, text string")
    tf = features.bag_of_words(df, text_col="text", tokens_col=None)
    assert rows(tf) == [(1, "bb", 1)]  # "a" is shorter than 2 characters


def test_tag_matrices_and_shape(spark):
    df = spark.createDataFrame([(1, ["x", "y", "x"]), (2, ["z"])], "id long, tokens array<string>")
    vocab = spark.createDataFrame([("x",), ("z",), ("q",)], "term string")
    assert rows(features.tags_in_post(df, vocab)) == [(1, "x"), (2, "z")]
    assert rows(features.tag_freq_in_post(df, vocab)) == [(1, "x", 2), (2, "z", 1)]
    shape = features.matrix_shape(features.bag_of_words(df), n_rows=3).first().asDict()
    assert shape == {"n_docs": 3, "n_terms": 3, "nnz": 3, "density": round(3 / 9, 6)}


def test_subsample_deterministic(spark):
    df = spark.createDataFrame([(1, ["a"] * 50 + ["b"]), (2, ["a", "c"])], "id long, tokens array<string>")
    a = rows(features.subsample_tokens(df, sample=1e-3, seed=7))
    b = rows(features.subsample_tokens(df, sample=1e-3, seed=7))
    assert a == b
    keep_all = {r["id"]: r["tokens"] for r in features.subsample_tokens(df, sample=10.0).collect()}
    assert keep_all[2] == ["a", "c"] and len(keep_all[1]) == 51


def test_subsample_in_place(spark):
    """Each token against its own hash draw; null and empty arrays stay as empty ones, repeated ids stay apart."""
    import hashlib

    data = [(1, ["a"] * 50 + ["b"]), (2, ["a", "c", None]), (3, None), (4, []), (2, ["b", "a"])]
    df = spark.createDataFrame(data, "id long, tokens array<string>")
    n = sum(len(t or []) for _, t in data)
    share = {w: sum((t or []).count(w) for _, t in data) / n for w in "abc"}
    draw = lambda i, pos: int(hashlib.md5(f"7|{i}:{pos}".encode()).hexdigest()[:8], 16) / 2**32
    keep = lambda w: 1.0 if w is None else min(1, math.sqrt(0.1 / share[w]) + 0.1 / share[w])
    want = [(i, [w for pos, w in enumerate(t or []) if draw(i, pos) < keep(w)]) for i, t in data]
    got = [(r.id, r.tokens) for r in features.subsample_tokens(df, sample=0.1, seed=7).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and want[0] != data[0]


def test_bags_need_no_shuffle(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b", None]), (2, []), (3, None)], "id long, tokens array<string>")
    tf = features.bag_of_words(df)
    assert {tuple(r) for r in tf.collect()} == {(1, None, 1), (1, "a", 1), (1, "b", 2)}
    assert "Exchange" not in tf._jdf.queryExecution().executedPlan().toString()


def test_large_vocabularies_give_the_same(spark, monkeypatch):
    """Joins by key, frequent terms apart, against the small vocabulary's plan."""
    data = [(i, ["hot"] * (i % 3 + 1) + [f"t{j}" for j in range(i % 17)] + [f"u{i}"]) for i in range(200)]
    df = spark.createDataFrame(data, "id long, tokens array<string>")
    vocab = spark.createDataFrame([("hot",), ("t3",), ("u7",), ("absent",), (None,)], "term string")
    ask = lambda: (rows(features.tfidf(features.bag_of_words(df))), rows(features.tags_in_post(df, vocab)), rows(features.tag_freq_in_post(df, vocab)))
    small = ask()
    monkeypatch.setattr(features.small_terms, "__defaults__", ("term", -1))
    large = ask()
    assert small[1:] == large[1:] and [r[:3] for r in small[0]] == [r[:3] for r in large[0]]
    assert max(abs(a[4] - b[4]) for a, b in zip(small[0], large[0])) < 1e-12


def test_no_task_gets_the_hot_term(spark, monkeypatch):
    """A term that every document has, no adaptive execution: what a shuffle task reads stays level."""
    from pyspark.sql import functions as F

    from tagloom.operators.skew import heavy_join

    df = spark.range(4000, numPartitions=8).select("id", F.array(F.lit("hot"), F.concat(F.lit("t"), (F.col("id") % 900).cast("string"))).alias("tokens"))
    bag = features.bag_of_words(df)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        idf = features.inverse_document_frequency(features.document_frequency(bag), 4000)
        parts = heavy_join(bag, idf, "term", F.col("df")).groupBy(F.spark_partition_id().alias("p")).count().collect()
        sizes = sorted(r["count"] for r in parts)
        assert sum(sizes) == 8000 and sizes[-1] < 3 * sizes[len(sizes) // 2]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")

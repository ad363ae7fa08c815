from pyspark.sql import functions as F

from tagloom.operators import profile
from conftest import rows


def test_counts_topk_ties_skip_rarest(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, [])], "id long, tokens array<string>")
    c = profile.token_counts(df)
    assert rows(c) == [("a", 2), ("b", 2), ("c", 1)]
    assert rows(profile.top_tokens(c, 2), "term", "rank") == [("a", 1), ("b", 2)]
    assert rows(profile.top_tokens(c, 2, skip=1), "term", "rank") == [("b", 2), ("c", 3)]
    assert rows(profile.rarest_terms(c, 1), "term") == [("c",)]


def test_thread_tag_weights(spark):
    df = spark.createDataFrame([(1, "x", ["a", "b"]), (2, "x", ["a"]), (3, "y", ["c"])],
                               "id long, thread string, tags array<string>")
    out = rows(profile.thread_tag_weights(df, n=1), "thread", "tag", "count", "weight", "rank")
    assert out == [("x", "a", 2, 1.0, 1), ("y", "c", 1, 1.0, 1)]
    out2 = rows(profile.thread_tag_weights(df, n=5), "thread", "tag", "weight")
    assert ("x", "b", 0.5) in out2


def test_thread_tag_weights_plans_group_limit(spark):
    df = spark.createDataFrame([(1, "x", ["a"])], "id long, thread string, tags array<string>")
    plan = profile.thread_tag_weights(df, n=3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_pos_frequency_and_ratio(spark):
    toks = spark.createDataFrame([(1, "x", ["run", "dog", "zz"]), (2, "y", ["dog"])],
                                 "id long, thread string, tokens array<string>")
    lex = spark.createDataFrame([("run", "VERB"), ("dog", "NOUN")], "token string, pos string")
    pf = profile.pos_frequency(toks, lex)
    assert ("ALL", "NOUN", 2) in rows(pf)
    assert ("x", "X", 1) in rows(pf)
    r = {x["thread"]: x["verb_noun_ratio"] for x in profile.verb_noun_ratio(pf).collect()}
    assert r == {"ALL": 0.5, "x": 1.0, "y": 0.0}


def test_corpus_summary_and_doc_bag(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["t"]), (2, ["a"], ["t", "u"])],
                               "id long, tokens array<string>, tags array<string>")
    s = profile.corpus_summary(df).first().asDict()
    assert s == {"n_docs": 2, "n_unique_tags": 2, "n_unique_words": 2, "n_tokens": 3}
    d = spark.createDataFrame([(1, "A a A")], "id long, text string")
    assert rows(profile.doc_bag(d, "text")) == [(1, "A", 2), (1, "a", 1)]
    m = profile.doc_bag(d, "text", as_map=True).first()["bag"]
    assert m == {"A": 2, "a": 1}


def test_corpus_summary_edge_rows(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"], ["t"]), (2, [], None), (3, ["b"], ["t", "u"]), (4, None, [])],
                               "id long, tokens array<string>, tags array<string>")
    exact = profile.corpus_summary(df).first().asDict()
    assert exact == {"n_docs": 4, "n_unique_tags": 2, "n_unique_words": 2, "n_tokens": 4}
    assert profile.corpus_summary(df, approx=True).first().asDict() == exact

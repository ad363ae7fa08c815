from pyspark.sql import functions as F

from tagloom.functions import text as T


def one(spark, value, fn):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(fn("t").alias("o")).first()["o"]


def test_corpus_tokens_unicode_and_min_length(spark):
    assert one(spark, "Hello, World! café 你好 a_b x 42", T.corpus_tokens) == ["hello", "world", "café", "你好", "a_b", "42"]
    assert one(spark, "", T.corpus_tokens) == []
    assert one(spark, "!!! ...", T.corpus_tokens) == []


def test_title_content_split(spark):
    assert one(spark, "t\nc1\nc2", T.first_line) == "t"
    assert one(spark, "t\nc1\nc2", T.after_first_line) == "c1\nc2"
    assert one(spark, "only", T.after_first_line) == ""
    assert one(spark, None, T.first_line) is None
    assert one(spark, None, T.after_first_line) == ""


def test_repair_encoding(spark):
    assert one(spark, "cafÃ©", T.repair_encoding) == "café"
    assert one(spark, "café", T.repair_encoding) == "café"
    assert one(spark, "你好", T.repair_encoding) == "你好"
    assert one(spark, "plain", T.repair_encoding) == "plain"
    assert one(spark, None, T.repair_encoding) is None


def test_delimiters_punctuation_tokens(spark):
    assert one(spark, '[a],"b\'c', T.strip_delimiters) == " a   b c"
    assert one(spark, "q?<p>I am</p>", T.remove_punctuation) == "q p I am p "
    assert one(spark, "q?<p>I am</p>", T.clean_text) == ["q", "p", "I", "am", "p"]
    assert one(spark, "  a \t b\n", T.whitespace_tokens) == ["a", "b"]
    assert one(spark, "", T.whitespace_tokens) == []


def test_strip_html(spark):
    html = ('<html><head><title>T &amp; U</title><style>x{}</style><script>var a="</p>";</script></head>'
            '<body><p>Hello<b>World</b></p><!-- hidden --> &lt;ok&gt; &quot;q&quot;</body></html>')
    assert one(spark, html, T.strip_html) == 'T & U Hello World <ok> "q"'
    assert one(spark, html, T.html_title) == "T & U"
    assert one(spark, "&amp;lt;", T.unescape_entities) == "&lt;"


def test_joined_empty(spark):
    df = spark.createDataFrame([([],), (None,), (["a", "b"],)], "x array<string>")
    assert sorted(r[0] for r in df.select(T.joined("x")).collect()) == ["", "", "a b"]


def test_repair_encoding_mends_runs_only(spark):
    import duckdb
    from pyspark.sql import functions as F

    from oracle.duckdb_sql import repair
    from tagloom.functions.text import repair_encoding

    pairs = [("itâ€™s cafÃ©", "it’s café"), ("cafÃ© “ok” 你好", "café “ok” 你好"), ("café", "café"), ("Ã", "Ã"),
             ("à€€ Ã©\nÃ¼", "à€€ é\nü"), ("", ""), (None, None)]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], "i int, t string")
    got = {r["i"]: r["u"] for r in df.select("i", repair_encoding(F.col("t")).alias("u")).collect()}
    assert [got[i] for i in range(len(pairs))] == [b for _, b in pairs]
    for a, b in pairs:
        assert duckdb.execute(f"SELECT {repair('t')} FROM (SELECT ?::VARCHAR AS t)", [a]).fetchall() == [(b,)]

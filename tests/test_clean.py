from pyspark.sql import functions as F

from tagloom.operators import clean
from conftest import rows


def test_remove_stopwords(spark):
    df = spark.createDataFrame([(1, ["the", "Cat", "und", "zebra"])], "id long, tokens array<string>")
    assert clean.remove_stopwords(df, "tokens").first()["tokens"] == ["Cat", "zebra"]
    stops = spark.createDataFrame([("zebra",)], "word string")
    assert clean.remove_stopwords(df, "tokens", stops).first()["tokens"] == ["the", "Cat", "und"]
    words = clean.default_stop_words()
    assert "the" in words and "und" in words and "et" in words and len(words) > 2000


def test_entity_and_lemma_chain(spark):
    df = spark.createDataFrame([(1, ["Paris", "cats", "Dogs", "may"])], "id long, tokens array<string>")
    ents = spark.createDataFrame([("paris", "GPE"), ("may", "DATE")], "phrase string, type string")
    assert clean.entity_uppercase(df, ents).first()["tokens"] == ["PARIS", "cats", "dogs", "may"]
    lem = spark.createDataFrame([("cats", "noun", "cat"), ("cat", "verb", "ca"), ("dogs", "verb", "dog")],
                                "form string, pos string, lemma string")
    # noun pass then verb pass on its result; case-sensitive forms
    assert clean.lemmatize(df, lem).first()["tokens"] == ["Paris", "ca", "Dogs", "may"]


def test_clean_data_keeps_empty_documents(spark):
    df = spark.createDataFrame([(1, "<p>The cat</p>"), (2, "the"), (3, None), (4, "")], "id long, t string")
    stops = spark.createDataFrame([("the",)], "word string")
    out = {r["id"]: r["tokens"] for r in clean.clean_data(df, "t", stop_words=stops, lemmatize=False).collect()}
    assert out == {1: ["cat"], 2: [], 3: [], 4: []}


def test_legacy_order_strips_html_last(spark):
    df = spark.createDataFrame([(1, "<b>Cat</b> sat")], "id long, t string")
    default = clean.clean_data(df, "t", rem_stopwords=False, ner=False, lemmatize=False).first()["tokens"]
    legacy = clean.clean_data(df, "t", rem_stopwords=False, ner=False, lemmatize=False,
                              order="legacy").first()["tokens"]
    assert default == ["Cat", "sat"] and legacy == ["Cat", "sat"]


def test_prepare_posts_and_variants(spark):
    posts = spark.createDataFrame([(1, "x", "Big title", "some content", ["title"])],
                                  "id long, thread string, title string, content string, tags array<string>")
    lem = spark.createDataFrame([("content", "noun", "conten")], "form string, pos string, lemma string")
    p = clean.prepare_posts(posts, title_weight=2, rem_stopwords=False, ner=True, lemmatize=True, lemmas=lem).first()
    assert p["tokens"] == ["big", "title", "big", "title", "some", "conten"]
    assert p["tags"] == ["title"]
    v = clean.prep_variants(posts, stop_words=["some"], lemmas=lem)
    assert v.count() == 8
    got = {r["config"]: r["n_tokens"] for r in v.collect()}
    assert got["stop1_ner0_lemma0"] == 7 and got["stop0_ner0_lemma0"] == 8


def test_inline_and_join_plans_agree(spark, monkeypatch):
    """Small lexicons run as narrow array steps; larger ones as explode + join + rebuild. Same tokens either way."""
    df = spark.createDataFrame(
        [(1, "<p>Paris cats</p> the Dogs may cats"), (2, "the"), (3, None), (4, ""), (5, "café CATS dogs")],
        "id long, t string")
    ents = spark.createDataFrame([("paris", "GPE"), ("may", "DATE")], "phrase string, type string")
    stops = spark.createDataFrame([("the",), ("may",)], "word string")
    lem = spark.createDataFrame([("cats", "noun", "cat"), ("cat", "verb", "ca"), ("dogs", "verb", "dog")],
                                "form string, pos string, lemma string")

    def run():
        out = {}
        for order in ("default", "legacy"):
            res = clean.clean_data(df, "t", stop_words=stops, entities=ents, lemmas=lem, order=order)
            out[order] = {r["id"]: r["tokens"] for r in res.collect()}
        return out

    inline = run()
    monkeypatch.setattr(clean, "INLINE_LEXICON_ROWS", 0)
    assert clean.inline_lexicons(entities=ents) is None
    joined = run()
    assert inline == joined
    assert inline["default"][1] == ["PARIS", "ca", "dog", "ca"]
    assert inline["default"][3] == [] and inline["default"][2] == []


def test_prep_variants_one_pass_equals_per_config(spark):
    posts = spark.createDataFrame(
        [(1, "en", "Paris cats", "the Dogs <b>may</b> cats", ["paris"]), (2, "fr", "the", "", []),
         (3, "en", None, None, []), (4, "de", "café", "CATS dogs dogs", ["cafe"])],
        "id long, thread string, title string, content string, tags array<string>")
    ents = spark.createDataFrame([("paris", "GPE"), ("may", "DATE")], "phrase string, type string")
    stops = spark.createDataFrame([("the",), ("may",)], "word string")
    lem = spark.createDataFrame([("cats", "noun", "cat"), ("dogs", "verb", "dog")], "form string, pos string, lemma string")
    grid = [(s, n, l) for s in (True, False) for n in (True, False) for l in (True, False)]
    one = {r["config"]: r.asDict() for r in clean.prep_variants(posts, stops, ents, lem).collect()}
    per = {r["config"]: r.asDict() for r in clean._prep_variants_per_config(posts, stops, ents, lem, 3, grid).collect()}
    assert one == per and len(one) == 8


def test_null_tokens_repeated_ids_and_ambiguous_lemmas(spark, monkeypatch):
    df = spark.createDataFrame([(1, ["Cat"]), (1, ["a", "Dog"]), (2, ["leaves", "fall"]), (3, None), (3, None)],
                               "id long, tokens array<string>")
    lem = spark.createDataFrame([("leaves", "noun", "leave"), ("leaves", "noun", "leaf"), ("fall", "noun", None)],
                                "form string, pos string, lemma string")
    ents = spark.createDataFrame([("dog", None), ("cat", "DATE")], "phrase string, type string")
    stops = spark.createDataFrame([("a",), (None,)], "word string")

    def run():
        return [rows(clean.lemmatize(df, lem)), rows(clean.entity_uppercase(df, ents)),
                rows(clean.remove_stopwords(df, "tokens", stops), "id", "tokens")]

    inline = run()
    assert inline[0] == [(1, ["Cat"]), (1, ["a", "Dog"]), (2, ["leaf", "fall"]), (3, []), (3, [])]
    assert inline[1] == [(1, ["a", "DOG"]), (1, ["cat"]), (2, ["leaves", "fall"]), (3, []), (3, [])]
    assert inline[2] == [(1, ["Cat"]), (1, ["Dog"]), (2, ["leaves", "fall"]), (3, []), (3, [])]
    monkeypatch.setattr(clean, "INLINE_LEXICON_ROWS", 0)
    assert run() == inline


def test_entities_of_several_words(spark, monkeypatch):
    df = spark.createDataFrame([(1, ["In", "New", "York", "City", "new", "york"]), (2, ["new"]), (3, [])],
                               "id long, tokens array<string>")
    ents = spark.createDataFrame([("new york", "GPE"), ("New  York City", "GPE"), ("IN", "X"), ("york new", "DATE")],
                                 "phrase string, type string")
    want = [(1, ["IN", "NEW", "YORK", "CITY", "NEW", "YORK"]), (2, ["new"]), (3, [])]
    assert rows(clean.entity_uppercase(df, ents)) == want
    monkeypatch.setattr(clean, "INLINE_LEXICON_ROWS", 0)
    assert rows(clean.entity_uppercase(df, ents)) == want


def test_one_pass_tokens_are_those_of_the_steps(spark):
    """Tags, entities, broken encoding and punctuation: the chain's tokens in one pass, also for texts without any of them."""
    from pyspark.sql import functions as F

    from tagloom.functions import text as T

    texts = [None, "", "  ", "plain words_1 here", "a<b>c</b>\x0b&lt;d&gt; &amp;amp; e&nbsp;f", "<script>x < y</script>z & é", "cafÃ© itâ€™s ok \x85",
             "x<!-- \n -->y<style>p{}</style>", "< not closed", "𝒳𝒴-z ٣٤ ,.;\t\r\n", "&copy;&middot;&#39;&quot;"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    steps = T.whitespace_tokens(T.remove_punctuation(T.repair_encoding(T.strip_html("t"))))
    plain = T.whitespace_tokens(T.remove_punctuation(T.repair_encoding("t")))
    for r in df.select("t", steps.alias("want"), clean.base_tokens(F.col("t")).alias("got"), plain.alias("plain"),
                       clean.base_tokens(F.col("t"), html=False).alias("without")).collect():
        assert r.got == r.want and r.without == r.plain, r


def test_variants_of_distinct_tokens_are_those_of_each_configuration(spark):
    """Entities of several words, repeated and empty posts: the counts of one prepare_posts for each configuration."""
    g = __import__("random").Random(4)
    words = ["new", "york", "New", "the", "runs", "run", "big", "apple", "x1"]
    posts = spark.createDataFrame([(i % 25, "en", g.choice(["", "New York runs", None]), " ".join(g.choice(words) for _ in range(g.randint(0, 12))), ["tag"]) for i in range(40)],
                                  "id long, thread string, title string, content string, tags array<string>")
    ents = spark.createDataFrame([("new york", "GPE"), ("apple", "ORG")], "phrase string, type string")
    lems = spark.createDataFrame([("runs", "verb", "run"), ("RUNS", "noun", "r")], "form string, pos string, lemma string")
    grid = [(s, n, l) for s in (True, False) for n in (True, False) for l in (True, False)]
    got = clean.prep_variants(posts, ["the", "NEW"], ents, lems)
    want = clean._prep_variants_per_config(posts, ["the", "NEW"], ents, lems, 3, grid)
    assert rows(got) == rows(want)
    none = clean.prep_variants(posts.limit(0), ["the"], ents, lems).collect()
    assert {(r.n_docs, r.n_tokens, r.vocab_size) for r in none} == {(0, None, 0)} and len(none) == 8

from pyspark.sql import functions as F

from tagloom.operators import embed, tagging
from tagloom.session import scratch_path
from conftest import rows


def vectors(spark):
    return spark.createDataFrame(
        [("a", [1.0, 0.0], 0), ("b", [0.0, 1.0], 1), ("c", [1.0, 1.0], 9), ("d", [-1.0, 0.0], 2)],
        "word string, vector array<double>, label int")


def test_mean_vectors_in_vocab_only(spark):
    toks = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (1, "zz"), (2, "zz")], "id long, word string")
    got = {r["id"]: (r["vector"], r["n_words"]) for r in embed.mean_vectors(toks, vectors(spark)).collect()}
    # repeats count, words without a vector do not; a document of only such words has a null vector
    assert got == {1: ([2 / 3, 1 / 3], 3), 2: (None, 0)}


def test_similar_by_word_excludes_self(spark):
    res = embed.similar_by_word(vectors(spark), 1)
    got = {r["word"]: r["neighbor"] for r in res.collect()}
    assert got["a"] == "c" and got["b"] == "c"


def test_predict_and_auto_tag(spark):
    toks = spark.createDataFrame([(1, "a"), (2, "d")], "id long, word string")
    tags = spark.createDataFrame([("a",), ("c",), ("d",)], "term string")
    cand = tagging.tag_candidates(toks, vectors(spark), 4)
    pred = rows(tagging.predict_tags(cand, tags, 0.2, 5), "id", "tag", "tag_rank")
    # doc 1 = (1,0): a cos 1, c cos .707 ; d cos -1 rejected; b cos 0 is no tag
    assert pred == [(1, "a", 1), (1, "c", 2), (2, "d", 1)]
    auto = {r["id"]: r["tags"] for r in tagging.auto_tag(toks, vectors(spark), tags, 4).collect()}
    assert auto == {1: ["a", "c"], 2: ["d"]}
    strict = {r["id"]: r["tags"] for r in tagging.auto_tag(toks, vectors(spark), tags, 4, min_cosine=1.0).collect()}
    assert strict == {1: [], 2: []}  # strictly greater than the threshold


def test_evaluate_autotag(spark):
    pred = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "id long, tags array<string>")
    truth = spark.createDataFrame([(1, ["a", "c"]), (2, ["d"])], "id long, tags array<string>")
    per = rows(tagging.evaluate_autotag(pred, truth), "id", "n_true", "n_pred", "hits", "misses")
    assert per == [(1, 2, 2, 1, 1), (2, 1, 0, 0, 1)]
    s = tagging.autotag_summary(tagging.evaluate_autotag(pred, truth)).first()
    assert s["hit_miss_ratio"] == 0.5 and s["precision"] == 0.5 and s["recall"] == round(1 / 3, 6)


def test_minmax_and_pca(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0)], "id long, x double, y double")
    assert rows(embed.minmax_scale(df), "id", "x", "y") == [(1, 0.0, 0.0), (2, 1.0, 0.0)]


def test_projection(spark):
    import numpy as np

    g = np.random.default_rng(0)
    x = g.normal(size=(80, 6)) @ np.diag([5, 3, 1, 0.5, 0.2, 0.1]) + 4
    df = spark.createDataFrame([(f"w{i}", v.tolist()) for i, v in enumerate(x)] + [("none", None)], "word string, vector array<double>").repartition(5)
    got = {r.word: r for r in embed.project_2d(df).collect()}
    c = x - x.mean(axis=0)
    value, axis = np.linalg.eigh(c.T @ c / len(c))
    axis = axis[:, ::-1][:, :2]
    axis = axis * np.sign(axis[np.abs(axis).argmax(axis=0), [0, 1]])
    assert np.allclose([[got[f"w{i}"].x, got[f"w{i}"].y] for i in range(80)], c @ axis)
    assert np.allclose([got[f"w{i}"].residual for i in range(80)], np.linalg.norm(c - c @ axis @ axis.T, axis=1))
    assert abs(got["w0"].explained - value[-2:].sum() / value.sum()) < 1e-9 and got["none"].x is None


def sentences(spark):
    import random

    g = random.Random(7)
    words = [[f"w{g.choice((g.randint(0, 5), g.randint(0, 40)))}" for _ in range(g.randint(0, 30))] for _ in range(80)]
    return words, spark.createDataFrame([(i, w if i % 9 else None if i == 0 else w) for i, w in enumerate(words)], "id long, tokens array<string>")


def test_cooccurrence_and_ppmi(spark):
    from collections import Counter

    import numpy as np

    words, df = sentences(spark)
    n = Counter()
    for i, w in enumerate(words):
        for a in range(len(w) if i else 0):
            for b in range(a + 1, min(a + 4, len(w))):
                n[w[a], w[b]] += 1
                n[w[b], w[a]] += 1
    counts = embed.cooccurrence(df, 3)
    assert {(r.word, r.context): r.n for r in counts.collect()} == dict(n)
    total, side = sum(n.values()), Counter()
    for (a, _), c in n.items():
        side[a] += c
    got = {(r.word, r.context): r.ppmi for r in embed.ppmi(counts).collect()}
    assert all(abs(got[k] - max(0, np.log(c * total / (side[k[0]] * side[k[1]])))) < 1e-9 for k, c in n.items())


def test_ppmi_vectors_are_the_leading_axes(spark):
    import numpy as np

    _, df = sentences(spark)
    weights = embed.ppmi(embed.cooccurrence(df, 3)).persist()
    names = sorted({r.word for r in weights.collect()})
    m = np.zeros((len(names),) * 2)
    for r in weights.collect():
        m[names.index(r.word), names.index(r.context)] = r.ppmi
    value, axis = np.linalg.eigh(m)
    order = np.argsort(-np.abs(value))[:4]
    got = {r.word: r.vector for r in embed.ppmi_vectors(weights, 4, extra=12, powers=6).collect()}
    v = np.array([got.get(w, [0.0] * 4) for w in names])
    best = axis[:, order] * np.sqrt(np.abs(value[order]))
    assert np.allclose(np.abs((v * best).sum(axis=0)), np.abs(value[order]), rtol=1e-3)  # each column is its axis, up to sign
    again = {r.word: r.vector for r in embed.ppmi_vectors(weights, 4, extra=12, powers=6).collect()}
    assert all(np.allclose(np.abs(again[w]), np.abs(got[w]), atol=1e-6) for w in got)
    assert embed.ppmi_vectors(weights.limit(0), 4).count() == 0


def test_auto_tags_of_posts_are_the_brute_force(spark):
    """Tags of real token arrays over written vectors, post by post."""
    import numpy as np

    words, df = sentences(spark)
    g = np.random.default_rng(2)
    known = {f"w{i}": g.normal(size=5) for i in range(35)}
    vecs = spark.createDataFrame([(w, v.tolist()) for w, v in known.items()], "word string, vector array<double>")
    tags = {f"w{i}" for i in range(0, 45, 3)}
    got = {r.id: r.tags for r in tagging.auto_tag_posts(df, vecs, spark.createDataFrame([(t,) for t in sorted(tags)], "term string"), n_neighbors=12).collect()}
    assert len(got) == len(words)
    for i, ws in enumerate(words):
        inside = [known[w] for w in (ws if i else []) if w in known]
        want = []
        if inside:
            m = np.mean(inside, axis=0)
            cos = {w: v @ m / np.linalg.norm(v) / np.linalg.norm(m) for w, v in known.items()}
            near = sorted(cos, key=lambda w: (-cos[w], w))[:12]
            want = [w for w in near if w in tags and cos[w] > 0.2][:5]
        assert got[i] == want


def test_word2vec_train_save_load(spark):
    from pyspark.ml.feature import Word2VecModel

    df = spark.createDataFrame([(["a", "b", "c", "a"],), (["b", "c", "d"],)], "tokens array<string>")
    m = embed.word2vec_train(df, vector_size=8, window=2, min_count=0, num_partitions=1)
    path = scratch_path(spark, "w2v")
    m.save(path)
    back = Word2VecModel.load(path)
    assert rows(embed.model_vectors(back), "word") == [("a",), ("b",), ("c",), ("d",)]
    tagged = embed.interleave_tags(spark.createDataFrame([(["w1", "w2", "w3"], ["t"])],
                                                         "tokens array<string>, tags array<string>"), every=2)
    assert tagged.first()["tokens"] == ["w1", "w2", "t", "w3", "t"]


def test_word_vectors_beyond_the_driver(spark):
    """Vocabularies above the bound are trained in blocks: every word gets a vector, and words that share sentences lie closer."""
    import random

    import numpy as np

    from tagloom.operators.skipgram import WordVectors

    g = random.Random(1)
    topics = [[f"t{k}w{i}" for i in range(30)] for k in range(4)]
    posts = [[g.choice(topics[i % 4]) for _ in range(20)] for i in range(800)] + [[None, "lone"], []]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(posts)] + [(-1, None)], "id long, tokens array<string>").repartition(2)
    for turns in (1, 2):
        model = embed.word2vec_train(df, vector_size=16, window=5, max_iter=turns, driver_values=100)
        assert isinstance(model, WordVectors)
        got = {r.word: np.array(r.vector) for r in embed.model_vectors(model).collect()}
        assert set(got) == {w for t in topics for w in t} | {"lone"} and model.getVectors().count() == 121
        x = np.array([got[w] for t in topics for w in t])
        x = (x - x.mean(axis=0)) / np.linalg.norm(x - x.mean(axis=0), axis=1)[:, None]
        s, of = x @ x.T, np.arange(120) // 30
        assert s[of[:, None] == of].mean() > s[of[:, None] != of].mean() + 0.3
    assert embed.word2vec_train(df, vector_size=16, min_count=2, driver_values=100).table.count() == 120
    assert embed.word2vec_train(df.limit(0), vector_size=4, driver_values=-1).table.count() == 0


def test_blocks_and_averages(spark):
    """Blocks hold all sentences in order; a word's vectors are averaged by how often the blocks have it."""
    import numpy as np
    import pyarrow as pa

    from tagloom.operators import skipgram

    g = np.random.default_rng(0)
    sentences = [[f"w{g.integers(50)}" for _ in range(g.integers(0, 20))] for _ in range(300)] + [None, ["a", None, "b"]]
    batch = pa.RecordBatch.from_arrays([pa.array(sentences, pa.list_(pa.string()))], names=["tokens"])
    back = []
    for words, ids, lens in skipgram.cut_blocks([batch.slice(0, 120), batch.slice(120)], 60):
        ends = np.cumsum(lens)
        back += [[words[i] for i in ids[e - n:e]] for e, n in zip(ends, lens)]
    assert [x for x in back if x] == [[w for w in x if w] for x in sentences if x]
    rows_ = [("a", 1, [1.0, 2.0]), ("a", 3, [5.0, 6.0]), ("b", 2, [7.0, 8.0])]
    df = spark.createDataFrame([(w, n, bytearray(np.array(v, "<f2").tobytes())) for w, n, v in rows_], "word string, n long, v binary").repartition(3)
    got = {r.word: (r.n, np.frombuffer(r.v, "<f2").tolist()) for r in skipgram.averaged(df, 2).collect()}
    assert got == {"a": (4, [4.0, 5.0]), "b": (2, [7.0, 8.0])}


def test_means_by_share(spark):
    """Means over shares are those of the broadcast plan: repeated words, words with two vectors, null ids, empty documents."""
    import numpy as np

    _, df = sentences(spark)
    toks = df.select("id", F.explode_outer("tokens").alias("word")).union(spark.createDataFrame([(None, "w1"), (3, "zz")], "id long, word string"))
    vecs = spark.createDataFrame([(f"w{i % 30}", np.random.default_rng(i).normal(size=3).tolist()) for i in range(33)], "word string, vector array<double>")
    want = {r.id: r for r in embed.mean_vectors(toks, vecs).collect()}
    for n in (50, 10**6):
        got = {r.id: r for r in embed._means_by_share(toks, vecs, n).collect()}
        assert set(got) == set(want)
        for i, r in want.items():
            assert got[i].n_words == r.n_words and (r.vector is None) == (got[i].vector is None) and (r.vector is None or np.allclose(r.vector, got[i].vector))
    assert {r.n_words for r in embed._means_by_share(toks, vecs.limit(0), 50).collect()} == {0}

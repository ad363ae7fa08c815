"""Saved pipelines, the facade's targets and vectorizers, and the model suite."""

import pytest
from pyspark.ml import Pipeline as Stages
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tagloom.operators import classify, clean, features, tuning
from tagloom.plans.pipeline import Pipeline
from tagloom.plans.stages import CleanPosts, PostTokens, TermBayes, TfidfTerms
from tagloom.session import scratch_path
from conftest import rows


@pytest.fixture(scope="module")
def posts(spark):
    data = []
    for i in range(60):
        thread = ["cooking", "travel"][i % 2]
        title = ["Pan <b>heat</b>", "Train tickets"][i % 2] + f" {i}"
        content = " ".join((["boil", "salt", "oven", "dough"] if i % 2 == 0 else ["visa", "hotel", "border", "route"])[(i // 2 + j) % 4] for j in range(i % 7))
        data.append((i, thread, title, content, [title.split()[-1], thread[:4]]))
    return spark.createDataFrame(data, "id long, thread string, title string, content string, tags array<string>").persist()


def saved(spark, model):
    path = scratch_path(spark, "stages")
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def test_saved_pipeline_predicts_the_same(spark, posts):
    train = posts.where("id % 4 > 0")
    model = Stages(stages=[PostTokens(), TfidfTerms(), TermBayes(alpha=0.5)]).fit(train)
    back = saved(spark, model)
    assert [type(s).__name__ for s in back.stages] == ["PostTokens", "TfidfTermsModel", "TermBayesModel"]
    assert back.stages[2].getOrDefault("alpha") == 0.5 and back.stages[2].uid == model.stages[2].uid
    one, two = (m.transform(posts) for m in (model, back))
    assert one.columns == two.columns == [*posts.columns, "tokens", "terms", "prediction"]
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    tokens = PostTokens().transform(posts)
    bag = features.bag_of_words(tokens)
    fitted = classify.nb_fit(bag.join(train.select("id"), "id", "left_semi"), train.select("id", F.col("thread").alias("label")), 0.5)
    direct = rows(classify.nb_predict(fitted, bag, posts.select("id")), "id", "prediction")
    assert rows(two, "id", "prediction") == direct
    in_train = features.bag_of_words(PostTokens().transform(train))
    want = {(r.id, r.term): r.tfidf for r in features.tfidf(in_train, train.count()).collect()}
    got = {(r.id, t.term): t.tfidf for r in two.where("id % 4 > 0").collect() for t in r.terms}
    assert got == pytest.approx(want)


def test_loaded_in_another_session(spark, posts):
    path = scratch_path(spark, "stages")
    Stages(stages=[PostTokens(outputCol="words"), TermBayes(inputCol="words")]).fit(posts).save(path)
    other = spark.newSession()
    written = scratch_path(spark, "posts")
    posts.write.parquet(written)
    out = PipelineModel.load(path).transform(other.read.parquet(written))
    assert out.sparkSession is not spark and out.where("prediction = thread").count() > 50
    again = scratch_path(spark, "stages")
    PipelineModel.load(path).save(again)  # what was loaded can be saved again
    assert PipelineModel.load(again).transform(posts).count() == 60


def test_saved_cleaning(spark, posts):
    stop = spark.createDataFrame([("salt",), ("the",)], "word string")
    lemmas = spark.createDataFrame([("tickets", "noun", "ticket"), ("boil", "verb", "cook")], "form string, pos string, lemma string")
    step = CleanPosts(inputCol="content", steps=["html", "punctuation", "stopwords", "lemmas"]).setLexicons(stop_words=stop, lemmas=lemmas)
    back = saved(spark, Stages(stages=[step]).fit(posts))
    want = clean.clean_data(posts, "content", keep=("thread",), ner=False, stop_words=stop, lemmas=lemmas)
    assert rows(back.transform(posts), "id", "thread", "tokens") == rows(want, "id", "thread", "tokens")


def test_many_lemmas_are_found_by_hash(spark):
    forms = [(f"form{i}é", "noun", f"lemma{i}") for i in range(1000)]
    lemmas = spark.createDataFrame(forms, "form string, pos string, lemma string")
    df = spark.createDataFrame([(1, [f"form{i}é" for i in range(0, 1000, 7)] + ["other", "formé"])], "id long, tokens array<string>")
    assert clean.lemmatize(df, lemmas).first().tokens == [f"lemma{i}" for i in range(0, 1000, 7)] + ["other", "formé"]


def test_facade_targets_and_vectorizers(spark, posts, tmp_path):
    pipe = Pipeline(spark, "all", root=str(tmp_path)).preprocess(posts, ner=False, lemmatize=False)
    tags = pipe.featurize("bow", "tag_bool").model("nb", dims=64).evaluate()
    got = {(r.split, r.metric): r.value for r in tags.collect()}
    assert {s for s, _ in got} == {"train", "test"} and got["train", "accuracy"] > 0.5
    counts = pipe.tag_counts().where("split = 'train'").agg(F.sum("tp"), F.sum("n_true"), F.count("*")).first()
    assert got["train", "recall_micro"] == round(counts[0] / counts[1], 6) and counts[2] == pipe.data.where("split = 'train'").select(F.explode("tags")).distinct().count()
    svc = {(r.split, r.metric): r.value for r in pipe.featurize("tfidf", "tag_counts").model("ovr_svc", dims=64).evaluate().collect()}
    assert svc["train", "f1_micro"] > 0.5
    for kind in ("word2vec", "doc2vec"):
        out = pipe.featurize(kind, dims=8).model("rf", maxDepth=3).evaluate(k=2)
        assert {r.fold for r in out.collect()} == {-1, 0, 1}
    with pytest.raises(ValueError):
        pipe.featurize("word2vec").model("nb")
    with pytest.raises(ValueError):
        pipe.featurize("word2vec", "tag_bool")
    with pytest.raises(ValueError):
        pipe.featurize("bow", "tag_bool").model("rf")


def test_parts_of_the_suite(spark, posts):
    """Hold-out and folds of its kinds of models; the confusion adds up to the accuracy."""
    from tagloom.plans import suite

    split = classify.train_test_split(PostTokens().transform(posts).select("id", "thread", "tokens"))
    coded = tuning.hashed_counts(split.withColumn("label", (F.col("thread") == "travel").cast("double")), dims=32)
    n_test = split.where("split = 'test'").count()
    for scores in (suite._bayes(split, 2), suite._mllib(coded, "nb", ["cooking", "travel"], 2)):
        by = {(r.split, r.metric): r.value for r in scores.collect()}
        assert {m for s, m in by if s == "validate"} == {"accuracy", "precision_macro", "recall_macro", "f1_macro"}
        assert by["test", "accuracy"] > 0.8 and by["validate", "accuracy"] > 0.8
        cells = {tuple(m[10:].split(" > ")): v for (s, m), v in by.items() if m.startswith("confusion ")}
        assert sum(cells.values()) == n_test
        assert abs(sum(v for (a, b), v in cells.items() if a == b) / n_test - by["test", "accuracy"]) < 1e-5


def test_all_models_of_the_suite_see_all_rows(spark, monkeypatch):
    """Every fit, also that of the boosted trees, gets all training rows, and every score is over all rows."""
    from tagloom.plans import suite

    none = spark.createDataFrame([], "split string, metric string, value double")
    got, n = {}, 1600
    tokens = spark.range(n).selectExpr("id", "if(id % 2 = 0, 'a', 'b') AS thread", "array(concat('w', id % 7)) AS tokens")

    def mllib(data, model, labels, folds, **params):
        got.setdefault(model, []).append({r.split: r["count"] for r in data.groupBy("split").count().collect()})
        return none

    monkeypatch.setattr(suite, "_mllib", mllib)
    monkeypatch.setattr(suite, "_bayes", lambda *a: none)
    monkeypatch.setattr(suite, "_neighbours", lambda *a: none)
    zeros = F.array_repeat(F.lit(0.0), suite.EMBEDDING_DIMS)
    monkeypatch.setattr(suite, "embedded_posts", lambda posts: posts.select("id", "thread", "split", zeros.alias("vector")))
    assert suite.model_suite(tokens).count() == 0
    sizes = {r.split: r["count"] for r in classify.train_test_split(tokens).groupBy("split").count().collect()}
    assert sum(sizes.values()) == n and sizes["train"] > 1000
    assert set(got) == {"rf", "ovr_gbt", "nb", "ovr_lr", "ovr_svc"} and all(x == sizes for found in got.values() for x in found)


def test_facade_bayes_is_that_of_mllib(spark, tmp_path):
    """All folds' and the test rows' scores are those of MLlib's naive Bayes on vectors, which the facade does not make."""
    import random

    from tagloom.operators import evaluate

    r = random.Random(5)
    data = [(i % 150, "abc"[i % 3], " ".join(r.choice("a b c d e f g".split()) + str(r.randrange(3 + i % 3)) for _ in range(r.randrange(9)))) for i in range(180)]
    prepared = spark.createDataFrame(data, "id long, thread string, t string").select("id", "thread", F.expr("filter(split(t, ' '), x -> x != '')").alias("tokens"))
    pipe = Pipeline(spark, "bayes", root=str(tmp_path), prepared=prepared).featurize("bow", "thread").model("nb")
    assert "features" not in pipe.data.columns
    got = {(x.fold, x.split, x.metric): x.value for x in pipe.evaluate(k=3).collect()}
    split = classify.train_test_split(prepared)
    rows, _ = classify.labelled_features(split, fit_on=split.where("split = 'train'"))
    train, want = evaluate.kfold_assign(rows.where("split = 'train'"), 3, 42), {}
    parts = [(f, train.where(F.col("fold") != f), train.withColumn("split", F.when(F.col("fold") == f, "validate").otherwise("train"))) for f in range(3)]
    for f, fitted, scored in [*parts, (-1, rows.where("split = 'train'"), rows.where("split = 'test'"))]:
        pred = classify.estimator("nb").fit(fitted).transform(scored)
        want |= {(f, x.split, x.metric): x.value for x in evaluate.classification_metrics(pred, by=["split"]).collect()}
    assert got == want and len(got) == 28 and pipe.labels == ["a", "b", "c"]

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.operators import classify, evaluate, features
from conftest import rows

DOCS = [(1, "x", ["a", "a", "b"]), (2, "x", ["a", "c"]), (3, "y", ["d", "d", "b"]), (4, "y", ["d"]),
        (5, "z", ["e", "a"]), (6, "z", ["e", "e", "d"]), (7, "x", []), (8, "y", ["a", "d", "q"])]


def frame(spark):
    return spark.createDataFrame(DOCS, "id long, label string, tokens array<string>")


def brute_nb(train, test, alpha, fit_prior):
    labels = sorted({l for _, l, _ in train})
    vocab = sorted({t for _, _, ts in train for t in ts})
    cnt = {(l, t): 0 for l in labels for t in vocab}
    for _, l, ts in train:
        for t in ts:
            cnt[(l, t)] += 1
    out = {}
    for i, _, ts in test:
        best = None
        for l in labels:
            nd = sum(1 for _, ll, _ in train if ll == l)
            s = math.log(nd / len(train)) if fit_prior else -math.log(len(labels))
            tot = sum(cnt[(l, t)] for t in vocab)
            for t in ts:
                if t in vocab:
                    s += math.log((cnt[(l, t)] + alpha) / (tot + alpha * len(vocab)))
            if best is None or s > best[0] + 1e-12:
                best = (s, l)
        out[i] = best[1]
    return out


def test_nb_matches_brute_force(spark):
    df = frame(spark)
    tf = features.bag_of_words(df)
    train_ids = [1, 2, 3, 4, 5, 6]
    tr = df.filter(F.col("id").isin(train_ids))
    for alpha, fp in [(1.0, True), (0.1, False)]:
        m = classify.nb_fit(tf.join(tr.select("id"), "id", "left_semi"), tr, alpha, fp)
        got = {r["id"]: r["prediction"] for r in classify.nb_predict(m, tf, df.select("id")).collect()}
        exp = brute_nb([d for d in DOCS if d[0] in train_ids], DOCS, alpha, fp)
        assert got == exp


def test_nb_grid_kfold_matches_per_fold_fits(spark):
    df = frame(spark)
    tf = features.bag_of_words(df)
    lab = df.select("id", "label", (F.col("id") % 2).cast("int").alias("fold"))
    grid = {(r["alpha"], r["fit_prior"]): r["f1_macro"] for r in classify.nb_grid_kfold(tf, lab, k=2).collect()}
    for (a, fp), f1 in grid.items():
        scores = []
        for f in range(2):
            train = [d for d in DOCS if d[0] % 2 != f]
            val = [d for d in DOCS if d[0] % 2 == f]
            pred = brute_nb(train, val, a, fp)
            p = spark.createDataFrame([(i, l, pred[i]) for i, l, _ in val], "id long, label string, prediction string")
            m = evaluate.classification_metrics(p)
            scores.append([r["value"] for r in m.collect() if r["metric"] == "f1_macro"][0])
        assert abs(f1 - sum(scores) / 2) < 2e-6, (a, fp)
    assert len(grid) == 8


def test_nb_rejects_negative_values(spark):
    tf = spark.createDataFrame([(1, "a", -1.0)], "id long, term string, tf double")
    lab = spark.createDataFrame([(1, "x")], "id long, label string")
    try:
        classify.nb_fit(tf, lab)
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_metrics_confusion_mse(spark):
    p = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "d")], "label string, prediction string")
    m = {r["metric"]: r["value"] for r in evaluate.classification_metrics(p).collect()}
    # classes a,b,c,d: precision a=1, b=.5, c=0, d=0 ; recall a=.5, b=1, c=0, d=0
    assert m["accuracy"] == 0.5
    assert m["precision_macro"] == 0.375 and m["recall_macro"] == 0.375
    assert m["f1_macro"] == round((2 / 3 + 2 / 3) / 4, 6)
    cm = rows(evaluate.confusion_matrix(p), "actual", "predicted", "count", "share")
    assert ("a", "b", 1, 0.5) in cm
    y = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "label double, prediction double")
    assert evaluate.mse_score(y).first()["mse"] == 0.5


def test_staged_error_and_folds(spark):
    s = spark.createDataFrame([(1, 1, 1.0), (1, 2, -3.0), (2, 1, -1.0), (2, 2, 0.5)], "id long, round int, score double")
    lab = spark.createDataFrame([(1, 1), (2, 0)], "id long, label int")
    assert rows(evaluate.staged_error(s, lab), "round", "error") == [(1, 0.0), (2, 0.5)]
    f = evaluate.kfold_assign(spark.range(100), 5, 42)
    counts = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert len(counts) == 5 and sum(counts) == 100


def test_knn_vote_ties_to_smallest_label(spark):
    train = spark.createDataFrame([(1, [1.0, 0.0], 5), (2, [0.9, 0.0], 3), (3, [-5.0, 0.0], 1)],
                                  "id long, vector array<double>, label int")
    test = spark.createDataFrame([(10, [1.0, 0.1])], "id long, vector array<double>")
    assert classify.knn_classify(test, train, k=2).first()["prediction"] == 3


def test_mllib_estimators_and_samme(spark):
    rng = np.random.default_rng(1)
    words = {"x": ["a", "b", "c"], "y": ["d", "e", "f"], "z": ["g", "h", "i"]}
    docs = [(i, c, list(rng.choice(words[c], 5))) for i, c in enumerate(["x", "y", "z"] * 20)]
    df = classify.train_test_split(spark.createDataFrame(docs, "id long, thread string, tokens array<string>"))
    data, labels = classify.labelled_features(df)
    assert labels == ["x", "y", "z"]
    for name in ["nb", "rf", "ovr_lr"]:
        m = {(r["split"], r["metric"]): r["value"] for r in classify.fit_and_score(data, classify.estimator(name)).collect()}
        assert m[("test", "accuracy")] > 0.9, name
    trees, alphas = classify.adaboost_samme(data.filter(F.col("split") == "train"), n_rounds=4, n_classes=3)
    assert 1 <= len(trees) <= 4
    pred = classify.adaboost_predict(data, trees, alphas, 3)
    assert pred.count() == data.count()
    st = classify.samme_staged_error(data, trees, alphas, 3)
    assert st.count() == 2 * len(trees)


def test_grid_search_and_grids(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.tuning import ParamGridBuilder

    rng = np.random.default_rng(2)
    docs = [(i, c, list(rng.choice(["a", "b"] if c == "x" else ["c", "d"], 4))) for i, c in enumerate(["x", "y"] * 15)]
    df = classify.train_test_split(spark.createDataFrame(docs, "id long, thread string, tokens array<string>"))
    data, _ = classify.labelled_features(df)
    rf = RandomForestClassifier(seed=1)
    small = ParamGridBuilder().addGrid(rf.numTrees, [3, 5]).build()
    model, table = classify.grid_search(data, rf, small, folds=2, parallelism=2)
    assert table.count() == 2 and all(0.0 <= r["f1_macro"] <= 1.0 for r in table.collect())


def test_nb_grid_never_predicts_a_class_its_fold_has_not_seen(spark):
    from tagloom.operators import classify

    lab = spark.createDataFrame([(1, "a", 0), (2, "a", 1), (3, "b", 1), (4, "c", 0), (5, "b", 0)],
                                "id long, label string, fold int")
    tf = spark.createDataFrame([(1, "x", 9), (2, "x", 9), (2, "y", 1), (3, "z", 9), (4, "z", 1), (4, "q", 1), (5, "z", 9)],
                               "id long, term string, tf long")
    pred = classify._nb_fold_predictions(tf, lab, (1.0,), (True, False), 2, False)
    assert {r["prediction"] for r in pred.filter("g = 0").collect()} <= {"a", "b"}


def test_regressors_are_searched_by_squared_error(spark):
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.regression import DecisionTreeRegressor
    from pyspark.ml.tuning import ParamGridBuilder

    from tagloom.operators import classify

    data = spark.createDataFrame([(i, float(i % 7), Vectors.dense([float(i % 7), 1.0]), "train") for i in range(70)],
                                 ["id", "label", "features", "split"])
    est = DecisionTreeRegressor(seed=1)
    grid = ParamGridBuilder().addGrid(est.maxDepth, [0, 5]).build()
    _, table = classify.grid_search(data, est, grid, folds=2)
    score = {r["params"]: r["neg_mse"] for r in table.collect()}
    assert score["maxDepth=0"] < -1 and score["maxDepth=5"] > -0.01


def test_vocabulary_has_every_term(spark):
    from pyspark.sql import functions as F

    from tagloom.operators.features import count_vector_stage

    n = 270_000
    df = spark.range(270).select(F.transform(F.sequence(F.col("id") * 1000, F.col("id") * 1000 + 999),
                                             lambda x: F.concat(F.lit("t"), x.cast("string"))).alias("tokens"))
    assert len(count_vector_stage().fit(df).vocabulary) == n


def test_stumps_are_those_of_the_tree_learner(spark):
    """Rounds on the non-zero values give MLlib's splits: counts, a dense and a negative column, more values than bins."""
    import math

    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors

    g = np.random.default_rng(5)
    data = []
    for i in range(300):
        y = int(g.integers(3))
        x = {0: float(g.poisson(20 + 9 * y)), 1: float(g.poisson(0.3 + (y == 1))), 2: float(g.normal()) - (y == 2), 3: float(g.poisson(0.5 + (y == 0)))}
        data.append((i, float(y), Vectors.sparse(6, {k: v for k, v in x.items() if v}) if i % 3 else Vectors.dense([*x.values(), 0.0, 0.0])))
    df = spark.createDataFrame(data, ["id", "label", "features"])
    trees, alphas = classify.adaboost_samme(df, n_rounds=5, n_classes=3)
    cur, same = df.withColumn("w", F.lit(1.0)), 0
    for tree, alpha in zip(trees, alphas):
        m = DecisionTreeClassifier(maxDepth=1, weightCol="w", predictionCol="p", rawPredictionCol="r", probabilityCol="q").fit(cur)
        pred = m.transform(cur)
        assert tree.copy().setPredictionCol("mine").transform(pred).where("mine <> p").count() == 0
        err = pred.agg(F.sum(F.when(F.col("p") != F.col("label"), F.col("w")).otherwise(0.0)) / F.sum("w")).first()[0]
        assert abs(alpha - math.log((1 - err) / err) - math.log(2)) < 1e-9
        cur = pred.select("id", "label", "features", (F.col("w") * F.when(F.col("p") != F.col("label"), math.exp(alpha)).otherwise(1.0)).alias("w")).localCheckpoint()
        same += 1
    assert same == 5


@pytest.fixture
def odd_docs(spark):
    """Posts with repeated ids, without tokens, with terms that only test rows have."""
    g = np.random.default_rng(9)
    docs = [(i % 130, "xyz"[i % 3], [f"w{g.integers(12)}" for _ in range(int(g.integers(9)))] + ["abc"[i % 3]] * int(g.integers(3)) + (["new"] if i % 130 % 7 == 0 else [])) for i in range(150)]
    return classify.train_test_split(spark.createDataFrame(docs, "id long, thread string, tokens array<string>"))


def test_split_bayes_is_that_of_mllib(odd_docs):
    from pyspark.ml.feature import IndexToString

    data, labels = classify.labelled_features(odd_docs, fit_on=odd_docs.where("split = 'train'"))
    model = classify.estimator("nb").fit(data.where("split = 'train'"))
    names = lambda df, a, b: IndexToString(inputCol=a, outputCol=b, labels=labels).transform(df)
    want = names(names(model.transform(data), "label", "l"), "prediction", "p")
    got = classify.nb_split_predictions(odd_docs)
    assert rows(got, "split", "label", "prediction") == rows(want, "split", "l", "p") and got.count() == 150
    with pytest.raises(ValueError):
        classify.nb_split_predictions(odd_docs.where("thread <> 'x' OR split = 'test'"))


def test_stumps_of_bags_are_those_of_vectors(odd_docs):
    """Boosting on terms gives the rounds that the vocabulary's numbers give."""
    data, labels = classify.labelled_features(odd_docs, fit_on=odd_docs.where("split = 'train'"))
    bags, names = classify.labelled_bags(odd_docs)
    assert names == labels
    out = []
    for d in (data, bags):
        trees, alphas = classify.adaboost_samme(d.where("split = 'train'"), n_rounds=6, n_classes=3)
        said = rows(classify.adaboost_predict(d, trees, alphas, 3), "id", "label", "prediction")
        out.append(([round(a, 9) for a in alphas], [(t.threshold, t.left, t.right) for t in trees], said))
    assert out[0] == out[1] and len(out[0][0]) > 2


def test_queries_without_a_vocabulary_on_the_driver(odd_docs, monkeypatch):
    from tagloom.operators import features
    from tagloom.plans import catalog

    def no(*a, **k):
        raise AssertionError("a count vectorizer keeps its vocabulary on the driver")

    monkeypatch.setattr(features, "count_vector_stage", no)
    monkeypatch.setattr(catalog, "toks", lambda spark, d: odd_docs.drop("split"))
    spark = odd_docs.sparkSession
    assert catalog.q_nb_mllib(spark, "").count() == 8 and catalog.q_adaboost(spark, "").count() == 8
    assert {r.split for r in catalog.q_staged_error(spark, "").collect()} == {"train", "test"}


def test_boosting_on_the_features_that_occur(spark):
    """Features that the fitted rows lack are left out; the model says the same of all rows."""
    from pyspark.ml.linalg import Vectors

    g = np.random.default_rng(6)
    data = spark.createDataFrame([(i, float(i % 2), Vectors.sparse(200, {int(j): float(g.integers(1, 5)) for j in {10 + i % 2, *g.integers(20, 60 if i < 40 else 200, 5)}}),
                                   "train" if i < 40 else "test") for i in range(80)], ["id", "label", "features", "split"])
    train = data.where("split = 'train'")
    small = classify.used_features(data, train)
    assert small.first().features.size < 50
    est = classify.estimator("ovr_gbt", maxIter=3)
    want, got = (rows(est.fit(x.where("split = 'train'")).transform(x), "id", "prediction") for x in (data, small))
    assert got == want

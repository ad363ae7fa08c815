"""Splits, naive Bayes as DataFrame aggregates, pyspark.ml classifiers and grids, SAMME boosting,
multi-label tags and k-NN.

The DataFrame naive Bayes never builds the vocabulary x class table: a document's score for class c is
    prior_c + L_d * (ln a - ln(N_c + a V)) + sum over its terms with n_ct > 0 of tf * (ln(n_ct + a) - ln a)
where L_d is the document's in-vocabulary length — so only the non-zero (class, term) counts are joined.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import run_lengths
from tagloom.operators.evaluate import MacroF1Evaluator, classification_metrics
from tagloom.operators.features import small_terms
from tagloom.operators.neighbors import nearest
from tagloom.operators.skew import heavy_join
from tagloom.operators.stumps import best_stump, is_bag, stump_rows
from tagloom.session import materialize
from tagloom.sources.tables import with_split


def train_test_split(df: DataFrame, id_col: str = "id", buckets: int = 4, seed=None) -> DataFrame:
    """H1: adds split = 'test' (hash bucket 0, 1/buckets of rows) / 'train'."""
    return with_split(df, id_col, buckets, seed)


# ------------------------------------------------------------------ H2: multinomial naive Bayes (DataFrame form)
@dataclass
class NBModel:
    classes: DataFrame  # (label, log_prior, log_denom)
    weights: DataFrame  # (label, term, w) non-zero counts only
    vocab: DataFrame  # (term)
    labels: list
    alpha: float


def nb_fit(tf_long: DataFrame, labels: DataFrame, alpha: float = 1.0, fit_prior: bool = True) -> NBModel:
    """Fit on long term frequencies (id, term, tf) and document labels (id, label). Every labelled document
    counts for the prior, with or without terms."""
    if alpha <= 0:
        raise ValueError("alpha must be > 0")
    from pyspark.sql.types import IntegralType

    if not isinstance(tf_long.schema["tf"].dataType, IntegralType) and tf_long.filter(F.col("tf") < 0).limit(1).count():
        raise ValueError("naive Bayes needs non-negative feature values (scale embeddings first)")
    lab = labels.select("id", "label")
    # (class, term) counts feed the vocabulary size, the class totals and the weights: aggregate once
    counts = materialize(tf_long.join(lab, "id").groupBy("label", "term").agg(F.sum("tf").alias("n")), "nb_counts")
    vocab = counts.select("term").distinct()
    v = vocab.count()
    docs = lab.groupBy("label").agg(F.count(F.lit(1)).alias("nd"))
    per_class = {r["label"]: r["nd"] for r in docs.collect()}  # K rows: the classes and their document counts
    n_docs = sum(per_class.values())
    totals = counts.groupBy("label").agg(F.sum("n").alias("N"))
    label_list = sorted(per_class)
    k = len(label_list)
    prior = F.log(F.col("nd") / F.lit(float(n_docs))) if fit_prior else F.lit(-math.log(k))
    classes = docs.join(totals, "label", "left").select(
        "label", prior.alias("log_prior"),
        F.log(F.coalesce(F.col("N"), F.lit(0)) + F.lit(alpha * v)).alias("log_denom"))
    weights = counts.select("label", "term", (F.log(F.col("n") + F.lit(alpha)) - F.lit(math.log(alpha))).alias("w"))
    return NBModel(classes, weights, vocab, label_list, alpha)


def _terms_of(tf_long: DataFrame, wide: DataFrame) -> DataFrame:
    """Rows of ``tf_long`` with what ``wide`` (a row for each term, ``weight``) has for their terms: a small table goes to the
    rows, of a large one its frequent terms do and the others are met by key."""
    if small_terms(wide):
        return tf_long.join(F.broadcast(wide), "term")
    return heavy_join(tf_long, wide, "term", F.col("weight"))


def _nb_wide_scores(model: NBModel, tf_long: DataFrame, ids: DataFrame) -> tuple[DataFrame, list]:
    """(id, s0..s{K-1}) with one score column per class, in the order of ``model.labels``.

    The weights are laid out wide — one row per vocabulary term with K weight columns — so scoring is one join on
    term (shuffle, or broadcast by AQE when the vocabulary is small) and one hash aggregate per document of K
    conditional sums. No (document x class) grid, no per-class joins; class constants (K rows) are literals."""
    labels = model.labels
    consts = {r["label"]: (r["log_prior"], r["log_denom"]) for r in model.classes.collect()}  # K rows
    wide = materialize(model.weights.groupBy("term").agg(
        *[F.sum(F.when(F.col("label") == F.lit(c), F.col("w"))).alias(f"w{i}") for i, c in enumerate(labels)],
        F.sum(F.exp("w")).alias("weight")), "nb_weights")  # exp(w) = 1 + n / alpha: as heavy as the term is frequent
    per_doc = _terms_of(tf_long, wide).groupBy("id").agg(
        F.sum("tf").alias("L"),  # in-vocabulary length: every vocabulary term has a wide row
        *[F.sum(F.col("tf") * F.coalesce(F.col(f"w{i}"), F.lit(0.0))).alias(f"p{i}") for i in range(len(labels))])
    la = math.log(model.alpha)
    scores = [(F.lit(consts[c][0]) + F.coalesce("L", F.lit(0)) * F.lit(la - consts[c][1])
               + F.coalesce(F.col(f"p{i}"), F.lit(0.0))).alias(f"s{i}") for i, c in enumerate(labels)]
    return ids.select("id").join(per_doc, "id", "left").select("id", *scores), labels


def nb_scores(model: NBModel, tf_long: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, label, score) for every document in ``ids`` and every class."""
    wide, labels = _nb_wide_scores(model, tf_long, ids)
    rows = F.array(*[F.struct(F.lit(c).alias("label"), F.col(f"s{i}").alias("score")) for i, c in enumerate(labels)])
    return wide.select("id", F.explode(rows).alias("r")).select("id", "r.label", "r.score")


def argmax_label(scores: DataFrame) -> DataFrame:
    """(id, prediction) from long (id, label, score): best score, ties to the smallest label."""
    return scores.groupBy("id").agg(F.min_by("label", F.struct((-F.col("score")).alias("s"), F.col("label"))).alias(
        "prediction"))


def nb_predict(model: NBModel, tf_long: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, prediction): the argmax is a row expression over the K score columns (ties to the smallest label,
    labels being sorted), so prediction adds no aggregation or shuffle to scoring."""
    wide, labels = _nb_wide_scores(model, tf_long, ids)
    best = F.greatest(*[F.struct(F.col(f"s{i}").alias("s"), F.lit(-i).alias("neg")) for i in range(len(labels))]) \
        if len(labels) > 1 else F.struct(F.col("s0").alias("s"), F.lit(0).alias("neg"))
    label_arr = F.array(*[F.lit(c) for c in labels])
    return wide.select("id", F.element_at(label_arr, (F.lit(1) - best["neg"]).cast("int")).alias("prediction"))


# ------------------------------------------------------------------ pyspark.ml classifiers (H2 MLlib, H4–H11)
def training_frame(df: DataFrame, spread: bool = True) -> DataFrame:
    """Feature frames feed iterative trainers (many passes): spread them over at least the cluster's default
    parallelism and keep them (memory, spilling to disk; recomputed from lineage if an executor is lost)."""
    from pyspark import StorageLevel

    par = df.sparkSession.sparkContext.defaultParallelism
    if spread and df.rdd.getNumPartitions() < par:
        df = df.repartition(par)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def labelled_features(df: DataFrame, tokens_col: str = "tokens", label_col: str = "thread", kind: str = "bow",
                      vocab_size: int | None = None, min_df: float = 1.0, fit_on: DataFrame | None = None):
    """(id, label double, features sparse vector, split) with a vocabulary fitted on ``fit_on`` (default: df); all
    its terms unless ``vocab_size`` is given. kind = 'bow' (counts) or 'tfidf' (smooth idf, L2)."""
    from pyspark.ml.feature import StringIndexer

    from tagloom.operators.features import count_vector_stage, tfidf_vectors

    base = fit_on if fit_on is not None else df
    idx = StringIndexer(inputCol=label_col, outputCol="label", stringOrderType="alphabetAsc").fit(base)
    if kind == "bow":
        cv = count_vector_stage(tokens_col, "features", vocab_size, min_df).fit(base)
        out = cv.transform(df)
    elif kind == "tfidf":
        _, transform = tfidf_vectors(base, tokens_col, "features", vocab_size, min_df)
        out = transform(df)
    else:
        raise ValueError("kind must be bow or tfidf")
    return training_frame(idx.transform(out)), idx.labels


def class_names(df: DataFrame, label_col: str = "thread") -> list:
    """The classes of the training rows, sorted; all rows of (``label_col``, split) must have one of them."""
    found = [(r[0], r[1]) for r in df.select(label_col, "split").distinct().collect()]  # classes x splits
    labels = {c for c, s in found if s == "train"}
    if None in {c for c, _ in found} or {c for c, _ in found} - labels:
        raise ValueError("every label must be one that training rows have")
    return sorted(labels)


def labelled_bags(df: DataFrame, tokens_col: str = "tokens", label_col: str = "thread"):
    """(id, label double, split, features), a written table, and the classes: ``labelled_features`` without a vocabulary. A
    row's features are its own ``terms`` and their counts (``values``); nothing of them is on the driver."""
    labels = class_names(df, label_col)
    code = (F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(label_col)) - 1).cast("double") if labels else F.lit(None).cast("double")
    out = df.select("id", code.alias("label"), "split", run_lengths(tokens_col).alias("__cells"))
    cells = F.coalesce("__cells", F.array().cast("array<struct<term:string,tf:bigint>>"))
    bag = F.struct(F.transform(cells, lambda c: c["term"]).alias("terms"), F.transform(cells, lambda c: c["tf"].cast("double")).alias("values"))
    return materialize(out.select("id", "label", "split", bag.alias("features")), "labelled_bags"), labels


def nb_split_predictions(docs: DataFrame, alpha: float = 1.0, label_col: str = "thread") -> DataFrame:
    """(split, label, prediction) of all rows by multinomial NB fitted on the training rows as MLlib fits it: their whole
    vocabulary, priors smoothed by ``alpha``, too. ``docs``: (``label_col``, split, tokens), a row for each document.

    No vocabulary and no model is on the driver: one table of terms holds each class's counts."""
    labels = class_names(docs, label_col)
    if not labels:
        raise ValueError("naive Bayes needs training rows")
    # the number is made in a step of its own: beside the explosion it would be one for each of its rows
    cells = docs.select(F.monotonically_increasing_id().alias("id"), F.col(label_col).alias("label"), "split", run_lengths("tokens").alias("cells"))
    bag = materialize(cells.select("id", "label", "split", F.posexplode_outer("cells").alias("pos", "c")).select("id", "label", "split", "pos", "c.term", "c.tf"), "nb_bag")
    rows = bag.where("pos IS NULL OR pos = 0")  # once a document
    nd = {r.label: r.n for r in rows.where("split = 'train'").groupBy("label").agg(F.count("*").alias("n")).collect()}
    train = F.col("split") == "train"
    wide = materialize(bag.where("term IS NOT NULL").groupBy("term").agg(
        *[F.coalesce(F.sum(F.when(train & (F.col("label") == F.lit(c)), F.col("tf"))), F.lit(0)).alias(f"n{j}") for j, c in enumerate(labels)],
        F.count(F.when(train, 1)).alias("known"), F.count("*").alias("weight")).where("known > 0").drop("known"), "nb_class_counts")
    stats = wide.agg(F.count("*").alias("V"), *[F.sum(f"n{j}").alias(f"N{j}") for j in range(len(labels))]).first()
    sums = _terms_of(bag.where("term IS NOT NULL").select("id", "term", "tf"), wide).groupBy("id").agg(
        F.sum("tf").alias("L"), *[F.sum(F.col("tf") * F.log(F.col(f"n{j}") + F.lit(alpha))).alias(f"p{j}") for j in range(len(labels))])
    smooth = math.log(sum(nd.values()) + alpha * len(labels))
    scores = [F.lit(math.log(nd[c] + alpha) - smooth) + F.coalesce(f"p{j}", F.lit(0.0))
              - F.coalesce("L", F.lit(0)) * F.lit(math.log((stats[f"N{j}"] or 0) + alpha * max(stats["V"], 1))) for j, c in enumerate(labels)]
    cands = [F.struct(x.alias("s"), F.lit(-j).alias("neg")) for j, x in enumerate(scores)]
    best = F.greatest(*cands) if len(cands) > 1 else cands[0]
    said = F.element_at(F.array(*[F.lit(x) for x in labels]), (F.lit(1) - best["neg"]).cast("int"))
    return rows.select("id", "label", "split").join(sums, "id", "left").select("split", "label", said.alias("prediction"))


def estimator(name: str, **kw):
    """Classifier by name: nb, rf, ovr_lr, ovr_svc, ovr_gbt, dt.

    One-vs-rest models are fitted one after the other: side by side, pyspark gives all its threads the same copy of the
    session's local properties, and one clears the execution id that another is reading. Whole fits may run side by side,
    from threads of their own."""
    from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                           NaiveBayes, OneVsRest, RandomForestClassifier)

    if name == "nb":
        return NaiveBayes(smoothing=kw.get("smoothing", 1.0), modelType="multinomial")
    if name == "rf":
        return RandomForestClassifier(numTrees=kw.get("numTrees", 10), maxDepth=kw.get("maxDepth", 30),
                                      featureSubsetStrategy=kw.get("featureSubsetStrategy", "sqrt"),
                                      seed=kw.get("seed", 42))
    if name == "ovr_lr":  # elastic-net penalised logistic regression, one model per class
        return OneVsRest(classifier=LogisticRegression(maxIter=kw.get("maxIter", 50), regParam=kw.get("regParam", 1e-4),
                                                       elasticNetParam=kw.get("elasticNetParam", 0.15)),
                         parallelism=1)
    if name == "ovr_svc":
        return OneVsRest(classifier=LinearSVC(maxIter=kw.get("maxIter", 50), regParam=kw.get("regParam", 1e-4)),
                         parallelism=1)
    if name == "ovr_gbt":  # boosted stumps: 20 rounds, depth 1, step 1.0 (GBTClassifier is binary-only)
        return OneVsRest(classifier=GBTClassifier(maxIter=kw.get("maxIter", 20), maxDepth=kw.get("maxDepth", 1),
                                                  stepSize=kw.get("stepSize", 1.0), seed=kw.get("seed", 42)),
                         parallelism=1)
    if name == "dt":
        return DecisionTreeClassifier(maxDepth=kw.get("maxDepth", 5), seed=kw.get("seed", 42))
    raise ValueError(f"unknown estimator {name!r}")


def used_features(data: DataFrame, rows: DataFrame) -> DataFrame:
    """``data`` with the features that ``rows`` (a bounded part of it, the one that is fitted on) have a non-zero in, in their
    order. No tree can split on another, and MLlib's trees hold a number for each feature and row."""
    from pyspark.ml.feature import VectorSlicer

    vector = F.unwrap_udt("features")
    cells = F.arrays_zip(F.when(vector["type"] == 1, F.sequence(F.lit(0), F.size(vector["values"]) - 1)).otherwise(vector["indices"]).alias("f"), vector["values"].alias("x"))
    used = sorted(r.f for r in rows.select(F.explode(cells).alias("c")).where("c.x <> 0").select(F.col("c.f").alias("f")).distinct().collect())
    sliced = VectorSlicer(inputCol="features", outputCol="__used", indices=used or [0]).transform(data)
    return sliced.drop("features").withColumnRenamed("__used", "features")


def fit_and_score(data: DataFrame, est, split_col: str = "split") -> DataFrame:
    """Fit on split='train', predict both splits; (split, metric, value)."""
    model = est.fit(data.filter(F.col(split_col) == "train"))
    pred = model.transform(data)
    return classification_metrics(pred, "label", "prediction", by=[split_col])


def grid_search(data: DataFrame, est, grid, folds: int = 5, parallelism: int = 4, seed: int = 42, evaluator=None):
    """CrossValidator over ``grid`` on the training split with a deterministic fold column.

    Classifiers are scored by macro F1, regressors by the negative mean squared error, or by ``evaluator``. Returns
    (cv_model, table of (params, score)), the score named f1_macro, neg_mse or score; higher is better in the first
    two."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import Regressor
    from pyspark.ml.tuning import CrossValidator

    from tagloom.operators.evaluate import kfold_assign

    regression = isinstance(est, Regressor)
    name = "score" if evaluator is not None else "neg_mse" if regression else "f1_macro"
    if evaluator is None:
        evaluator = RegressionEvaluator(metricName="mse") if regression else MacroF1Evaluator()
    train = kfold_assign(data.filter(F.col("split") == "train"), folds, seed)
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=evaluator, foldCol="fold", numFolds=folds,
                        parallelism=parallelism, seed=seed)
    model = cv.fit(train)
    spark = data.sparkSession
    sign = -1.0 if name == "neg_mse" else 1.0
    rows = [(", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda x: x[0].name)), sign * float(m))
            for pm, m in zip(grid, model.avgMetrics)]
    return model, spark.createDataFrame(rows, f"params string, {name} double")


# ------------------------------------------------------------------ H9: SAMME AdaBoost over decision trees
def adaboost_samme(data: DataFrame, n_rounds: int = 20, learning_rate: float = 1.0, max_depth: int = 1,
                   n_classes: int | None = None, checkpoint_every: int = 5):
    """Multi-class AdaBoost (SAMME): each round fits a weighted tree; misclassified rows gain
    weight exp(alpha); the error is their share of all weight, so weights need no other norm. Returns (trees, alphas).
    Trees of depth 1 are found on the non-zero values (``_samme_stumps``). Deeper ones are MLlib's; their lineage is cut by
    checkpoint() into the shared checkpoint folder every few rounds."""
    if max_depth == 1:
        return _samme_stumps(data, n_rounds, learning_rate, n_classes)
    from pyspark.ml.classification import DecisionTreeClassifier

    from tagloom.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(data.sparkSession)  # checkpoint() below writes to the shared folder
    k = n_classes or data.select(F.max("label")).first()[0] + 1
    n = data.count()
    cur = training_frame(data.select("id", "label", "features")).withColumn("w", F.lit(1.0 / n))
    trees, alphas = [], []
    for r in range(n_rounds):
        dt = DecisionTreeClassifier(maxDepth=max_depth, weightCol="w", seed=42 + r, predictionCol="__p",
                                    rawPredictionCol="__raw", probabilityCol="__prob")
        m = dt.fit(cur)
        pred = m.transform(cur)
        wrong = (F.col("__p") != F.col("label")).cast("double")
        err = pred.agg((F.sum(F.col("w") * wrong) / F.sum("w")).alias("e")).first()["e"]
        if err is None or err >= 1.0 - 1.0 / k:
            break
        err = max(err, 1e-12)
        alpha = learning_rate * (math.log((1 - err) / err) + math.log(k - 1))
        trees.append(m)
        alphas.append(alpha)
        if err <= 1e-12:
            break
        cur = pred.select("id", "label", "features", (F.col("w") * F.exp(F.lit(alpha) * wrong)).alias("w"))
        if (r + 1) % checkpoint_every == 0:
            cur = cur.checkpoint()
    return trees, alphas


def _samme_stumps(data: DataFrame, n_rounds: int, learning_rate: float, n_classes: int | None):
    """(stumps, alphas). A round is one job over the written rows: a row's weight is an expression of the stumps so far, and
    the sums on both sides of the new one give its error and the next weights' sums."""
    rows = stump_rows(data) if is_bag(data) else materialize(stump_rows(data), "stump_rows")  # bags are a written table
    count = {int(r.label): r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}  # the classes
    k, n = int(n_classes or max(count) + 1), sum(count.values())
    totals, weight = np.array([float(count.get(c, 0)) for c in range(k)]), F.lit(1.0)
    stumps, alphas = [], []
    for _ in range(n_rounds):
        stump, left = best_stump(rows, weight, totals, n)
        sides = ((stump.left, left), (stump.right, np.maximum(totals - left, 0))) if stump.feature is not None else ((stump.left, totals),)
        err = 1 - sum(float(s[int(p)]) for p, s in sides) / float(totals.sum())
        if err >= 1.0 - 1.0 / k:
            break
        err = max(err, 1e-12)
        alpha = learning_rate * (math.log((1 - err) / err) + math.log(k - 1))
        stumps.append(stump)
        alphas.append(alpha)
        if err <= 1e-12:
            break
        weight = weight * F.when(stump.predict(F.col("vector")) != F.col("label"), F.lit(math.exp(alpha))).otherwise(F.lit(1.0))
        totals = sum(np.where(np.arange(k) == int(p), s, s * math.exp(alpha)) for p, s in sides)
    return stumps, alphas


def adaboost_predict(data: DataFrame, trees, alphas, n_classes: int) -> DataFrame:
    """Weighted vote of the SAMME trees: (id, label, prediction)."""
    votes = None
    out = data.select("id", "label", "features")
    for i, (m, a) in enumerate(zip(trees, alphas)):
        m = m.copy()
        m.setPredictionCol(f"__p{i}").setRawPredictionCol(f"__r{i}").setProbabilityCol(f"__q{i}")
        out = m.transform(out).drop(f"__r{i}", f"__q{i}")
    cols = []
    for c in range(n_classes):
        s = sum((F.when(F.col(f"__p{i}") == c, F.lit(a)).otherwise(0.0) for i, a in enumerate(alphas)), F.lit(0.0))
        cols.append(F.struct(s.alias("s"), F.lit(-c).alias("neg")))
    votes = F.greatest(*cols) if len(cols) > 1 else cols[0]
    return out.select("id", "label", (-votes["neg"]).cast("double").alias("prediction"))


# ------------------------------------------------------------------ H12: k-NN
def knn_classify(test: DataFrame, train: DataFrame, k: int = 50, id_col: str = "id", metric: str = "euclidean"):
    """Majority label of the k nearest training rows (ties: smallest label). test/train: (id, vector[, label]).
    Returns (id, prediction)."""
    nn = nearest(test.select(F.col(id_col).alias("qid"), "vector"),
                 train.select(F.col(id_col).cast("string").alias("item"), "vector"), k, metric)
    lab = train.select(F.col(id_col).cast("string").alias("item"), "label")
    votes = nn.join(lab, "item").groupBy("qid", "label").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("qid").agg(F.min_by("label", F.struct((-F.col("votes")).alias("v"), F.col("label"))).alias(
        "prediction"))
    return best.withColumnRenamed("qid", id_col)


def samme_staged_error(data: DataFrame, trees, alphas, n_classes: int, split_col: str = "split") -> DataFrame:
    """H18 for SAMME: (split, round, error) — the error of the weighted vote of the first r trees, for every r.
    Cumulative votes are column expressions over the per-tree predictions (rounds x classes sums per row), so the
    whole curve is one pass and one small aggregate."""
    out = data.select("id", "label", split_col, "features")
    for i, m in enumerate(trees):
        m = m.copy()
        m.setPredictionCol(f"__p{i}").setRawPredictionCol(f"__r{i}").setProbabilityCol(f"__q{i}")
        out = m.transform(out).drop(f"__r{i}", f"__q{i}")
    errs = []
    for r in range(len(trees)):
        cols = []
        for c in range(n_classes):
            v = sum((F.when(F.col(f"__p{i}") == c, F.lit(alphas[i])).otherwise(0.0) for i in range(r + 1)),
                    F.lit(0.0))
            cols.append(F.struct(v.alias("v"), F.lit(-c).alias("neg")))
        pred = -F.greatest(*cols)["neg"] if n_classes > 1 else F.lit(0)
        errs.append(F.avg((pred.cast("double") != F.col("label")).cast("double")).alias(f"e{r}"))
    agg = out.groupBy(split_col).agg(*errs)
    stacked = F.explode(F.array(*[F.struct(F.lit(r + 1).cast("bigint").alias("round"), F.col(f"e{r}").alias("error"))
                                  for r in range(len(trees))]))
    return agg.select(split_col, stacked.alias("s")).select(split_col, "s.round", F.round("s.error", 6).alias("error"))


def _nb_fold_predictions(tf_long: DataFrame, lab: DataFrame, alphas, fit_priors, k: int, eval_train: bool):
    """Predictions of k-fold multinomial NB for every (alpha, fit_prior) grid point, from one aggregation.

    One row for each term holds its count in every (fold, class). The model that fold g has not taken part in is the sum
    over all folds less that of g: an expression in the row, for every alpha. So k x |grid| models are one table of terms,
    made by one aggregation, and all documents are scored by one join with it. Each document is scored by the model of its own
    fold (split 'validate') and, with ``eval_train``, by the other k - 1 (split 'train').
    Returns (gi, alpha, fit_prior, g, split, id, truth, prediction)."""
    lab = lab.select("id", "label", F.col("fold").cast("int").alias("fold"))
    nd = {(r["fold"], r["label"]): r["nd"] for r in lab.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("nd")).collect()}
    labels = sorted({lb for _, lb in nd})
    t = tf_long.join(lab, "id")
    cell = lambda f, j: F.col(f"f{f}_{j}")
    wide = materialize(t.groupBy("term").agg(
        *[F.coalesce(F.sum(F.when((F.col("fold") == f) & (F.col("label") == F.lit(lb)), F.col("tf"))), F.lit(0)).alias(f"f{f}_{j}")
          for f in range(k) for j, lb in enumerate(labels)], F.count(F.lit(1)).alias("weight")), "nb_fold_counts")
    rest = lambda g, j: sum((cell(f, j) for f in range(k) if f != g), F.lit(0))
    seen_in = lambda g: sum((rest(g, j) for j in range(len(labels))), F.lit(0)) > 0
    # per model g: vocabulary size and token total per class, from one pass over the terms
    stats = wide.agg(*[F.sum(seen_in(g).cast("bigint")).alias(f"V{g}") for g in range(k)],
                     *[F.sum(rest(g, j)).alias(f"N{g}_{j}") for g in range(k) for j in range(len(labels))]).first()
    voc = {g: stats[f"V{g}"] or 0 for g in range(k)}
    tot = {(g, lb): stats[f"N{g}_{j}"] or 0 for g in range(k) for j, lb in enumerate(labels)}
    n_by_fold = {}
    for (f, _), v in nd.items():
        n_by_fold[f] = n_by_fold.get(f, 0) + v
    n_all = sum(n_by_fold.values())
    folds = range(k)

    def per_g(values):  # literal lookup by the model index g
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("g") + 1)

    g_col = F.explode(F.sequence(F.lit(0), F.lit(k - 1))) if eval_train else F.col("fold")
    tg = _terms_of(t.select("id", "term", "tf", "fold"), wide).withColumn("g", g_col)
    here = lambda j: F.element_at(F.array(*[rest(g, j) for g in range(k)]), F.col("g") + 1)
    tg = tg.select("id", "g", "tf", *[here(j).alias(f"n{j}") for j in range(len(labels))])
    known = sum((F.col(f"n{j}") for j in range(len(labels))), F.lit(0)) > 0
    sums = tg.where(known).groupBy("id", "g").agg(
        F.sum("tf").alias("L"),
        *[F.sum(F.when(F.col(f"n{j}") > 0, F.col("tf") * (F.log(F.col(f"n{j}") + F.lit(a)) - F.lit(math.log(a)))).otherwise(0.0)).alias(f"p{i}_{j}")
          for i, a in enumerate(alphas) for j in range(len(labels))])
    docs = lab.select("id", "fold", F.col("label").alias("truth"), g_col.alias("g")).join(sums, ["id", "g"], "left")
    label_arr = F.array(*[F.lit(x) for x in labels])
    points = []
    for i, a in enumerate(alphas):
        for fi, fp in enumerate(fit_priors):
            cands = []
            for j, lb in enumerate(labels):
                ndg = [sum(nd.get((f, lb), 0) for f in folds if f != g) for g in folds]
                docs_g = [n_all - n_by_fold.get(g, 0) for g in folds]
                # a class without training documents in model g is never predicted by it
                seen = [sum(any(nd.get((f, c), 0) for f in folds if f != g) for c in labels) for g in folds]
                prior = per_g([(math.log(x / y) if fp else -math.log(s)) if x > 0 else float("-inf")
                               for x, y, s in zip(ndg, docs_g, seen)])
                mass = [tot.get((g, lb), 0) + a * voc.get(g, 0) for g in folds]
                denom = per_g([math.log(m) if m > 0 else 0.0 for m in mass])
                score = (prior + F.coalesce("L", F.lit(0)) * (F.lit(math.log(a)) - denom)
                         + F.coalesce(F.col(f"p{i}_{j}"), F.lit(0.0)))
                cands.append(F.struct(score.alias("s"), F.lit(-j).alias("neg")))
            best = F.greatest(*cands) if len(cands) > 1 else cands[0]
            points.append(F.struct(F.lit(i * len(fit_priors) + fi).alias("gi"), F.lit(float(a)).alias("alpha"),
                                   F.lit(bool(fp)).alias("fit_prior"),
                                   F.element_at(label_arr, (F.lit(1) - best["neg"]).cast("int")).alias("prediction")))
    pred = docs.select("id", "fold", "g", "truth", F.explode(F.array(*points)).alias("p")).select(
        "p.gi", "p.alpha", "p.fit_prior", "g", "fold", "id", "truth", "p.prediction")
    return pred.withColumn("split", F.when(F.col("fold") == F.col("g"), F.lit("validate")).otherwise(F.lit("train")))


def nb_holdout_predictions(docs: DataFrame, k: int, alpha: float = 1.0) -> DataFrame:
    """(fold, split, label, prediction) by multinomial NB as MLlib fits it: the vocabulary is that of all training rows, also
    for a model that has not seen some of it, and priors are smoothed by ``alpha``, too.

    ``docs``: (label, fold, tokens), a row for each document; folds 0 to k - 1 are the training rows, k the test rows. Each
    fold's model predicts all training rows (split 'validate' for its own fold, else 'train'); the model of all of them the
    test rows (fold -1, split 'test'). No vocabulary is on the driver: one table of terms holds the counts of every (fold,
    class), and all models are expressions in its rows."""
    docs = materialize(docs.select(F.monotonically_increasing_id().alias("id"), "label", F.col("fold").cast("int").alias("fold"), "tokens"), "nb_docs")
    nd = {(r.fold, r.label): r.n for r in docs.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()}
    seen = {c for f, c in nd if f < k}
    if None in {c for _, c in nd} or {c for _, c in nd} - seen:
        raise ValueError("every label must be one that training rows have")
    labels, folds = sorted(seen), range(k)
    bag = materialize(docs.select("id", "label", "fold", F.inline(run_lengths("tokens"))), "nb_bag")
    cell = lambda f, j: F.col(f"f{f}_{j}")
    wide = materialize(bag.groupBy("term").agg(
        *[F.coalesce(F.sum(F.when((F.col("fold") == f) & (F.col("label") == F.lit(lb)), F.col("tf"))), F.lit(0)).alias(f"f{f}_{j}")
          for f in folds for j, lb in enumerate(labels)],
        F.count(F.when(F.col("fold") < k, 1)).alias("known"), F.count(F.lit(1)).alias("weight")).where("known > 0").drop("known"), "nb_fold_counts")
    # model k has seen all folds
    rest = lambda g, j: sum((cell(f, j) for f in folds if f != g), F.lit(0))
    stats = wide.agg(F.count("*").alias("V"), *[F.sum(rest(g, j)).alias(f"N{g}_{j}") for g in range(k + 1) for j in range(len(labels))]).first()
    test = F.col("fold") == k
    # a training row has a place for each fold's model; a test row's first place is for the model of all
    count = lambda g, j: F.when(test, rest(k, j)).otherwise(rest(g, j)) if g == 0 else rest(g, j)
    sums = _terms_of(bag.select("id", "term", "tf", "fold"), wide).groupBy("id").agg(
        F.sum("tf").alias("L"), *[F.sum(F.col("tf") * F.log(count(g, j) + F.lit(alpha))).alias(f"p{g}_{j}") for g in folds for j in range(len(labels))])

    def best(g, place):
        n = [sum(nd.get((f, lb), 0) for f in folds if f != g) for lb in labels]
        smooth = math.log(sum(n) + alpha * sum(x > 0 for x in n)) if sum(n) else 0.0
        scores = [F.lit(math.log(x + alpha) - smooth if x else float("-inf")) + F.coalesce(F.col(f"p{place}_{j}"), F.lit(0.0))
                  - F.coalesce(F.col("L"), F.lit(0)) * F.lit(math.log((stats[f"N{g}_{j}"] or 0) + alpha * max(stats["V"], 1))) for j, x in enumerate(n)]
        cands = [F.struct(x.alias("s"), F.lit(-j).alias("neg")) for j, x in enumerate(scores)]
        top = F.greatest(*cands) if len(cands) > 1 else cands[0]
        said = F.element_at(F.array(*[F.lit(x) for x in labels]), (F.lit(1) - top["neg"]).cast("int"))
        return F.struct(F.lit(-1 if g == k else g).alias("fold"), said.alias("prediction"))

    scored = docs.select("id", "label", F.col("fold").alias("own")).join(sums, "id", "left")
    own = F.col("own") == k
    p = F.explode(F.when(own, F.array(best(k, 0))).otherwise(F.array(*[best(g, g) for g in folds])))
    split = F.when(own, "test").when(F.col("own") == F.col("p.fold"), "validate").otherwise("train")
    return scored.select("label", "own", p.alias("p")).select("p.fold", split.alias("split"), "label", "p.prediction")


def nb_grid_kfold(tf_long: DataFrame, lab: DataFrame, alphas=(0.1, 0.5, 1.0, 2.0), fit_priors=(True, False),
                  k: int = 5) -> DataFrame:
    """H3 in one pass: multinomial NB for every (alpha, fit_prior) x fold, scored by mean validation macro F1.
    lab: (id, label, fold) of the training split. Returns (alpha, fit_prior, f1_macro, best) with best = highest
    F1, ties to grid order."""
    pred = _nb_fold_predictions(tf_long, lab, alphas, fit_priors, k, eval_train=False)
    m = classification_metrics(pred, "truth", "prediction", by=["gi", "alpha", "fit_prior", "g"])
    f1 = m.filter(F.col("metric") == "f1_macro").groupBy("gi", "alpha", "fit_prior").agg(
        F.round(F.avg("value"), 6).alias("f1_macro"))
    from pyspark.sql import Window

    w = Window.orderBy(F.col("f1_macro").desc(), F.col("gi").asc())  # |grid| rows
    return f1.withColumn("best", F.row_number().over(w) == 1).select("alpha", "fit_prior", "f1_macro", "best")


def nb_kfold_metrics(tf_long: DataFrame, lab: DataFrame, alpha: float = 1.0, fit_prior: bool = True,
                     k: int = 5) -> DataFrame:
    """H14-H16 for naive Bayes in one pass: (fold, split in {train, validate}, metric, value), a fresh model per
    fold fitted on the other folds."""
    pred = _nb_fold_predictions(tf_long, lab, (alpha,), (fit_prior,), k, eval_train=True)
    m = classification_metrics(pred, "truth", "prediction", by=["g", "split"])
    return m.select(F.col("g").cast("bigint").alias("fold"), "split", "metric", "value")

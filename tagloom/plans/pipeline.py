"""The facade — a named pipeline with preprocess, featurize, model and evaluate steps.

Artefacts (prepared posts, token and tag counts) are written as parquet under ``<root>/<name>/`` in the shared
checkpoint folder unless a root is given.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators import classify, clean, embed, evaluate, multilabel, profile
from tagloom.operators.columns import label_mapping, thread_label_encode
from tagloom.session import ensure_checkpoint_dir, materialize
from tagloom.sources import files

TARGETS = ("thread", "tag_counts", "tag_bool")
VECTORIZERS = ("bow", "tfidf", "word2vec", "doc2vec")
MODELS = ("nb", "rf", "ovr_lr", "ovr_svc", "ovr_gbt")


@dataclass
class Pipeline:
    spark: SparkSession
    name: str
    root: str | None = None
    prepared: DataFrame | None = None
    data: DataFrame | None = None
    labels: list = field(default_factory=list)
    model_name: str | None = None
    target: str = "thread"
    vectorizer: str = "bow"
    params: dict = field(default_factory=dict)

    def path(self, what: str) -> str:
        base = self.root or f"{ensure_checkpoint_dir(self.spark)}/pipelines"
        return f"{base}/{self.name}/{what}"

    def preprocess(self, posts: DataFrame, title_weight: int = 3, **clean_kw) -> "Pipeline":
        """C11 + counts (D1/D2), all persisted (A4/A5)."""
        prepared = clean.prepare_posts(posts, title_weight=title_weight, **clean_kw)
        files.save_dataset(prepared, self.path("posts"))
        self.prepared = files.load_dataset(self.spark, self.path("posts"))
        files.save_dataset(profile.token_counts(self.prepared), self.path("token_counts"), None)
        files.save_dataset(profile.tag_counts(self.prepared), self.path("tag_counts"), None)
        return self

    def counts(self, which: str = "token_counts") -> DataFrame:
        return files.load_dataset(self.spark, self.path(which))

    def featurize(self, vectorizer: str = "bow", predict_target: str = "thread", dims: int = 64) -> "Pipeline":
        """Features of the prepared posts. ``bow`` and ``tfidf`` are sparse; ``word2vec`` and ``doc2vec`` are mean vectors of the
        posts' words, the latter's trained with the posts' tags among them. With a tag target (``tag_counts``, ``tag_bool``)
        there is a model for every tag, on hashed terms; both targets are binary there."""
        if vectorizer not in VECTORIZERS:
            raise ValueError(f"vectorizer must be one of {VECTORIZERS}")
        if predict_target not in TARGETS:
            raise ValueError(f"predict_target must be one of {TARGETS}")
        if self.prepared is None:
            raise RuntimeError("call preprocess() first")
        split = classify.train_test_split(self.prepared)
        self.target, self.vectorizer = predict_target, vectorizer
        if predict_target != "thread":
            if vectorizer not in ("bow", "tfidf"):
                raise ValueError("models of all tags take bow or tfidf")
            self.data = split
        elif vectorizer in ("bow", "tfidf"):
            self.data = split  # vectors are made for the models that take them
        else:
            train = split.filter(F.col("split") == "train")
            model = embed.tag_aware_embedding(train, vector_size=dims) if vectorizer == "doc2vec" else embed.word2vec_train(train, vector_size=dims)
            means = embed.doc_embedding_matrix(split, embed.model_vectors(model))
            mean = F.coalesce("vector", F.array_repeat(F.lit(0.0), dims))
            mapping = label_mapping(split, "thread")
            coded = thread_label_encode(split, mapping, "thread", "label").withColumn("label", F.col("label").cast("double"))
            self.data = materialize(coded.join(means.select("id", mean.alias("v")), "id").select("id", "thread", "split", "label", array_to_vector("v").alias("features")), "pipeline_features")
            self.labels = [r[0] for r in split.select("thread").distinct().orderBy("thread").collect()]
        return self

    def model(self, name: str = "nb", **params) -> "Pipeline":
        if name not in MODELS:
            raise ValueError(f"model must be one of {MODELS}")
        if self.data is None:
            raise RuntimeError("call featurize() first")
        if name == "nb" and self.vectorizer in ("word2vec", "doc2vec"):
            raise ValueError("naive Bayes needs non-negative features, not word vectors")
        if self.target != "thread" and name not in ("nb", "ovr_svc"):
            raise ValueError("models of all tags are nb or ovr_svc")
        self.model_name, self.params = name, params
        return self

    def evaluate(self, k: int = 5) -> DataFrame:
        """k-fold CV on the training split (a fresh model per fold) plus the untouched test split:
        (fold, split, metric, value) with fold = -1 for the hold-out evaluation. Tag targets have the hold-out evaluation
        only: micro and macro scores over all tags."""
        if self.model_name is None:
            raise RuntimeError("call model() first")
        if self.target != "thread":
            return self._evaluate_tags()
        if self.vectorizer == "bow" and self.model_name == "nb":
            return self._evaluate_bayes(k)
        if self.vectorizer in ("bow", "tfidf") and "features" not in self.data.columns:
            self.data, self.labels = classify.labelled_features(self.data, "tokens", "thread", self.vectorizer,
                                                                fit_on=self.data.filter(F.col("split") == "train"))
        train = evaluate.kfold_assign(self.data.filter(F.col("split") == "train"), k, 42)
        out = None
        for f in range(k):
            m = classify.estimator(self.model_name, **self.params).fit(train.filter(F.col("fold") != f))
            pred = m.transform(train).withColumn(
                "split", F.when(F.col("fold") == f, F.lit("validate")).otherwise(F.lit("train")))
            part = evaluate.classification_metrics(pred, by=["split"]).withColumn("fold", F.lit(f))
            out = part if out is None else out.unionByName(part)
        final = classify.estimator(self.model_name, **self.params).fit(self.data.filter(F.col("split") == "train"))
        hold = final.transform(self.data.filter(F.col("split") == "test"))
        part = evaluate.classification_metrics(hold, by=["split"]).withColumn("fold", F.lit(-1))
        return out.unionByName(part).select(F.col("fold").cast("bigint"), "split", "metric", "value")

    def _evaluate_bayes(self, k: int) -> DataFrame:
        """The same table for naive Bayes on all terms' counts: neither vocabulary nor model is on the driver."""
        dealt = evaluate.kfold_assign(self.data, k, 42)
        rows = dealt.select(F.col("thread").alias("label"), F.when(F.col("split") == "test", k).otherwise(F.col("fold")).alias("fold"), "tokens")
        pred = materialize(classify.nb_holdout_predictions(rows, k, self.params.get("smoothing", 1.0)), "pipeline_predictions")
        self.labels = sorted(r[0] for r in rows.where(F.col("fold") < k).select("label").distinct().collect())
        return evaluate.classification_metrics(pred, by=["fold", "split"]).select(F.col("fold").cast("bigint"), "split", "metric", "value")

    def tag_counts(self) -> DataFrame:
        """Per tag and split: posts, posts with the tag, posts predicted, and both (``multilabel.COUNTS``)."""
        posts = self.data.select("id", "split", "tokens")
        pairs = self.data.select("id", F.explode("tags").alias("tag"))
        fit = multilabel.multilabel_nb if self.model_name == "nb" else multilabel.multilabel_svc
        return fit(posts, pairs, **self.params)

    def _evaluate_tags(self) -> DataFrame:
        counts = materialize(self.tag_counts(), "pipeline_tags")
        ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
        f1 = ratio(2 * F.col("tp"), F.col("n_true") + F.col("n_pred"))
        total = {c: F.sum(c) for c in ("n", "n_true", "n_pred", "tp")}
        wrong = total["n_true"] + total["n_pred"] - 2 * total["tp"]
        scores = counts.groupBy("split").agg(
            ratio(total["n"] - wrong, total["n"]).alias("accuracy"), ratio(total["tp"], total["n_pred"]).alias("precision_micro"),
            ratio(total["tp"], total["n_true"]).alias("recall_micro"), ratio(2 * total["tp"], total["n_true"] + total["n_pred"]).alias("f1_micro"), F.avg(f1).alias("f1_macro"))
        names = [c for c in scores.columns if c != "split"]
        cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.round(c, 6).alias("value")) for c in names])
        return scores.select("split", F.explode(cells).alias("m")).select(F.lit(-1).cast("bigint").alias("fold"), "split", "m.metric", "m.value")

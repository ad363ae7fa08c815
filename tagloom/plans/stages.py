"""Cleaning, TF-IDF and naive Bayes as stages of a ``pyspark.ml`` pipeline that is saved and loaded.

A fitted stage is its parameters and some tables (lexicons, document frequencies, class weights). The parameters are saved
as ``pyspark.ml`` saves them, the tables as Parquet beside them; a loaded stage reads its tables in the session of the data
it is applied to. So nothing that grows with the corpus passes through the driver on its way to the disk and back.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import corpus_tokens
from tagloom.operators import classify, clean, features


def _param(name: str, doc: str, kind=TypeConverters.toString) -> Param:
    return Param(Params._dummy(), name, doc, kind)


class _TablesWriter(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        tables = self.stage.tables()
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata={"tables": sorted(tables)})
        for name, table in tables.items():
            table.write.parquet(f"{path}/tables/{name}")


class _TablesReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage._saved, stage._held = (path, metadata["tables"]), {}
        return stage


class WithTables(MLWritable, MLReadable):
    """A stage whose state is tables: held as DataFrames after fitting, read from where it was saved after loading."""

    _saved, _held = None, {}

    def _with(self, **tables):
        self._held = {k: v for k, v in tables.items() if v is not None}
        return self

    def table(self, name: str, spark) -> DataFrame | None:
        if self._saved is None:
            return self._held.get(name)
        path, names = self._saved
        return spark.read.parquet(f"{path}/tables/{name}") if name in names else None

    def tables(self) -> dict[str, DataFrame]:
        if self._saved is None:
            return self._held
        from pyspark.sql import SparkSession

        return {n: self.table(n, SparkSession.active()) for n in self._saved[1]}

    def write(self) -> MLWriter:
        return _TablesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TablesReader(cls)

    def copy(self, extra=None):
        that = super().copy(extra)
        that._saved, that._held = self._saved, self._held
        return that


class PostTokens(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``outputCol``: the corpus tokens of ``inputCols``, one text after the other."""

    inputCols = _param("inputCols", "text columns", TypeConverters.toListString)
    outputCol = _param("outputCol", "token array")

    @keyword_only
    def __init__(self, *, inputCols=("title", "content"), outputCol="tokens"):
        super().__init__()
        self._set(inputCols=list(inputCols), outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOrDefault("outputCol"), corpus_tokens(F.concat_ws("\n", *self.getOrDefault("inputCols"))))


class CleanPosts(Transformer, WithTables):
    """Adds ``outputCol``: tokens of ``inputCol`` cleaned as by ``clean.clean_data``; its lexicons are saved with it. A step
    without a lexicon does what it does there (the default stop list, lower case instead of entities)."""

    inputCol, outputCol, order = _param("inputCol", "text"), _param("outputCol", "token array"), _param("order", "default or legacy")
    steps = _param("steps", "steps that are done: html, punctuation, entities, stopwords, lemmas", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCol="text", outputCol="tokens", order="default",
                 steps=("html", "punctuation", "entities", "stopwords", "lemmas")):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, order=order, steps=list(steps))

    def setLexicons(self, stop_words=None, entities=None, lemmas=None) -> "CleanPosts":
        return self._with(stop_words=stop_words, entities=entities, lemmas=lemmas)

    def _transform(self, df: DataFrame) -> DataFrame:
        text, out, steps = self.getOrDefault("inputCol"), self.getOrDefault("outputCol"), self.getOrDefault("steps")
        lexicon = {n: self.table(n, df.sparkSession) for n in ("stop_words", "entities", "lemmas")}
        first, *rest = [c for c in df.columns if c != out]
        return clean.clean_data(df, text, first, keep=rest, html="html" in steps, rem_punc="punctuation" in steps, ner="entities" in steps,
                                rem_stopwords="stopwords" in steps, lemmatize="lemmas" in steps, order=self.getOrDefault("order"), out=out, **lexicon)


class TfidfTerms(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns document frequencies of the tokens in ``inputCol``; rows are documents."""

    inputCol, outputCol, idCol = _param("inputCol", "token array"), _param("outputCol", "terms"), _param("idCol", "unique row key")

    @keyword_only
    def __init__(self, *, inputCol="tokens", outputCol="terms", idCol="id"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, idCol=idCol)

    def _fit(self, df: DataFrame) -> "TfidfTermsModel":
        bag = features.bag_of_words(df, self.getOrDefault("idCol"), self.getOrDefault("inputCol"))
        n = df.count()
        idf = features.inverse_document_frequency(features.document_frequency(bag), n)
        model = TfidfTermsModel()._with(idf=idf)
        return self._copyValues(model)


class TfidfTermsModel(Model, WithTables):
    """Adds ``outputCol``: array of (term, tf, tfidf) in term order, of unit length; terms that no fitted document has are
    left out, rows without any have an empty array."""

    inputCol, outputCol, idCol = TfidfTerms.inputCol, TfidfTerms.outputCol, TfidfTerms.idCol

    def _transform(self, df: DataFrame) -> DataFrame:
        key, out = self.getOrDefault("idCol"), self.getOrDefault("outputCol")
        bag = features.bag_of_words(df, key, self.getOrDefault("inputCol"))
        w = features.weighted_terms(bag, self.table("idf", df.sparkSession))
        terms = w.groupBy(F.col("id").alias("__id")).agg(F.array_sort(F.collect_list(F.struct("term", "tf", "tfidf"))).alias("__terms"))  # one document's terms
        empty = F.array().cast("array<struct<term:string,tf:bigint,tfidf:double>>")
        return df.join(terms, F.col(key) == F.col("__id"), "left").withColumn(out, F.coalesce("__terms", empty)).drop("__id", "__terms")


class TermBayes(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Multinomial naive Bayes over token arrays (``classify.nb_fit``)."""

    inputCol, labelCol, idCol = _param("inputCol", "token array"), _param("labelCol", "class"), _param("idCol", "unique row key")
    predictionCol = _param("predictionCol", "predicted class")
    alpha = _param("alpha", "added to every count", TypeConverters.toFloat)
    fitPrior = _param("fitPrior", "class shares as prior", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCol="tokens", labelCol="thread", idCol="id", predictionCol="prediction", alpha=1.0, fitPrior=True):
        super().__init__()
        self._set(inputCol=inputCol, labelCol=labelCol, idCol=idCol, predictionCol=predictionCol, alpha=alpha, fitPrior=fitPrior)

    def _fit(self, df: DataFrame) -> "TermBayesModel":
        key, label = self.getOrDefault("idCol"), self.getOrDefault("labelCol")
        bag = features.bag_of_words(df, key, self.getOrDefault("inputCol"))
        fitted = classify.nb_fit(bag, df.select(F.col(key).alias("id"), F.col(label).alias("label")), self.getOrDefault("alpha"), self.getOrDefault("fitPrior"))
        return self._copyValues(TermBayesModel()._with(classes=fitted.classes, weights=fitted.weights))


class TermBayesModel(Model, WithTables):
    """Adds ``predictionCol``. Ids must be unique."""

    inputCol, labelCol, idCol, predictionCol = TermBayes.inputCol, TermBayes.labelCol, TermBayes.idCol, TermBayes.predictionCol
    alpha, fitPrior = TermBayes.alpha, TermBayes.fitPrior

    def fitted(self, spark) -> classify.NBModel:
        classes, weights = self.table("classes", spark), self.table("weights", spark)
        labels = sorted(r.label for r in classes.select("label").collect())  # one row for each class
        return classify.NBModel(classes, weights, weights.select("term").distinct(), labels, self.getOrDefault("alpha"))

    def _transform(self, df: DataFrame) -> DataFrame:
        key, out = self.getOrDefault("idCol"), self.getOrDefault("predictionCol")
        ids = df.select(F.col(key).alias("id"))
        said = classify.nb_predict(self.fitted(df.sparkSession), features.bag_of_words(df, key, self.getOrDefault("inputCol")), ids)
        return df.join(said.select(F.col("id").alias("__id"), F.col("prediction").alias(out)), F.col(key) == F.col("__id")).drop("__id")

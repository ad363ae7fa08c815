"""Fold assignment, macro metrics, k-fold summary, confusion matrix, staged boosting error, MSE.

Metrics are aggregates over a (group, label, prediction) count table — at most classes^2 rows per group — so no
prediction ever reaches the driver. Macro averages follow the common convention: classes = labels seen in truth or
prediction, 0/0 -> 0.
"""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.hashing import hash_bucket

METRICS = ["accuracy", "precision_macro", "recall_macro", "f1_macro"]


def kfold_assign(df: DataFrame, k: int = 5, seed=42, id_col: str = "id", out: str = "fold") -> DataFrame:
    """fold = md5(seed|id) mod k (int, as CrossValidator's foldCol requires). No global sort."""
    return df.withColumn(out, hash_bucket(id_col, k, seed).cast("int"))


def per_class_counts(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction", by=()) -> DataFrame:
    """(by..., cls, tp, n_true, n_pred)."""
    by = list(by)
    conf = pred.groupBy(*by, label_col, pred_col).agg(F.count(F.lit(1)).alias("n"))
    sides = F.explode(F.array(
        F.struct(F.col(label_col).cast("string").alias("cls"), F.col("n").alias("t"), F.lit(0).cast("bigint").alias("p"),
                 F.when(F.col(label_col) == F.col(pred_col), F.col("n")).otherwise(0).cast("bigint").alias("tp")),
        F.struct(F.col(pred_col).cast("string").alias("cls"), F.lit(0).cast("bigint").alias("t"), F.col("n").alias("p"),
                 F.lit(0).cast("bigint").alias("tp")),
    ))
    return conf.select(*by, sides.alias("s")).groupBy(*by, F.col("s.cls").alias("cls")).agg(
        F.sum("s.tp").alias("tp"), F.sum("s.t").alias("n_true"), F.sum("s.p").alias("n_pred"))


def classification_metrics(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction", by=(),
                           digits: int = 6) -> DataFrame:
    """Long (by..., metric, value) with accuracy and macro precision / recall / F1."""
    by = list(by)
    pc = per_class_counts(pred, label_col, pred_col, by)
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0)
    rec = F.when(F.col("n_true") > 0, F.col("tp") / F.col("n_true")).otherwise(0.0)
    f1 = F.when(F.col("n_true") + F.col("n_pred") > 0,
                2.0 * F.col("tp") / (F.col("n_true") + F.col("n_pred"))).otherwise(0.0)
    agg = pc.groupBy(*by).agg(
        (F.sum("tp") / F.sum("n_true")).alias("accuracy"),
        F.avg(prec).alias("precision_macro"), F.avg(rec).alias("recall_macro"), F.avg(f1).alias("f1_macro"),
    )
    stacked = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS]))
    return agg.select(*by, stacked.alias("m")).select(*by, "m.metric", F.round("m.value", digits).alias("value"))


def kfold_summary(metrics_long: DataFrame, split_col: str = "split") -> DataFrame:
    """Mean of each metric over folds, one row per split, one column per metric."""
    return metrics_long.groupBy(split_col).pivot("metric", METRICS).agg(F.round(F.avg("value"), 6))


def confusion_matrix(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction", by=()) -> DataFrame:
    """(by..., actual, predicted, count, share) with share normalised over each actual class."""
    by = list(by)
    c = pred.groupBy(*by, F.col(label_col).alias("actual"), F.col(pred_col).alias("predicted")).agg(
        F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(*by, "actual")  # at most classes rows per partition
    return c.withColumn("share", F.round(F.col("count") / F.sum("count").over(w), 6))


def mse_score(pred: DataFrame, y: str = "label", yhat: str = "prediction", by=()) -> DataFrame:
    """Mean squared error (and its negation, the tuning score)."""
    m = pred.groupBy(*by).agg(F.avg((F.col(y).cast("double") - F.col(yhat).cast("double")) ** 2).alias("mse"))
    return m.select(*by, F.round("mse", 6).alias("mse"), F.round(F.lit(0.0) - F.col("mse"), 6).alias("neg_mse"))


def staged_error(scores: DataFrame, labels: DataFrame, id_col: str = "id", by=()) -> DataFrame:
    """Error after each boosting round from a long score table (id, round, score) of per-round additive
    contributions and labels (id, label in {0,1}, by...). Cumulative sums run per id over at most #rounds rows."""
    by = list(by)
    w = Window.partitionBy(id_col).orderBy("round").rowsBetween(Window.unboundedPreceding, 0)
    cum = scores.withColumn("F", F.sum("score").over(w)).join(labels, id_col)
    wrong = (F.when(F.col("F") > 0, 1).otherwise(0) != F.col("label")).cast("double")
    return cum.groupBy(*by, "round").agg(F.round(F.avg(wrong), 6).alias("error"))


class MacroF1Evaluator(Evaluator):
    """Macro F1 for CrossValidator / TrainValidationSplit (MLlib's evaluators have no macro average)."""

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self.labelCol = labelCol
        self.predictionCol = predictionCol

    def _evaluate(self, dataset: DataFrame) -> float:
        m = classification_metrics(dataset, self.labelCol, self.predictionCol, digits=12)
        row = m.filter(F.col("metric") == "f1_macro").first()
        return float(row["value"]) if row else 0.0

    def isLargerBetter(self) -> bool:
        return True

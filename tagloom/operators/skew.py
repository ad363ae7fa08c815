"""Joins whose hot keys do not land in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it has more than this share of the rows; so there are less than 1 / HEAVY heavy keys, ever.
HEAVY = 1 / 5000


def heavy_join(left: DataFrame, right: DataFrame, on: str, weight: Column, how: str = "inner", share: float = HEAVY) -> DataFrame:
    """``left`` joined to ``right`` (one row for each key) on ``on``, ``inner`` or ``left``.

    ``weight``, over ``right``, is how many rows of ``left`` have the key. Rows of heavy keys stay where they are: the
    heavy part of ``right`` has less than 1 / ``share`` rows by arithmetic, and is broadcast. All other rows shuffle, and
    no key of theirs has more than ``share`` of the whole, so no task gets a hot key, with or without adaptive execution.
    There ``right`` is hashed: its rows are one for each key, while sorting those of ``left`` would spill them.
    A null key matches nothing."""
    if how not in ("inner", "left"):
        raise ValueError(f"how is inner or left, not {how}")
    total = right.agg(F.sum(weight).cast("double").alias("total")).first().total or 0.0
    heavy = weight.cast("double") > F.lit(total * share)
    key = "__heavy_key"
    # nulls stay beside the heavy keys: they meet nothing and need no exchange
    hot = right.where(heavy).withColumnRenamed(on, key)
    known = hot.select(F.col(key).alias("__known"))
    here = left.join(F.broadcast(known), F.col(on) == F.col("__known"), "left_semi")
    there = left.join(F.broadcast(known), F.col(on) == F.col("__known"), "left_anti")
    near = here.join(F.broadcast(hot), F.col(on) == F.col(key)).drop(key)
    lone = there.where(F.col(on).isNull())
    far = there.where(F.col(on).isNotNull()).join(right.where(~heavy).withColumnRenamed(on, key).hint("shuffle_hash"), F.col(on) == F.col(key), how).drop(key)
    out = near.unionByName(far)
    return out.unionByName(lone, allowMissingColumns=True) if how == "left" else out

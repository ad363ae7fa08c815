"""Deterministic hash columns: stable across runs, partitionings and engines (the SQL oracle computes the same)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _key(col, seed) -> Column:
    c = (F.col(col) if isinstance(col, str) else col).cast("string")
    return c if seed is None else F.concat(F.lit(f"{seed}|"), c)


def md5_prefix_int(col, seed=None) -> Column:
    """First 32 bits of md5(key) as a non-negative bigint."""
    return F.conv(F.substring(F.md5(_key(col, seed)), 1, 8), 16, 10).cast("bigint")


def hash_bucket(col, buckets: int, seed=None) -> Column:
    """Bucket 0..buckets-1 from md5 of the key (train/test split, k-fold assignment)."""
    return (md5_prefix_int(col, seed) % F.lit(buckets)).cast("bigint")


def uniform01(col, seed=None) -> Column:
    """Pseudo-uniform value in [0, 1) from md5 of the key."""
    return md5_prefix_int(col, seed) / F.lit(4294967296.0)

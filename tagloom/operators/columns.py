"""Projections, label encoding, filters and deterministic row selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.hashing import hash_bucket, md5_prefix_int


def title_weighting(df: DataFrame, title_col: str = "title", n: int = 3, out: str = "triple_title") -> DataFrame:
    """B1: ' ' + title repeated n times (weights the title n-fold in later counts)."""
    return df.withColumn(out, F.repeat(F.concat(F.lit(" "), F.col(title_col)), n))


def concat_features(df: DataFrame, first: str, second: str, out: str = "ttl_ctxt", sep: str = "") -> DataFrame:
    """B2: first + sep + second; null in either gives null (no silent skipping)."""
    return df.withColumn(out, F.concat(F.col(first), F.lit(sep), F.col(second)))


def label_mapping(df: DataFrame, col: str = "thread") -> dict[str, int]:
    """Alphabetical class ids (same as StringIndexer alphabetAsc). The distinct class list is tiny; it is the
    only thing that reaches the driver."""
    names = sorted(r[0] for r in df.select(col).distinct().collect() if r[0] is not None)
    return {name: i for i, name in enumerate(names)}


def thread_label_encode(df: DataFrame, mapping: dict[str, int] | None = None, col: str = "thread",
                        out: str = "thread_id") -> DataFrame:
    """Class name -> id with a fixed dictionary; an unknown name raises an error at run time.
    The dictionary is a literal map inside the projection (no join, no shuffle)."""
    mapping = mapping if mapping is not None else label_mapping(df, col)
    lookup = F.create_map(*[x for k, v in sorted(mapping.items()) for x in (F.lit(k), F.lit(int(v)))])
    value = F.try_element_at(lookup, F.col(col)).cast("bigint")
    checked = F.when(
        value.isNull(), F.raise_error(F.concat(F.lit(f"unknown {col}: "), F.coalesce(F.col(col), F.lit("null"))))
    ).otherwise(value)
    return df.withColumn(out, checked.cast("bigint"))


def filter_thread(df: DataFrame, thread: str, col: str = "thread") -> DataFrame:
    """B4 (pushed into the scan / partition pruning when the column is a partition column)."""
    return df.filter(F.col(col) == F.lit(thread))


def distinct_threads(df: DataFrame, col: str = "thread") -> DataFrame:
    """B5."""
    return df.select(col).distinct().orderBy(col)


def view_post(df: DataFrame, ids=None, n: int = 3, seed=None,
              columns=("id", "thread", "title", "content", "tags")) -> DataFrame:
    """Given posts by id, or a deterministic pseudo-random sample of n posts (order by md5(seed|id))."""
    sel = df.select(*columns)
    if ids is not None:
        return sel.filter(F.col("id").isin(list(ids)))
    return sel.orderBy(md5_prefix_int("id", seed), F.col("id")).limit(n)


def train_head_n(df: DataFrame, n: int, seed=None, buckets: int = 4) -> DataFrame:
    """First n training rows (hash bucket != 0) in a stable pseudo-random order."""
    train = df.filter(hash_bucket("id", buckets, seed) != 0)
    return train.orderBy(md5_prefix_int("id", "order" if seed is None else f"order{seed}"), F.col("id")).limit(n)


def predict_target(df: DataFrame, target: str = "thread", tag_vocab: DataFrame | None = None,
                   tokens_col: str = "tokens") -> DataFrame:
    """Supervision target. 'thread' -> (id, label); 'tag_counts' / 'tag_bool' -> long (id, tag, value)."""
    if target == "thread":
        return thread_label_encode(df, out="label").select("id", "label")
    from tagloom.operators.features import tag_freq_in_post, tags_in_post

    if tag_vocab is None:
        raise ValueError("tag targets need tag_vocab (term column)")
    if target == "tag_counts":
        return tag_freq_in_post(df, tag_vocab, tokens_col).withColumnRenamed("tf", "value")
    if target == "tag_bool":
        return tags_in_post(df, tag_vocab, tokens_col).withColumn("value", F.lit(1).cast("bigint"))
    raise ValueError(f"unknown target {target!r}; expected thread, tag_counts or tag_bool")

"""Sharding by sampled splitters, DataFrame expressions only."""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.session import materialize


def _range_of(splitters: list[tuple[int, int]]) -> Column:
    """Number of splitters at or below (key, doc_id): a coarse step over every ``step``-th splitter, a fine one in
    between, so a row compares with about 2 * sqrt(splitters) of them."""
    if not splitters:
        return F.lit(0)
    step = max(1, int(len(splitters) ** 0.5))
    # one text constant, which Spark folds into an array, instead of thousands of expressions
    lit = lambda rows: F.from_json(F.lit(json.dumps([{"k": k, "d": d} for k, d in rows])), "array<struct<k: bigint, d: bigint>>")
    me = F.struct(F.col("key").alias("k"), F.col("d").alias("d"))
    coarse = F.size(F.filter(lit(splitters[::step]), lambda s: s <= me))
    fine = lambda c: F.when(c == 0, 0).otherwise(
        (c - 1) * step + F.size(F.filter(F.slice(lit(splitters), (c - 1) * step + 1, F.lit(step)), lambda s: s <= me)))
    return F.get(F.transform(F.array(coarse), fine), F.lit(0)).cast("int")


def _sample(keys: DataFrame, rate: float, seed: int) -> list:
    """Size-weighted key samples: a row is drawn with probability min(1, rate * size); a drawn row stands for
    max(1, rate * size) draws."""
    u = F.pmod(F.xxhash64("d", "key", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    drawn = keys.where(u < F.col("size") * rate).select("key", "d", F.greatest(F.lit(1.0), F.col("size") * rate).alias("w"))
    return sorted((r.key, r.d, r.w) for r in drawn.collect())


def _quantiles(sample: list, parts: int, hot: set[int]) -> set[tuple[int, int]]:
    """Weighted quantiles of the sample. Only a hot key is cut inside (by doc_id); other keys stay whole."""
    if not sample:
        return set()
    total = sum(w for *_, w in sample)
    out, want = set(), 1
    for (k, d, _), upto in zip(sample, accumulate(w for *_, w in sample)):
        while want < parts and upto >= want * total / parts:
            out.add((k, d) if k in hot else (k, -(1 << 63)))
            want += 1
    return out


def shard(docs: DataFrame, shards: int = 16, draws: int = 32, rows_per_range: int = 200_000, max_ranges: int = 4096,
          group_share: float = 0.01, small: int = 1000, seed: int = 7) -> DataFrame:
    """Range-partition ``docs`` into ``shards`` shards of near equal bytes; a row for each row.

    Records are ordered by (hash of the text, doc_id), so equal texts are neighbours. Splitters from a size-weighted
    sample (about ``draws`` rows for each of at most ``max_ranges`` ranges: a bounded sample) cut the order into ranges;
    ranges that turn out more than twice as full as meant (and have ``small`` rows) are sampled and cut again. Exact byte and row sums of the
    ranges, and running sums inside each, give every record's place in the whole, and its place its shard. Groups of
    equal texts up to ``group_share`` of a shard stay in one shard; larger ones are cut by doc_id. A null text has size
    1 and crc 0. The result does not depend on the sample, only the work does. ``slot`` counts from 0 within a shard.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keys = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63) + 1)).alias("d"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("key")), "shard-keys")
    n, total = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = min(max_ranges, max(128, n // rows_per_range))
    # at most shards / group_share keys can be this large
    hot = {r.key for r in keys.groupBy("key").agg(F.sum("size").alias("s")).where(F.col("s") > group_share * total / shards).collect()}
    cuts = _quantiles(_sample(keys, draws * ranges / max(total, 1), seed), ranges, hot)
    for again in range(1, 4):
        sums = keys.groupBy(_range_of(sorted(cuts)).alias("r")).agg(F.sum("size").alias("s"), F.count("*").alias("c")).collect()
        over = {r.r: max(r.s * ranges // max(total, 1), r.c * ranges // max(n, 1)) for r in sums}
        over = {r.r: over[r.r] for r in sums if over[r.r] >= 2 and r.c >= small}
        if not over:
            break
        inside, more = keys.withColumn("r", _range_of(sorted(cuts))).where(F.col("r").isin(list(over))), set()
        drawn = inside.where(F.pmod(F.xxhash64("d", "key", F.lit(seed + again)), F.lit(1 << 30)) / float(1 << 30)
                             < draws * ranges * F.greatest(F.col("size") / max(total, 1), F.lit(1 / max(n, 1)))).select("r", "key", "d").collect()
        for r, by in over.items():
            more |= _quantiles(sorted((x.key, x.d, 1.0) for x in drawn if x.r == r), by + 1, hot)
        if more <= cuts:
            break
        cuts |= more
    cuts = sorted(cuts)
    ranged = keys.withColumn("r", _range_of(cuts))
    sums = {r.r: (r.s, r.c) for r in ranged.groupBy("r").agg(F.sum("size").alias("s"), F.count("*").alias("c")).collect()}
    order = range(len(cuts) + 1)
    before = lambda i: [0, *accumulate(sums.get(r, (0, 0))[i] for r in order)][:-1]
    starts = F.broadcast(spark.createDataFrame(list(zip(order, before(0), before(1))), "r int, b0 long, c0 long"))
    w = Window.partitionBy("r").orderBy("key", "d", "size")
    placed = (
        ranged.withColumn("upto", F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("rn", F.row_number().over(w))
        .join(starts, "r")
        .withColumn("place", F.col("b0") + F.col("upto") - F.col("size") / 2))
    group = Window.partitionBy("r", "key")
    middle = F.when(F.col("key").isin(list(hot)) if hot else F.lit(False), F.col("place")).otherwise(
        F.min(F.col("b0") + F.col("upto") - F.col("size")).over(group) + F.sum("size").over(group) / 2)
    placed = placed.withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle * shards / max(total, 1))).cast("int")) \
        .select("doc_id", "size", "text_crc32", "shard", (F.col("c0") + F.col("rn")).alias("row"))
    placed = materialize(placed, "shard-places")
    first = F.broadcast(placed.groupBy("shard").agg(F.min("row").alias("first")))  # a row for each shard
    return placed.join(first, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))

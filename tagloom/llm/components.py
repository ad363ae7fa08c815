"""Connected components by alternating large-star and small-star steps, every step written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import materialize


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``a, b`` (long, undirected, repeats and loops allowed) to ``node, root``: each linked node and the smallest
    node that it can reach. Nodes without a link to another are not in the result."""
    up = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    up = materialize(up, "links")
    state = None
    for _ in range(most_rounds):
        # large star: every neighbour above a node moves to the least of the node's neighbourhood
        both = up.union(up.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
        large = up.join(least, F.col("v") == F.col("x")).select("u", F.col("m").alias("v")) \
            .union(up.join(least, F.col("u") == F.col("x")).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))) \
            .union(least.where("x <> m").select(F.col("x").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        large = materialize(large, "links")
        # small star: the neighbours below a node, and the node, move to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.withColumnRenamed("u", "x"), F.col("u") == F.col("x")).where("v <> m") \
            .select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        up = materialize(small, "links")
        new = up.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            return up.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = new
    raise RuntimeError("components did not settle")

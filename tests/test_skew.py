from pyspark.sql import functions as F

from tagloom.operators.skew import heavy_join


def test_heavy_join_is_the_plain_join(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 100 == 1, F.lit(None))
                                    .otherwise((F.col("id") % 700).cast("string")).alias("k"), "id")
    right = left.where("k is not null and k <> '5'").groupBy("k").agg(F.count("*").alias("n"))
    for how in ("inner", "left"):
        want = sorted(map(str, left.join(right, "k", how).select("k", "id", "n").collect()))
        got = heavy_join(left, right, "k", F.col("n"), how, share=0.01)
        assert got.columns == ["k", "id", "n"]
        assert sorted(map(str, got.collect())) == want


def test_hot_key_stays_spread(spark):
    """A third of the rows on one key, adaptive execution off: no partition gets them."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(30000, numPartitions=8).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
        right = left.groupBy("k").agg(F.count("*").alias("n")).repartition(4)
        sizes = [r.n for r in heavy_join(left, right, "k", F.col("n")).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 30000 and max(sizes) < 3 * sorted(sizes)[len(sizes) // 2]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_empty(spark):
    none = spark.createDataFrame([], "k string, n long")
    assert heavy_join(none.select("k"), none, "k", F.col("n")).count() == 0
    assert heavy_join(spark.createDataFrame([("a",)], "k string"), none, "k", F.col("n"), "left").collect()[0].n is None


def test_many_rows_are_not_sorted(spark):
    """The side with many rows meets the hashed other one as it comes: no sort of it, which would spill."""
    left = spark.range(1000).selectExpr("id % 100 AS k", "id")
    right = spark.range(100).selectExpr("id AS k", "id * 2 AS v", "CAST(10 AS bigint) AS n")
    out = heavy_join(left, right, "k", F.col("n"), share=0.5)
    assert "ShuffledHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, r.v) for r in out.collect()) == [(i, i % 100 * 2) for i in range(1000)]

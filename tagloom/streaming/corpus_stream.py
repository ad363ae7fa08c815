"""Incremental corpus profiling with Structured Streaming.

New document files landing in a folder are turned into posts and tokens with the same column expressions as the
batch path, and the corpus token counts are kept as streaming state (one row per term). Each micro-batch writes
the current counts table to a folder of its own below the shared checkpoint folder, so readers of the one before are not
disturbed and a batch that is run again replaces only itself; the stream's own checkpoint lives there too, so a restarted
job resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.session import scratch_path
from tagloom.sources.tables import post_tokens, posts_from_documents

DOCUMENT_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def document_stream(spark: SparkSession, folder: str, glob: str = "documents*.parquet",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """The documents of all files, and of all folders of part files, in ``folder`` that ``glob`` matches."""
    reader = spark.readStream.schema(DOCUMENT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # a stream takes a path without a pattern for a folder; in braces the name may be a file's too
    return reader.parquet(f"{folder}/{glob}" if any(c in glob for c in "*?[{") else f"{folder}/{{{glob}}}")


def token_count_stream(docs: DataFrame) -> DataFrame:
    """Streaming D1: (term, count) as stateful aggregation over the token stream."""
    toks = post_tokens(posts_from_documents(docs.select("doc_id", "text", "lang")))
    return toks.select(F.explode("tokens").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("count"))


def run_token_counts(spark: SparkSession, folder: str, glob: str = "documents*.parquet",
                     out_path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process every file available now (trigger availableNow), keep the counts of each batch below ``out_path`` and
    return the last ones as a batch DataFrame."""
    out_path = out_path or scratch_path(spark, "stream_token_counts")
    checkpoint = checkpoint or scratch_path(spark, "stream_token_counts_ckpt")

    def write_batch(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/epoch={epoch}")

    q = (token_count_stream(document_stream(spark, folder, glob)).writeStream.outputMode("complete")
         .foreachBatch(write_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    counts = spark.read.parquet(out_path)
    last = counts.agg(F.max("epoch")).first()[0]  # also where a restart found nothing new
    return counts.where(F.col("epoch") == F.lit(last)).drop("epoch")

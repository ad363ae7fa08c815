"""Shared expressions and the Arrow plumbing of the corpus operators."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import ship_package

WORD = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ALNUM_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` (long) and ``text``: whatever other columns the table has cannot clash with derived ones."""
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def lower_az(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does the same, faster, where every character is one byte."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column, pattern: str = WORD) -> Column:
    """All matches of ``pattern``; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def batches(rows, size: int = 4 << 20):
    """Pieces of Arrow batches with at most ``size`` bytes of text (or one row), so that one task's working set
    does not depend on how many rows Spark puts into a batch."""
    for batch in rows:
        start, held = 0, 0
        lengths = pc.fill_null(pc.binary_length(batch.column("text").cast(pa.binary())), 0).to_pylist()
        for i, n in enumerate(lengths):
            if held and held + n > size:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def arrow(schema: str) -> pa.Schema:
    """Arrow schema of the few flat types that the operators' Arrow functions return."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
             "double": pa.float64()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in schema.split(", "))])

"""The corpus pipeline: quality rules, near duplicates, repeated passages, benchmark decontamination, BPE.

Each stage takes the documents that the one before kept, written as Parquet and read again, and calls one operator of
``tagloom.llm``. All but the last return the columns of ``documents``. Rows without ``doc_id`` go through stages 2 to 4
under a number made of their text. Rows with one ``doc_id`` and different texts are different documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import bpe, decontaminate, quality, simhash, substrings
from tagloom.llm.common import table
from tagloom.session import scratch_path

_KEY, _HASH = "__document", "__text_hash"


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a key: ``doc_id``, or for rows without one a number above all usual ids, made of the text."""
    made = F.lit(1 << 62) + F.xxhash64("text").bitwiseAND(F.lit((1 << 61) - 1))
    return docs.withColumn(_KEY, F.coalesce(F.col("doc_id").cast("long"), made))


def _told_apart(docs: DataFrame) -> DataFrame:
    """``_numbered``, but where an id has several texts only one of them (the least by its hash) goes by the id; the others
    go by numbers above those of the rows without one, made of id and text. Copies of a row share their key."""
    named = _numbered(docs).withColumn(_HASH, F.xxhash64("text"))
    several = named.groupBy(_KEY).agg(F.min(_HASH).alias("__least"), F.max(_HASH).alias("__most")).where("__least <> __most") \
        .select(F.col(_KEY).alias("__id"), "__least")
    made = F.lit(3 << 61) + F.xxhash64(_KEY, "text").bitwiseAND(F.lit((1 << 61) - 1))
    return named.join(several, F.col(_KEY) == F.col("__id"), "left") \
        .withColumn(_KEY, F.when(F.col("__least") != F.col(_HASH), made).otherwise(F.col(_KEY))).drop(_HASH, "__id", "__least")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col(_KEY).alias("doc_id"), "text")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or whose host is rejected, go."""
    return quality.keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, once if its row is repeated. A row of
    another group stays for its own, also under the same id."""
    named = _numbered(docs).withColumn(_HASH, F.xxhash64("text"))
    stay = simhash.survivors(_keyed(named)).select(F.col("doc_id").alias(_KEY), F.col("text_hash").alias(_HASH))
    return named.join(stay, [_KEY, _HASH], "left_semi").dropDuplicates([_KEY, _HASH]).drop(_KEY, _HASH)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of all documents but the earliest; documents that consist of them go.
    Rows under made numbers count as later than all others."""
    left = substrings.remove_repeats(_told_apart(docs), key=_KEY).drop(_KEY)
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    named = _told_apart(docs)
    found = decontaminate.decontaminate(_keyed(named), table(spark, sf_dir, "benchmark"))
    gone = found.where("contaminated").select(F.col("doc_id").alias(_KEY)).distinct()
    return named.join(gone, _KEY, "left_anti").drop(_KEY)


def bpe_encode_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian uint32) and the ``text`` decoded from them."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    both = bpe.encode(docs, path, decoded=True)
    return both.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "text")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encode_decode", bpe_encode_decode),
]

#: Fingerprints and min-hashes are no SQL: the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written below spark.checkpoint.dir and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        path = scratch_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs

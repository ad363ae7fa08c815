"""Readers for the input tables and the derived views every operator works on.

The derived views re-express the reference's inputs over the given tables:

* ``posts``        question posts (id, thread, title, content, tags) from ``documents``;
* ``word_vectors`` a trained word space (word, vector, label) from ``embeddings``;
* ``bags``         documents in that word space (id, pos, word), also from ``embeddings``;
* ``lexicons``     stop list, entity, lemma and POS lexicons ranked from corpus token counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.hashing import hash_bucket
from tagloom.functions.text import after_first_line, corpus_tokens, first_line


# text tables and their document key
TEXT_KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread_small_scan(df, TEXT_KEYS[name]) if name in TEXT_KEYS else df


def spread_small_scan(df: DataFrame, key: str) -> DataFrame:
    """A text table whose scan yields fewer splits than the cluster has cores (one file, one row group) would run
    all regex work in a few tasks; hash it by its document key over the default parallelism. Large inputs already
    have many splits and are left alone (no shuffle). Hashing by the key also lets later per-document aggregates
    reuse the partitioning."""
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= par:
        return df
    return df.repartition(par, key)


def posts_from_documents(docs: DataFrame, tag_min_len: int = 5) -> DataFrame:
    """id, thread (= lang), title (first line), content (rest, '' if none), tags (sorted distinct title tokens of
    at least ``tag_min_len`` characters)."""
    title = first_line("text")
    return docs.select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("thread"),
        title.alias("title"),
        after_first_line("text").alias("content"),
        F.array_sort(F.array_distinct(F.filter(corpus_tokens(title), lambda t: F.length(t) >= tag_min_len))).alias(
            "tags"
        ),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts_from_documents(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def post_tokens(posts_df: DataFrame) -> DataFrame:
    """(id, thread, tokens) with corpus tokens of title and content."""
    return posts_df.select("id", "thread", corpus_tokens(F.concat_ws("\n", "title", "content")).alias("tokens"))


def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word = 'w' || vec_id, vector = embedding as array<double>, label."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("word"),
        F.col("embedding").cast("array<double>").alias("vector"),
        F.col("label"),
    )


def bags(spark: SparkSession, sf_dir: str, words_per_doc: int = 5) -> DataFrame:
    """Documents in word space: for each vec_id as id and j in 0..words_per_doc-1,
    word = 'w' || ((vec_id*7 + j*13) % N) where N is the number of vectors. Long form (id, pos, word)."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id")
    n = emb.count()  # one scalar
    return emb.select(
        F.col("vec_id").alias("id"), F.posexplode(F.array_repeat(F.lit(0), words_per_doc)).alias("pos", "_z")
    ).select(
        "id",
        F.col("pos").cast("bigint").alias("pos"),
        F.concat(F.lit("w"), ((F.col("id") * 7 + F.col("pos") * 13) % F.lit(n)).cast("string")).alias("word"),
    )


def bag_tokens(bags_df: DataFrame) -> DataFrame:
    """Long bag rows -> (id, tokens array in position order). Groups are small and bounded (words_per_doc)."""
    return bags_df.groupBy("id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda s: s["word"]).alias("tokens")
    )


def with_split(df: DataFrame, id_col: str = "id", buckets: int = 4, seed=None) -> DataFrame:
    """split = 'test' for hash bucket 0, else 'train' (25 % hold-out, stable across engines and runs)."""
    return df.withColumn(
        "split", F.when(hash_bucket(id_col, buckets, seed) == 0, F.lit("test")).otherwise(F.lit("train"))
    )


# ---------------------------------------------------------------- lexicons (fixture rules)
POS_TAGS = ["NOUN", "VERB", "ADJ", "ADV"]
ENTITY_TYPES = ["ORG", "DATE", "GPE"]  # by rank mod 3


def ranked_terms(counts: DataFrame, top: int) -> DataFrame:
    """(term, count, rank) for the ``top`` most frequent terms, ties broken by term. The order is a distributed
    top-k (TakeOrderedAndProject); the at most ``top`` winners come back as a small local table, so lexicons built
    from them are cheap to size-check and broadcast."""
    rows = counts.orderBy(F.col("count").desc(), F.col("term").asc()).limit(top).collect()  # <= top rows
    data = [(r["term"], int(r["count"]), i + 1) for i, r in enumerate(rows)]
    return counts.sparkSession.createDataFrame(data, "term string, count bigint, rank bigint")


def stop_list(counts: DataFrame, top: int = 20, ranked: DataFrame | None = None) -> DataFrame:
    r = ranked if ranked is not None else ranked_terms(counts, top)
    return r.filter(F.col("rank") <= top).select(F.col("term").alias("word"))


def entity_lexicon(counts: DataFrame, first: int = 21, last: int = 70, ranked: DataFrame | None = None) -> DataFrame:
    r = (ranked if ranked is not None else ranked_terms(counts, last)).filter(
        (F.col("rank") >= first) & (F.col("rank") <= last))
    etype = F.element_at(F.array(*[F.lit(t) for t in ENTITY_TYPES]), (F.col("rank") % 3 + 1).cast("int"))
    return r.select(F.col("term").alias("phrase"), etype.alias("type"))


def lemma_lexicon(counts: DataFrame, first: int = 71, last: int = 270, min_len: int = 5,
                  ranked: DataFrame | None = None) -> DataFrame:
    r = (ranked if ranked is not None else ranked_terms(counts, last)).filter(
        (F.col("rank") >= first) & (F.col("rank") <= last) & (F.length("term") >= min_len))
    return r.select(
        F.col("term").alias("form"),
        F.when(F.col("rank") % 2 == 0, F.lit("noun")).otherwise(F.lit("verb")).alias("pos"),
        F.expr("substring(term, 1, length(term) - 1)").alias("lemma"),
    )


def pos_lexicon(counts: DataFrame, top: int = 500, ranked: DataFrame | None = None) -> DataFrame:
    r = (ranked if ranked is not None else ranked_terms(counts, top)).filter(F.col("rank") <= top)
    tag = F.element_at(F.array(*[F.lit(t) for t in POS_TAGS]), (hash_bucket("term", 4) + 1).cast("int"))
    return r.select(F.col("term").alias("token"), tag.alias("pos"))


def lexicons(counts: DataFrame, top: int = 500) -> dict[str, DataFrame]:
    """All four fixture lexicons from one ranking of the corpus counts (one distributed top-k)."""
    ranked = ranked_terms(counts, top)
    return {
        "stop": stop_list(counts, ranked=ranked),
        "ent": entity_lexicon(counts, ranked=ranked),
        "lem": lemma_lexicon(counts, ranked=ranked),
        "pos": pos_lexicon(counts, ranked=ranked),
    }

"""Corpus profiling — term and tag frequencies, per-document bags, top-k slices, per-thread weights,
part-of-speech frequencies and corpus summary.

Counts are explode + hash aggregate with map-side partial aggregation, so a hot term costs one row per map task
before the shuffle. Every top-k has a total order (count, then term) and is a distributed top-k
(TakeOrderedAndProject / WindowGroupLimit), never a full sort into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.text import run_lengths, whitespace_tokens
from tagloom.session import maybe_broadcast


def term_counts(df: DataFrame, array_col: str) -> DataFrame:
    """Frequency of every element of an array column: (term, count)."""
    return (
        df.select(F.explode(F.col(array_col)).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def token_counts(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """D1."""
    return term_counts(df, tokens_col)


def tag_counts(df: DataFrame, tags_col: str = "tags") -> DataFrame:
    """D2."""
    return term_counts(df, tags_col)


def doc_bag(df: DataFrame, text_col: str, id_col: str = "id", as_map: bool = False) -> DataFrame:
    """D3: per-document term frequencies of a whitespace split (no lower-casing). Long form (id, term, tf);
    ``as_map`` gives (id, bag map<string,bigint>) — one map per document, bounded by the document length. A row is a
    document and is counted by itself."""
    bag = df.select(F.col(id_col).alias("id"), whitespace_tokens(F.col(text_col)).alias("tokens"))
    if as_map:
        return bag.where(F.size("tokens") > 0).select("id", F.map_from_entries(run_lengths("tokens")).alias("bag"))
    return bag.select("id", F.inline(run_lengths("tokens")))


def top_terms(counts: DataFrame, n: int, skip: int = 0, rarest: bool = False) -> DataFrame:
    """The n most (or least) frequent terms after skipping ``skip``; ties by term. Adds rank (1-based,
    counted before the skip)."""
    cnt = F.col("count").asc() if rarest else F.col("count").desc()
    head = counts.orderBy(cnt, F.col("term").asc()).limit(skip + n)
    ranked = head.withColumn("rank", F.row_number().over(Window.orderBy(cnt, F.col("term").asc())).cast("bigint"))
    return ranked.filter(F.col("rank") > skip)


def top_tags(tag_counts_df: DataFrame, n: int, skip: int = 0) -> DataFrame:
    """D4."""
    return top_terms(tag_counts_df, n, skip)


def top_tokens(token_counts_df: DataFrame, n: int, skip: int = 0) -> DataFrame:
    """D5."""
    return top_terms(token_counts_df, n, skip)


def rarest_terms(counts: DataFrame, n: int = 10) -> DataFrame:
    """D6."""
    return top_terms(counts, n, rarest=True)


def thread_tag_weights(df: DataFrame, n: int = 20, tags_col: str = "tags", group_col: str = "thread") -> DataFrame:
    """The n dominant tags per thread; weight = count / count of the thread's top tag (word-cloud data).

    The rank filter is planned as a WindowGroupLimit: each map task keeps at most n rows per thread before the
    shuffle, so a thread holding a third of all posts still sends only n rows per task."""
    counts = (
        df.select(group_col, F.explode(F.col(tags_col)).alias("tag"))
        .groupBy(group_col, "tag")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    w = Window.partitionBy(group_col).orderBy(F.col("count").desc(), F.col("tag").asc())
    top = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    wmax = Window.partitionBy(group_col)  # over at most n rows per thread
    return top.select(
        group_col,
        "tag",
        "count",
        F.round(F.col("count") / F.max("count").over(wmax), 6).alias("weight"),
        F.col("rank").cast("bigint").alias("rank"),
    )


def pos_frequency(tokens_df: DataFrame, lexicon: DataFrame, tokens_col: str = "tokens", group_col: str = "thread",
                  unknown: str = "X", total_label: str = "ALL") -> DataFrame:
    """Part-of-speech counts per thread and for the whole corpus (one grouping-sets aggregate).
    ``lexicon`` is (token, pos); tokens not in it count as ``unknown``."""
    toks = tokens_df.select(group_col, F.explode(F.col(tokens_col)).alias("token"))
    tagged = toks.join(maybe_broadcast(lexicon.select("token", "pos")), "token", "left").select(
        group_col, F.coalesce(F.col("pos"), F.lit(unknown)).alias("pos")
    )
    # count per (group, pos) first, then roll up that small table: the rollup's Expand never sees token rows
    per = tagged.groupBy(group_col, "pos").agg(F.count(F.lit(1)).alias("c"))
    agg = per.rollup("pos", group_col).agg(F.sum("c").cast("bigint").alias("count")).filter(F.col("pos").isNotNull())
    return agg.select(F.coalesce(F.col(group_col), F.lit(total_label)).alias(group_col), "pos", "count")


def verb_noun_ratio(pos_freq: DataFrame, group_col: str = "thread", verb: str = "VERB", noun: str = "NOUN") -> DataFrame:
    """Verbs, nouns and verbs/nouns per thread (and the corpus row)."""
    agg = pos_freq.groupBy(group_col).agg(
        F.sum(F.when(F.col("pos") == verb, F.col("count")).otherwise(0)).cast("bigint").alias("verbs"),
        F.sum(F.when(F.col("pos") == noun, F.col("count")).otherwise(0)).cast("bigint").alias("nouns"),
    )
    return agg.withColumn(
        "verb_noun_ratio", F.when(F.col("nouns") > 0, F.round(F.col("verbs") / F.col("nouns"), 6))
    )


def corpus_summary(df: DataFrame, tokens_col: str = "tokens", tags_col: str = "tags", approx: bool = False) -> DataFrame:
    """Number of documents, unique tags, unique words and total tokens (one row), from one pass: each
    document's distinct words and tags are exploded as (kind, value) rows, its first row carrying the document and
    token counts; grouping by (kind, value) dedupes the vocabulary (partial aggregation absorbs hot terms), and a
    one-row aggregate folds the counts. ``approx`` uses approx_count_distinct and skips the grouping shuffle."""
    empty = F.array().cast("array<string>")

    def kind(col, k):
        return F.transform(F.array_distinct(F.coalesce(F.col(col), empty)),
                           lambda t: F.struct(F.lit(k).alias("k"), t.alias("v")))

    rows = df.select(F.size(tokens_col).alias("n"),
                     F.posexplode_outer(F.concat(kind(tokens_col, "w"), kind(tags_col, "t"))).alias("pos", "it"))
    first = F.col("pos").isNull() | (F.col("pos") == 0)
    rows = rows.select(F.when(first, 1).otherwise(0).alias("d"), F.when(first, F.col("n")).alias("nt"),
                       F.col("it.k").alias("k"), F.col("it.v").alias("v"))
    if approx:
        words = F.approx_count_distinct(F.when(F.col("k") == "w", F.col("v")))
        tags = F.approx_count_distinct(F.when(F.col("k") == "t", F.col("v")))
        out = rows.agg(F.sum("d").alias("n_docs"), F.sum("nt").alias("n_tokens"), words.alias("n_unique_words"),
                       tags.alias("n_unique_tags"))
    else:
        per = rows.groupBy("k", "v").agg(F.sum("d").alias("d"), F.sum("nt").alias("nt"))
        out = per.agg(F.sum("d").alias("n_docs"), F.sum("nt").alias("n_tokens"),
                      F.count(F.when(F.col("k") == "w", F.col("v"))).alias("n_unique_words"),
                      F.count(F.when(F.col("k") == "t", F.col("v"))).alias("n_unique_tags"))
    return out.select(*[F.col(c).cast("bigint").alias(c) for c in ("n_docs", "n_unique_tags", "n_unique_words",
                                                                   "n_tokens")])

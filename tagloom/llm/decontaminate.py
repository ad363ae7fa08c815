"""Benchmark decontamination by a prefix-filtered join, DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import ALNUM, ALNUM_ANY_CASE, LOWER, UPPER, id_text, lower_az, words
from tagloom.session import is_small, materialize

#: Beyond so many windows (each 10 short words and a few numbers: below 500 MB) the windows are not broadcast.
BROADCAST_WINDOWS = 500_000


def item_windows(benchmark: DataFrame, span: int = 10) -> DataFrame:
    """``item_id, win``: every run of ``span`` words of an item; a shorter item is one window, an empty or null one none."""
    items = benchmark.select("item_id", words(lower_az(F.col("text").cast("string")), ALNUM).alias("w"))
    runs = F.when(F.size("w") >= span, F.transform(F.sequence(F.lit(1), F.size("w") - span + 1), lambda i: F.slice("w", i, span))) \
        .when(F.size("w") > 0, F.array("w"))
    return items.select("item_id", F.explode(runs).alias("win")).distinct()


#: Ends every document's words, so that one pass tells their number too. No word has this character.
END = "\x00"


def occurrences(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``doc_id, win, start, span``: where the distinct ``windows`` (one column ``win``) stand in ``docs`` (``doc_id, w``:
    its words as they are written); and a row for each document with a null ``win`` and the number of words as ``start``. ``win`` comes back as text, its words joined by a space.

    Prefix filter: the words of a window are ordered by how often the whole corpus has them. All must occur, so the
    rarest one alone (its first place in the window) is the necessary prefix; only the corpus's occurrences of these
    words become candidates. Candidates are found under ``lower``, which equates no less than A-Z lower-casing does.
    Then the bounds: the window must begin and end inside the text. Last, its words, A-Z lower-cased, are compared one
    by one. Every occurrence is found once."""
    small = is_small(windows, BROADCAST_WINDOWS)
    if not small:  # ids may be null or repeated: what is fetched again goes by a written row number
        docs = materialize(docs.withColumn("row", F.monotonically_increasing_id()), "texts")
    hint = F.broadcast if small else (lambda df: df)
    tokens = F.transform("win", F.lower)
    vocabulary = windows.select(F.explode(tokens).alias("tok")).distinct()
    # the outer form: the plain one would make Spark test the words' number, and so split every text twice
    counts = docs.select(F.explode_outer("w").alias("tok")).select(F.lower("tok").alias("tok")) \
        .join(hint(vocabulary), "tok").groupBy("tok").count()
    rarest = Window.partitionBy("win").orderBy("count", "tok", "off")
    named = windows.select(F.array_join("win", " ").alias("win"), F.size("win").alias("span"), tokens.alias("toks"))  # no word has a space
    prefix = named.select("win", "span", F.posexplode("toks").alias("off", "tok")).join(counts, "tok") \
        .withColumn("rn", F.row_number().over(rarest)).where("rn = 1").select("tok", "off", "win", "span")
    end = docs.sparkSession.range(1).select(F.lit(END).alias("tok"), F.lit(0).alias("off"), F.lit(None).cast("string").alias("win"),
                                            F.lit(0).alias("span"))
    prefix = materialize(prefix.union(end), "rare-words")
    start = F.col("pos") - F.col("off")
    fits = (start >= 0) & (start + F.col("span") <= F.size("w"))
    # compared as text: functions with lambdas would take the join out of compiled code, and then every word of a text
    # would be a row with a copy of all its words
    here = F.translate(F.array_join(F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("span")), " "), UPPER, LOWER)
    same = F.col("win").isNull() | F.coalesce(fits & (here == F.col("win")), F.lit(False))
    kept = ["doc_id", "w"] if small else ["row"]
    ended = docs.select(*kept, F.concat("w", F.array(F.lit(END))).alias("e"))
    cand = ended.select(*kept, F.posexplode_outer("e").alias("pos", "tok")) \
        .withColumn("tok", F.lower("tok")).join(hint(prefix), "tok")
    if not small:  # the texts stay out of the candidate join and meet the candidates by row
        cand = cand.join(docs, "row")
    return cand.where(same).select("doc_id", "win", start.alias("start"), "span")


def decontaminate(docs: DataFrame, benchmark: DataFrame, span: int = 10) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    Null texts have no words; a null ``item_id`` hits but is no item. Documents that share a ``doc_id`` share their
    hits. An empty benchmark leaves every document clean."""
    texts = id_text(docs).select("doc_id", words(F.col("text"), ALNUM_ANY_CASE).alias("w"))
    windows = materialize(item_windows(benchmark, span), "windows")
    rows = materialize(occurrences(texts, windows.select("win").distinct()), "occurrences")
    found = rows.where("win is not null")
    # a word inside several windows is hit once; runs that overlap are cut at the next start
    spans = found.groupBy("doc_id", "start").agg(F.max("span").alias("span"))
    hits = spans.select("doc_id", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("span") - 1)).alias("pos")) \
        .groupBy("doc_id", "pos").agg(F.lit(1).alias("one")).groupBy("doc_id").agg(F.count("*").alias("n_hit"))
    items = found.select("doc_id", "win").distinct().join(windows.withColumn("win", F.array_join("win", " ")), "win").select("doc_id", "item_id").distinct() \
        .groupBy("doc_id").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    hit = hits.join(items.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left") \
        .select(F.col("doc_id").alias("_id"), "n_hit", "items")
    none = F.array().cast("array<string>")
    return rows.where("win is null").select("doc_id", F.col("start").cast("long").alias("n_words")) \
        .join(hit, F.col("doc_id").eqNullSafe(F.col("_id")), "left") \
        .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
                F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
                (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))

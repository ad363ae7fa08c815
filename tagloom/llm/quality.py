"""Host-level quality rules on DataFrame expressions only.

Every text is judged by itself (word count, repeated word windows), failures are added up by host, the hosts' failure
rates are shrunk towards an empirical beta prior, and hosts beyond ``max_host_rate`` take their documents with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import WORD, words
from tagloom.session import materialize

SALTS = 16


def _salts() -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))


def _repeat_words(hashes: Column, span: int) -> Column:
    """Words covered by windows whose hash occurs at least twice. ``hashes``: one per window, in text order.

    Sorting (hash, position) brings equal windows together; the positions that have an equal neighbour, in text
    order, each cover the words up to the next such position, ``span`` at most."""
    at = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(pairs):
        same = F.transform(
            pairs,
            lambda p, j: F.when(
                F.coalesce(F.get(pairs, j - 1)["h"] == p["h"], F.lit(False)) | F.coalesce(F.get(pairs, j + 1)["h"] == p["h"], F.lit(False)),
                p["i"]))
        return F.sort_array(F.filter(same, lambda i: i.isNotNull()))

    def total(starts):
        steps = F.transform(starts, lambda s, j: F.least(F.lit(span), F.coalesce(F.get(starts, j + 1) - s, F.lit(span))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    let = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))  # noqa: E731  evaluates value once
    return let(let(at, covered), total)


def document_rules(docs: DataFrame, min_words: int = 10, max_repeat_pct: int = 20, span: int = 5, extra=()) -> DataFrame:
    """Per row of ``docs``: ``doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``.

    ``host`` is ``source``. A null or empty text has no words and fails; windows of ``span`` words are compared by a
    64-bit hash within one text. Columns beyond ``doc_id, source, text`` are not looked at; ``extra`` are further result
    columns, by name."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("host"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *extra)
    more = base.columns[3:]
    split = base.select("doc_id", "host", *more, "text", words(F.col("text"), WORD).alias("w"))
    w, n = F.col("w"), F.size("w")
    window = F.transform(F.sequence(F.lit(0), n - span), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(span)]))
    lines = F.filter(F.split(F.col("text"), "\n"), lambda x: x.rlike(WORD))
    hashed = split.select(
        "doc_id", "host", *more, n.cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(F.col("text"), F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("lines"), F.when(n >= span, window).otherwise(F.array().cast("array<long>")).alias("h"))
    out = hashed.select(
        "doc_id", "host", *more, "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("h")) < F.size("h"), _repeat_words(F.col("h"), span)).otherwise(F.lit(0))
        .cast("long").alias("n_repeat_words"))
    fails = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    return out.withColumn("base_failed", fails)


def host_verdicts(rules: DataFrame, max_host_rate: float = 0.8) -> DataFrame:
    """Per non-null host: ``host, host_docs, host_fails, host_rate`` (shrunk) and ``host_rejected``.

    The prior Beta(m*s, (1-m)*s) has the pooled rate m; its strength s follows from the variance of the hosts' rates
    beyond the binomial one (method of moments over all hosts). Without such excess the hosts tell nothing apart and
    s is the number of documents. The prior is one row, cross-joined as such."""
    hosts = rules.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_fails"))
    k, n = F.col("host_fails"), F.col("host_docs")
    sums = hosts.agg(F.sum(k).alias("k"), F.sum(n).alias("n"), F.count("*").alias("hosts"), F.sum(k * k / n).alias("kk"))
    rate = F.col("k") / F.col("n")
    spread = F.col("kk") / F.col("n") - rate * rate - rate * (1 - rate) * (F.col("hosts") - 1) / F.col("n")
    strength = F.when(spread > 1e-12, F.greatest(rate * (1 - rate) / spread - 1, F.lit(1.0))).otherwise(F.col("n").cast("double"))
    prior = sums.select(rate.alias("_m"), F.least(strength, F.col("n").cast("double")).alias("_s"))
    shrunk = (k + F.col("_m") * F.col("_s")) / (n + F.col("_s"))
    return hosts.crossJoin(F.broadcast(prior)).select(
        "host", "host_docs", "host_fails", F.round(shrunk, 6).alias("host_rate"),
        (F.round(shrunk, 6) > max_host_rate).alias("host_rejected"))


def quality(docs: DataFrame, min_words: int = 10, max_repeat_pct: int = 20, max_host_rate: float = 0.8) -> DataFrame:
    """Rules and host verdicts of every document, one row per row of ``docs``; ``kept`` is the final verdict.

    A null ``source`` has no host: only the document's own rules decide. Equal rows give equal rows, an empty table an
    empty one. The hosts are joined back under a salt, so a host with a third of the documents is split over tasks."""
    rules = materialize(document_rules(docs, min_words, max_repeat_pct), "quality-rules")
    hosts = host_verdicts(rules, max_host_rate).withColumn("salt", _salts())
    salted = rules.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    return salted.join(hosts, ["host", "salt"], "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce("host_rejected", F.lit(False))).alias("kept"), "host_docs", "host_fails", "host_rate")


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, all columns. The verdict follows from host and text, so rejected
    rows are found again by two hashes of both, whatever the ids are; hosts' groups and copies stay splittable. Other
    columns may have any name but ``__k1`` and ``__k2``. An empty table stays empty; null and empty texts fail and go."""
    ship = docs.select("doc_id", "source", "text")
    key = lambda: (F.xxhash64("source", "text"), F.hash("text", "source", F.length("text")))
    a, b = key()
    rules = materialize(document_rules(ship, **{k: v for k, v in options.items() if k != "max_host_rate"}, extra=[a.alias("__k1"), b.alias("__k2")]), "quality-rules")
    bad = host_verdicts(rules, **{k: v for k, v in options.items() if k == "max_host_rate"}).where("host_rejected").select("host", F.lit(True).alias("out"), _salts().alias("salt"))
    salted = rules.withColumn("salt", F.pmod("__k1", F.lit(SALTS)).cast("int"))
    gone = salted.join(bad, ["host", "salt"], "left").where(F.col("base_failed") | F.col("out")).select("__k1", "__k2").distinct()
    a, b = key()
    return docs.join(gone, (a == F.col("__k1")) & (b == F.col("__k2")), "left_anti")

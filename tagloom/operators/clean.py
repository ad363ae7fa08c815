"""Stop-word removal, entity casing, lemmatising, the configurable cleaning chain, post preparation and
the preprocessing ablation grid.

Character-level steps are column expressions. Token-level lexicon steps (entities, stop words, lemmas) take one of
two plans:

* inline (lexicons of at most ``INLINE_LEXICON_ROWS`` rows, counted by one bounded collect): the lexicon becomes a
  literal set tested inside ``filter`` / ``transform`` over each document's token array (``isin`` is planned as a
  hash-set InSet) — a narrow step, no explode and no shuffle of the corpus tokens;
* long form (larger lexicons): the tokens are written once under a row number, then one posexplode, hash joins
  against the lexicons (broadcast only after a counted size check, otherwise a shuffle join that AQE can split on
  skew), and a single rebuild per row ordered by pos. A document with no surviving token keeps an empty array (null
  markers, not dropped rows).

Both give the same rows, also for repeated ids. A null token array counts as empty. A form with several lemmas of one
part of speech takes the smallest. An entity of several words marks every token of each of its occurrences.
"""

from __future__ import annotations

import zlib

from functools import lru_cache

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import text as T
from tagloom.session import is_small, materialize, maybe_broadcast

# fixed value: the languages shipped with Spark's StopWordsRemover
STOP_LANGUAGES = [
    "danish", "dutch", "english", "finnish", "french", "german", "hungarian",
    "italian", "norwegian", "portuguese", "russian", "spanish", "swedish", "turkish",
]


@lru_cache(maxsize=1)
def default_stop_words() -> tuple[str, ...]:
    """Union of Spark's stop lists of all languages (the reference removes words listed for any language)."""
    from pyspark.ml.feature import StopWordsRemover

    words: set[str] = set()
    for lang in STOP_LANGUAGES:
        words.update(StopWordsRemover.loadDefaultStopWords(lang))
    return tuple(sorted(words))


def _word_list(words) -> list[str]:
    if words is None:
        return list(default_stop_words())
    if isinstance(words, DataFrame):  # the caller has checked its size
        return [r[0] for r in words.select(words.columns[0]).collect() if r[0] is not None]
    return list(words)


def remove_stopwords(df: DataFrame, tokens_col: str = "tokens", stop_words=None, out_col: str | None = None,
                     case_sensitive: bool = True) -> DataFrame:
    """Drop tokens found in the stop list (default: all languages), order kept. Runs as MLlib's
    StopWordsRemover (JVM hash set per task, no shuffle); a list table of more than ``INLINE_LEXICON_ROWS`` rows is
    joined instead."""
    from pyspark.ml.feature import StopWordsRemover

    out = out_col or tokens_col
    tmp = f"__{out}_nostop"
    full = df.withColumn("__tokens", F.coalesce(F.col(tokens_col), F.array().cast("array<string>")))
    if isinstance(stop_words, DataFrame) and not is_small(stop_words, INLINE_LEXICON_ROWS):
        full = keyed(full)
        long_df = apply_stop_words(explode_tokens(full, ROW, "__tokens"), stop_words, case_sensitive)
        res = full.join(rebuild_tokens(long_df, ROW, out=tmp), ROW).drop(ROW)
    else:
        remover = StopWordsRemover(inputCol="__tokens", outputCol=tmp, stopWords=_word_list(stop_words),
                                   caseSensitive=case_sensitive, locale="en_US")
        res = remover.transform(full)
    return res.drop("__tokens", out).withColumnRenamed(tmp, out)


# ------------------------------------------------------------------ inline token steps (small lexicons)
INLINE_LEXICON_ROWS = 20_000  # literal sets travel with the plan to every task: keep them small


def _bounded_rows(df: DataFrame, cols, max_rows: int | None = None):
    """The rows of a lexicon table if it has at most ``max_rows`` (one bounded job), else None."""
    max_rows = INLINE_LEXICON_ROWS if max_rows is None else max_rows
    rows = df.select(*cols).limit(max_rows + 1).collect()
    return None if len(rows) > max_rows else [tuple(r) for r in rows]


def inline_lexicons(entities: DataFrame | None = None, stop_words=None, lemmas: DataFrame | None = None):
    """Literal forms of the lexicons for the inline plan, or None when any of them needs the join plan."""
    out = {"ent": None, "stop": None, "lem": None}
    if entities is not None:
        rows = _bounded_rows(entity_phrases(entities), ["phrase"])
        if rows is None:
            return None
        out["ent"] = sorted({r[0] for r in rows})
    if stop_words is not None:
        if isinstance(stop_words, DataFrame):
            rows = _bounded_rows(stop_words, [stop_words.columns[0]])
            if rows is None:
                return None
            out["stop"] = sorted({r[0] for r in rows if r[0] is not None})
        else:
            out["stop"] = list(stop_words)
    if lemmas is not None:
        rows = _bounded_rows(lemmas, ["form", "pos", "lemma"])
        if rows is None:
            return None
        lem = {"noun": {}, "verb": {}}
        for f, p, l in rows:
            if p in lem and f is not None and l is not None:
                lem[p][f] = min(l, lem[p].get(f, l))
        out["lem"] = lem
    return out


def entity_phrases(entities: DataFrame) -> DataFrame:
    """(phrase, n): lower-case phrases with single blanks and their word counts; dates are no entities here."""
    words = T.whitespace_tokens(F.lower("phrase"))
    return entities.filter(~F.col("type").eqNullSafe("DATE")).select(
        F.array_join(words, " ").alias("phrase"), F.size(words).alias("n")).filter("n > 0").distinct()


def inline_entity_case(arr, ents):
    """C8 on a token array: tokens inside an occurrence of a phrase of ``ents`` (lower case, words separated by one
    blank) upper-cased, all others lower-cased."""
    by_len: dict[int, list[str]] = {}
    for p in ents:
        by_len.setdefault(p.count(" ") + 1, []).append(p)
    if set(by_len) <= {1}:
        return F.transform(arr, lambda t: F.when(F.lower(t).isin(ents), F.upper(t)).otherwise(F.lower(t)))
    lengths = sorted(by_len)

    def starts(low, n):
        return F.transform(low, lambda t, i: F.array_join(F.slice(low, i + 1, F.lit(n)), " ").isin(by_len[n]))

    def inside(hits, i):
        marks = [F.exists(F.slice(hits[j], F.greatest(i - n + 2, F.lit(1)), F.least(i + 1, F.lit(n))), lambda x: x)
                 for j, n in enumerate(lengths)]
        found = marks[0]
        for m in marks[1:]:
            found = found | m
        return found

    def cased(raw):
        low = F.transform(raw, F.lower)
        hits = T.let(low, lambda lw: F.array(*[starts(lw, n) for n in lengths]))
        return T.let(hits, lambda h: F.transform(
            raw, lambda t, i: F.when(inside(h, i), F.upper(t)).otherwise(F.lower(t))))

    return T.let(arr, cased)


def inline_stop_words(arr, words):
    """C7 on a token array (case-sensitive)."""
    return F.filter(arr, lambda t: ~t.isin(words)) if words else arr


LEMMA_MAPS = 64


def inline_lemmas(arr, lem):
    """C9 on a token array: noun lemma, then verb lemma of the result; unknown forms stay. A hash-set test comes first, so
    only lexicon forms are looked up; a literal map is searched from its start, so the forms are dealt to ``LEMMA_MAPS``
    maps by their hash and a look-up goes through one of them."""
    for pos in ("noun", "verb"):
        pairs = lem.get(pos) or {}
        if pairs:
            arr = F.transform(arr, _lemma_step(pairs))
    return arr


def _lemma_step(pairs):
    forms = sorted(pairs)
    maps: list[list] = [[] for _ in range(LEMMA_MAPS if len(forms) > LEMMA_MAPS else 1)]
    for f in forms:
        maps[zlib.crc32(f.encode("utf-8", "surrogatepass")) % len(maps)] += [F.lit(f), F.lit(pairs[f])]
    empty = F.create_map().cast("map<string,string>")
    table = F.array(*[F.create_map(*m) if m else empty for m in maps])
    place = lambda t: (F.crc32(F.encode(t, "UTF-8")) % F.lit(len(maps))).cast("int")
    return lambda t: F.when(t.isin(forms), F.coalesce(F.element_at(F.get(table, place(t)), t), t)).otherwise(t)


def inline_token_steps(arr, lex: dict, ner: bool, rem_stopwords: bool, lemmatize: bool):
    """The token steps of clean_data on an array column, with the literals of ``inline_lexicons`` (entity casing
    lower-cases everything when there is no entity lexicon; no stop list means the default one)."""
    arr = F.coalesce(arr, F.array().cast("array<string>"))  # null text -> empty array, as in the join plan
    if ner:
        arr = inline_entity_case(arr, lex["ent"]) if lex["ent"] is not None else F.transform(arr, F.lower)
    if rem_stopwords:
        arr = inline_stop_words(arr, lex["stop"] if lex["stop"] is not None else list(default_stop_words()))
    if lemmatize:
        arr = inline_lemmas(arr, lex["lem"])
    return arr


# ------------------------------------------------------------------ long-form token steps
ROW = "__row"


def keyed(df: DataFrame) -> DataFrame:
    """``df`` under a row number, written once: ids may repeat, and a number made in a plan would change when a lost
    executor's part is computed again."""
    return materialize(df.withColumn(ROW, F.monotonically_increasing_id()), "token_rows")


def explode_tokens(df: DataFrame, id_col: str, tokens_col: str, keep=()) -> DataFrame:
    """(id, keep..., pos, tok); posexplode_outer keeps one marker row for documents without tokens."""
    return df.select(id_col, *keep, F.posexplode_outer(tokens_col).alias("pos", "tok"))


def rebuild_tokens(long_df: DataFrame, id_col: str, keep=(), out: str = "tokens") -> DataFrame:
    """Long form -> one ordered array per document; null tokens (removed or markers) are dropped."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "tok")))
    return long_df.groupBy(id_col).agg(
        *[F.first(c).alias(c) for c in keep],
        F.transform(F.filter(ordered, lambda s: s["tok"].isNotNull()), lambda s: s["tok"]).alias(out),
    )


def apply_entity_case(long_df: DataFrame, entities: DataFrame | None) -> DataFrame:
    """C8 on the long form: tokens inside an occurrence of an entity (type other than DATE) upper-cased, all others
    lower-cased. ``entities`` is (phrase, type). One join per word count that phrases have."""
    if entities is None:
        return long_df.withColumn("tok", F.lower("tok"))
    phrases = entity_phrases(entities)
    lengths = sorted(r[0] for r in phrases.select("n").distinct().collect())  # word counts, a few values
    w = Window.partitionBy(ROW).orderBy("pos")  # one document's tokens
    out = long_df.withColumn("__in", F.lit(False))
    for n in lengths:
        ents = maybe_broadcast(phrases.filter(F.col("n") == n).select(F.col("phrase").alias("__ent")))
        gram = F.lower("tok")
        if n > 1:
            gram = F.array_join(F.collect_list(gram).over(w.rowsBetween(0, n - 1)), " ")
        out = out.withColumn("__gram", gram).join(ents, F.col("__gram") == F.col("__ent"), "left")
        hit = F.col("__ent").isNotNull()
        if n > 1:
            hit = F.max(hit).over(w.rowsBetween(1 - n, 0))
        out = out.withColumn("__in", F.col("__in") | hit).drop("__gram", "__ent")
    return out.withColumn("tok", F.when(F.col("__in"), F.upper("tok")).otherwise(F.lower("tok"))).drop("__in")


def apply_stop_words(long_df: DataFrame, stop_words, case_sensitive: bool = True) -> DataFrame:
    """C7 on the long form: stop words become null markers."""
    if isinstance(stop_words, DataFrame):
        word, tok = F.col(stop_words.columns[0]), F.col("tok")
        if not case_sensitive:
            word, tok = F.lower(word), F.lower(tok)
        stops = maybe_broadcast(stop_words.select(word.alias("__stop")).distinct())
        j = long_df.join(stops, tok == F.col("__stop"), "left")
        return j.withColumn("tok", F.when(F.col("__stop").isNull(), F.col("tok"))).drop("__stop")
    words = _word_list(stop_words)
    return long_df.withColumn("tok", F.when(~F.col("tok").isin(words), F.col("tok")))  # InSet: hash lookup


def apply_lemmas(long_df: DataFrame, lemmas: DataFrame) -> DataFrame:
    """C9 on the long form: noun lemma of the token, then verb lemma of the result; unknown forms stay.
    ``lemmas`` is (form, pos in {noun, verb}, lemma); the smallest lemma of a form counts."""
    out = long_df
    for pos in ("noun", "verb"):
        lex = maybe_broadcast(
            lemmas.filter(F.col("pos") == pos).groupBy(F.col("form").alias("__form")).agg(F.min("lemma").alias("__lemma"))
        )
        out = (
            out.join(lex, out["tok"] == lex["__form"], "left")
            .withColumn("tok", F.coalesce(F.col("__lemma"), F.col("tok")))
            .drop("__form", "__lemma")
        )
    return out


def entity_uppercase(df: DataFrame, entities: DataFrame, id_col: str = "id", tokens_col: str = "tokens") -> DataFrame:
    """C8 as a standalone operator: (id, tokens) with entity tokens upper-cased and the rest lower-cased."""
    lex = inline_lexicons(entities=entities)
    if lex is not None:
        arr = F.coalesce(F.col(tokens_col), F.array().cast("array<string>"))
        return df.select(id_col, inline_entity_case(arr, lex["ent"]).alias(tokens_col))
    long_df = explode_tokens(keyed(df.select(id_col, tokens_col)), ROW, tokens_col, (id_col,))
    return rebuild_tokens(apply_entity_case(long_df, entities), ROW, (id_col,), tokens_col).drop(ROW)


def lemmatize(df: DataFrame, lemmas: DataFrame, id_col: str = "id", tokens_col: str = "tokens") -> DataFrame:
    """C9 as a standalone operator."""
    lex = inline_lexicons(lemmas=lemmas)
    if lex is not None:
        arr = F.coalesce(F.col(tokens_col), F.array().cast("array<string>"))
        return df.select(id_col, inline_lemmas(arr, lex["lem"]).alias(tokens_col))
    long_df = explode_tokens(keyed(df.select(id_col, tokens_col)), ROW, tokens_col, (id_col,))
    return rebuild_tokens(apply_lemmas(long_df, lemmas), ROW, (id_col,), tokens_col).drop(ROW)


# ------------------------------------------------------------------ the chain
def base_tokens(text, order: str = "default", html: bool = True, rem_punc: bool = True):
    """Character-level part of clean_data: whitespace tokens after HTML stripping, encoding repair and punctuation
    removal (default order), or after encoding repair only (legacy order)."""
    if order == "default":
        if html:
            text = T.without_tags(text)  # tokens do not depend on the white space between them
        return T.let(T.let(text, T.repair_encoding), T.word_tokens if rem_punc else T.whitespace_tokens)
    return T.let(T.repair_encoding(text), T.whitespace_tokens)


def clean_data(df: DataFrame, text_col: str = "ttl_ctxt", id_col: str = "id", keep=(), rem_stopwords: bool = True,
               ner: bool = True, rem_punc: bool = True, lemmatize: bool = True, html: bool = True,
               stop_words=None, entities: DataFrame | None = None, lemmas: DataFrame | None = None,
               order: str = "default", out: str = "tokens") -> DataFrame:
    """Configurable cleaning -> (id, keep..., tokens).

    order='default': strip HTML -> repair encoding -> [punctuation] -> whitespace tokens -> [entity case] ->
    [stop words] -> [lemmas]. order='legacy' keeps the reference sequence: repair -> tokens -> entity case ->
    stop words -> lemmas -> rejoin -> strip HTML -> [punctuation] -> tokens.
    """
    if order not in ("default", "legacy"):
        raise ValueError("order must be 'default' or 'legacy'")
    if lemmatize and lemmas is None:
        raise ValueError("lemmatize=True needs a lemma lexicon (form, pos, lemma)")
    token_steps = ner or rem_stopwords or lemmatize
    base = df.select(id_col, *keep, base_tokens(F.col(text_col), order, html, rem_punc).alias("__toks"))
    lex = inline_lexicons(entities if ner else None, stop_words if rem_stopwords else None,
                          lemmas if lemmatize else None) if token_steps else None
    if token_steps and lex is not None:  # small lexicons: narrow array steps, no shuffle
        base = base.withColumn("__toks", inline_token_steps(F.col("__toks"), lex, ner, rem_stopwords, lemmatize))
    elif token_steps:
        long_df = explode_tokens(keyed(base), ROW, "__toks", (id_col, *keep))
        if ner:
            long_df = apply_entity_case(long_df, entities)
        if rem_stopwords:
            long_df = apply_stop_words(long_df, stop_words)
        if lemmatize:
            long_df = apply_lemmas(long_df, lemmas)
        base = rebuild_tokens(long_df, ROW, (id_col, *keep), out="__toks").drop(ROW)
    if order == "legacy":
        t = F.array_join("__toks", " ")
        if html:
            t = T.strip_html(t)
        if rem_punc:
            t = T.remove_punctuation(t)
        base = base.withColumn("__toks", T.whitespace_tokens(t))
    return base.withColumnRenamed("__toks", out)


def title_content(posts: DataFrame, title_weight: int = 3, sep: str = " ") -> DataFrame:
    """B1 + B2 for prepare_posts: (id, thread, tags, ttl_ctxt), tags cleaned by clean_text."""
    from tagloom.operators.columns import concat_features, title_weighting

    df = posts
    first = "title"
    if title_weight > 1:
        df = title_weighting(df, "title", title_weight, out="triple_title")
        first = "triple_title"
    df = concat_features(df, first, "content", out="ttl_ctxt", sep=sep)
    df = df.withColumn("tags", T.clean_text(T.joined("tags")))
    return df.select("id", "thread", "tags", "ttl_ctxt")


def prepare_posts(posts: DataFrame, title_weight: int = 3, sep: str = " ", **clean_kw) -> DataFrame:
    """C11: title weighting (B1) + concatenation with content (B2) + clean_data (C10) on the result, tags
    cleaned by clean_text (C5). Returns (id, thread, tokens, tags)."""
    return clean_data(title_content(posts, title_weight, sep), "ttl_ctxt", "id", keep=("thread", "tags"),
                      **clean_kw).select("id", "thread", "tokens", "tags")


def variant_name(rem_stopwords: bool, ner: bool, lemmatize: bool) -> str:
    return f"stop{int(rem_stopwords)}_ner{int(ner)}_lemma{int(lemmatize)}"


def prep_variants(posts: DataFrame, stop_words=None, entities=None, lemmas=None, title_weight: int = 3,
                  grid=None) -> DataFrame:
    """Ablation over stop words x entity casing x lemmas (8 configs by default). One row per config:
    (config, rem_stopwords, ner, lemmatize, n_docs, n_tokens, vocab_size).

    With small lexicons the text is cleaned and cased once; the corpus's distinct tokens, raw and cased, with their counts
    then stand for all of it: each yields its form under every config, and two aggregates give all configs' statistics.
    Large lexicons fall back to one prepare_posts per config."""
    grid = grid or [(s, n, l) for s in (True, False) for n in (True, False) for l in (True, False)]
    if lemmas is None and any(l for _, _, l in grid):
        raise ValueError("lemmatize=True needs a lemma lexicon (form, pos, lemma)")
    lex = inline_lexicons(entities, stop_words, lemmas)
    if lex is None:
        return _prep_variants_per_config(posts, stop_words, entities, lemmas, title_weight, grid)
    base = title_content(posts, title_weight).select(F.coalesce(base_tokens(F.col("ttl_ctxt")), F.array().cast("array<string>")).alias("raw"))
    n_docs = posts.count()
    # casing looks at a token's neighbours; all other steps at the token alone: they run on distinct pairs of both forms
    both = T.let(F.col("raw"), lambda b: F.arrays_zip(b.alias("raw"), inline_token_steps(b, lex, True, False, False).alias("cased")))
    pairs = materialize(base.select(F.explode(both).alias("t")).groupBy(F.col("t.raw").alias("raw"), F.col("t.cased").alias("cased")).agg(F.count("*").alias("n")), "token_pairs")
    variants = F.array(*[F.struct(F.lit(variant_name(s, n, l)).alias("config"),
                                  F.get(inline_token_steps(F.array("cased" if n else "raw"), lex, False, s, l), F.lit(0)).alias("t")) for s, n, l in grid])
    per_term = pairs.select("n", F.explode(variants).alias("v")).where("v.t IS NOT NULL").groupBy("v.config", "v.t").agg(F.sum("n").alias("n"))
    stats = per_term.groupBy("config").agg(F.sum("n").cast("bigint").alias("n_tokens"), F.count("*").cast("bigint").alias("vocab_size"))
    flags = base.sparkSession.createDataFrame(
        [(variant_name(s, n, l), s, n, l) for s, n, l in grid],
        "config string, rem_stopwords boolean, ner boolean, lemmatize boolean")
    none = F.lit(0 if n_docs else None).cast("bigint")
    return flags.join(stats, "config", "left").select(  # a config over no documents still gets its row
        "config", "rem_stopwords", "ner", "lemmatize", F.lit(n_docs).cast("bigint").alias("n_docs"),
        F.coalesce("n_tokens", none).alias("n_tokens"), F.coalesce("vocab_size", F.lit(0)).cast("bigint").alias("vocab_size"))


def _prep_variants_per_config(posts, stop_words, entities, lemmas, title_weight, grid) -> DataFrame:
    out = None
    for s, n, l in grid:
        prepared = prepare_posts(posts, title_weight=title_weight, rem_stopwords=s, ner=n, lemmatize=l,
                                 stop_words=stop_words, entities=entities, lemmas=lemmas)
        docs = prepared.agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.size("tokens")).alias("n_tokens"))
        vocab = prepared.select(F.explode("tokens").alias("t")).agg(F.count_distinct("t").alias("vocab_size"))
        row = docs.unionByName(vocab, allowMissingColumns=True).agg(
            F.max("n_docs").cast("bigint").alias("n_docs"),
            F.max("n_tokens").cast("bigint").alias("n_tokens"),
            F.max("vocab_size").cast("bigint").alias("vocab_size"),
        ).select(F.lit(variant_name(s, n, l)).alias("config"), F.lit(s).alias("rem_stopwords"),
                 F.lit(n).alias("ner"), F.lit(l).alias("lemmatize"), "n_docs", "n_tokens", "vocab_size")
        out = row if out is None else out.unionByName(row)
    return out

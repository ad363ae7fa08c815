"""Sparse text features in long form (id, term, value) — only non-zeros exist, nothing is densified —
plus the MLlib vector forms used to train models.

TF-IDF follows the smooth-idf convention tf * (ln((1+n)/(1+df)) + 1) with an L2 norm per document. MLlib's IDF
omits the +1, so the long form is computed with DataFrame aggregates, and the vector form scales MLlib's idf.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.hashing import uniform01
from tagloom.functions.text import corpus_tokens, run_lengths
from tagloom.operators.skew import heavy_join
from tagloom.session import materialize


def bag_of_words(df: DataFrame, id_col: str = "id", tokens_col: str | None = "tokens",
                 text_col: str | None = None) -> DataFrame:
    """(id, term, tf). Tokens are taken from ``tokens_col``, or made from ``text_col`` with the count-vectoriser
    convention (lower-case, word tokens of at least 2 characters).

    A row of ``df`` is a document: its bag is counted inside the row, so no token is shuffled."""
    toks = corpus_tokens(F.col(text_col)) if text_col else F.col(tokens_col)
    return df.select(F.col(id_col).alias("id"), toks.alias("tokens")).select("id", F.inline(run_lengths("tokens")))


def document_frequency(tf_long: DataFrame) -> DataFrame:
    """(term, df): documents containing the term (one row per (id, term) in the long form)."""
    return tf_long.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


#: Tables of terms up to so many bytes go to every task; larger ones are joined by key.
BROADCAST_TERM_BYTES = 32 << 20


def small_terms(table: DataFrame, term_col: str = "term", most_bytes: int = BROADCAST_TERM_BYTES) -> bool:
    """Whether a table of terms and a few numbers is below ``most_bytes``, counted by its terms' own bytes."""
    size = table.agg(F.sum(F.octet_length(F.col(term_col).cast("string")) + F.lit(64))).first()[0] or 0
    return size <= most_bytes


def inverse_document_frequency(dfreq: DataFrame, n_docs: int, smooth: bool = True) -> DataFrame:
    """(term, df, idf) of (term, df)."""
    if smooth:
        idf = F.log((F.lit(1.0) + F.lit(float(n_docs))) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    else:
        idf = F.log(F.lit(float(n_docs)) / F.col("df")) + F.lit(1.0)
    return dfreq.select("term", "df", idf.alias("idf"))


def weighted_terms(tf_long: DataFrame, idf: DataFrame, norm: bool = True) -> DataFrame:
    """(id, term, tf, idf, tfidf) of (id, term, tf) and (term, df, idf); terms without idf are left out.

    A small vocabulary goes to the documents; of a large one the frequent terms do and the rest meets its rows by key, so a
    term that all documents have is never one task's. The norm is a sum over a document's own terms."""
    if small_terms(idf):
        w = tf_long.join(F.broadcast(idf.select("term", "idf")), "term")
    else:
        w = heavy_join(tf_long, idf, "term", F.col("df")).drop("df")
    w = w.withColumn("w", F.col("tf") * F.col("idf"))
    if norm:
        w = w.withColumn("w", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id"))))
    return w.select("id", "term", "tf", "idf", F.col("w").alias("tfidf"))


def tfidf(tf_long: DataFrame, n_docs: int | None = None, smooth: bool = True, norm: bool = True) -> DataFrame:
    """(id, term, tf, idf, tfidf). ``n_docs`` defaults to the number of documents in ``tf_long``. The table is read
    several times: give it written."""
    if n_docs is None:
        n_docs = tf_long.select("id").distinct().count()
    idf = materialize(inverse_document_frequency(document_frequency(tf_long), n_docs, smooth), "idf")
    return weighted_terms(tf_long, idf, norm)


def _tags_of(df: DataFrame, tag_vocab: DataFrame, tokens_col: str, id_col: str, term_col: str) -> DataFrame:
    """(id, tag, tf): the post's own term counts, made inside its row, of the terms that are tags."""
    bag = df.select(F.col(id_col).alias("id"), F.inline(run_lengths(tokens_col))).withColumnRenamed("term", "tag")
    tags = materialize(tag_vocab.select(F.col(term_col).alias("tag")).where("tag IS NOT NULL").distinct(), "tags")
    if small_terms(tags, "tag"):
        return bag.join(F.broadcast(tags), "tag", "left_semi").select("id", "tag", "tf")
    bag = materialize(bag, "tag_bag")
    seen = bag.groupBy("tag").agg(F.count("*").alias("df"))
    return heavy_join(bag, tags.join(seen, "tag"), "tag", F.col("df")).select("id", "tag", "tf")


def tags_in_post(df: DataFrame, tag_vocab: DataFrame, tokens_col: str = "tokens", id_col: str = "id",
                 term_col: str = "term") -> DataFrame:
    """(id, tag) for every known tag that occurs among the post's tokens (binary matrix, non-zeros only). A row is a
    post."""
    return _tags_of(df, tag_vocab, tokens_col, id_col, term_col).select("id", "tag")


def tag_freq_in_post(df: DataFrame, tag_vocab: DataFrame, tokens_col: str = "tokens", id_col: str = "id",
                     term_col: str = "term") -> DataFrame:
    """(id, tag, tf) occurrences of each known tag in the post (count matrix, non-zeros only). A row is a post."""
    return _tags_of(df, tag_vocab, tokens_col, id_col, term_col)


def matrix_shape(long_df: DataFrame, n_rows: int | None = None, n_cols: int | None = None,
                 id_col: str = "id", col_col: str = "term") -> DataFrame:
    """E5: (n_docs, n_terms, nnz, density) of a long-form matrix; explicit shape sizes override the observed."""
    agg = long_df.agg(
        F.count_distinct(id_col).alias("obs_rows"), F.count_distinct(col_col).alias("obs_cols"),
        F.count(F.lit(1)).alias("nnz"),
    )
    rows = F.lit(n_rows) if n_rows is not None else F.col("obs_rows")
    cols = F.lit(n_cols) if n_cols is not None else F.col("obs_cols")
    return agg.select(
        rows.cast("bigint").alias("n_docs"), cols.cast("bigint").alias("n_terms"), F.col("nnz").cast("bigint"),
        F.round(F.col("nnz") / (rows * cols), 6).alias("density"),
    )


def subsample_tokens(df: DataFrame, tokens_col: str = "tokens", id_col: str = "id", sample: float = 1e-3,
                     seed=None) -> DataFrame:
    """Frequent-word subsampling before embedding training. Token at position pos of document id is kept
    when uniform(md5(seed|id:pos)) < min(1, sqrt(s/f) + s/f), f = corpus share of the token.

    Only terms with a share above 2.62 * sample can lose occurrences: at most 0.39 / sample terms, whatever the corpus.
    Their keep probabilities are a literal map, and each row's array is filtered in place. A null array becomes an
    empty one; rows with the same id stay apart."""
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(tokens_col, F.array().cast("array<string>")).alias(tokens_col))
    freq = materialize(docs.select(F.explode(tokens_col).alias("tok")).groupBy("tok").agg(F.count(F.lit(1)).alias("c")), "term_counts")
    total = freq.agg(F.sum("c")).first()[0] or 0
    ratio = F.lit(float(sample)) / (F.col("c") / F.lit(float(max(total, 1))))
    keep_p = F.least(F.lit(1.0), F.sqrt(ratio) + ratio)
    frequent = freq.where(F.col("tok").isNotNull()).select("tok", "c", keep_p.alias("p")).where("p < 1")
    at_risk = {r.tok: r.p for r in sorted(frequent.collect(), key=lambda r: (-r.c, r.tok))}  # lookups meet the hottest first
    if not at_risk:
        return docs
    table = F.create_map(*[F.lit(x) for pair in at_risk.items() for x in pair])

    def kept(tok, pos):
        u = uniform01(F.concat(F.col("id").cast("string"), F.lit(":"), pos.cast("string")), seed)
        return F.when(tok.isin(list(at_risk)), u < F.element_at(table, tok)).otherwise(F.lit(True))

    return docs.withColumn(tokens_col, F.filter(tokens_col, kept))


# ------------------------------------------------------------------ vector forms for pyspark.ml
ALL_TERMS = (1 << 31) - 1  # the largest size CountVectorizer takes: no term is cut


def count_vector_stage(input_col: str = "tokens", output_col: str = "features", vocab_size: int | None = None,
                       min_df: float = 1.0):
    """CountVectorizer over the whole vocabulary, unless the caller gives ``vocab_size`` (then the rarest terms go).
    MLlib keeps the vocabulary on the driver."""
    from pyspark.ml.feature import CountVectorizer

    return CountVectorizer(inputCol=input_col, outputCol=output_col, vocabSize=vocab_size or ALL_TERMS, minDF=min_df)


def tfidf_vectors(df: DataFrame, tokens_col: str = "tokens", output_col: str = "features",
                  vocab_size: int | None = None, min_df: float = 1.0):
    """Sparse TF-IDF vectors with the smooth-idf (+1) convention and L2 norm, as a fitted PipelineModel-like
    triple (count model, scale vector, transform fn). The vocabulary (all terms unless ``vocab_size`` is given) and
    its idf are the only driver-side state."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, ElementwiseProduct, Normalizer
    from pyspark.ml.linalg import Vectors

    cv = count_vector_stage(tokens_col, "__tf", vocab_size, min_df)
    idf = IDF(inputCol="__tf", outputCol="__idf_unused")
    fitted = Pipeline(stages=[cv, idf]).fit(df)
    idf_vec = fitted.stages[1].idf.toArray() + 1.0  # MLlib idf lacks the +1
    scale = ElementwiseProduct(inputCol="__tf", outputCol="__w", scalingVec=Vectors.dense(idf_vec))
    norm = Normalizer(inputCol="__w", outputCol=output_col, p=2.0)

    def transform(d: DataFrame) -> DataFrame:
        return norm.transform(scale.transform(fitted.stages[0].transform(d))).drop("__tf", "__w")

    return fitted.stages[0], transform

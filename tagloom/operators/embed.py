"""Word-embedding training, document mean vectors, nearest words, 2-D projection and scaling."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.features import small_terms
from tagloom.operators.neighbors import nearest
from tagloom.operators.skew import heavy_join
from tagloom.operators.skipgram import WordVectors, skip_gram
from tagloom.session import is_small, materialize, ship_package

#: Word vectors beyond so many bytes are joined by shuffle, not broadcast.
BROADCAST_BYTES = 64 << 20


#: Vocabularies with more values (words x dims) are trained without the driver; MLlib holds several copies there.
DRIVER_VALUES = 4_000_000


def word2vec_train(df: DataFrame, tokens_col: str = "tokens", vector_size: int = 128, window: int = 10,
                   min_count: int = 0, max_iter: int = 1, seed: int = 42, num_partitions: int | None = None,
                   driver_values: int | None = None):
    """Skip-gram word vectors, by one of two trainers, chosen by the counted size of the vocabulary: MLlib's Word2Vec
    (vocabulary x dim on the driver) up to ``driver_values`` values, beyond that blocks with averaged vectors
    (``skipgram``; ``num_partitions`` does not count there). The reference's sub-sampling (sample=1e-3) has no parameter
    here; apply ``features.subsample_tokens`` to the input first."""
    words = df.select(F.explode(tokens_col).alias("word")).where("word IS NOT NULL").groupBy("word").agg(F.count("*").alias("n"))
    words = materialize(words.where(F.col("n") >= min_count), "word2vec_words")
    if words.count() * vector_size > (DRIVER_VALUES if driver_values is None else driver_values):
        known = frequent_tokens(df, words, tokens_col) if min_count > 1 else df
        return skip_gram(known, tokens_col, vector_size, window, max_iter, seed)
    from pyspark.ml.feature import Word2Vec

    num_partitions = num_partitions or df.sparkSession.sparkContext.defaultParallelism
    w2v = Word2Vec(vectorSize=vector_size, windowSize=window, minCount=min_count, maxIter=max_iter, seed=seed,
                   inputCol=tokens_col, outputCol="__w2v", numPartitions=num_partitions)
    return w2v.fit(df)


def frequent_tokens(df: DataFrame, words: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """Token arrays (``tokens_col`` alone) without the tokens that ``words`` (word, n: how often it occurs) lacks."""
    rows = materialize(df.select(F.monotonically_increasing_id().alias("__row"), F.col(tokens_col).alias("__tokens")), "token_rows")
    long = rows.select("__row", F.posexplode("__tokens").alias("pos", "word"))
    kept = heavy_join(long, words, "word", F.col("n"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "word")))  # of one row: its length bounds it
    return kept.groupBy("__row").agg(F.transform(ordered, lambda s: s["word"]).alias(tokens_col)).drop("__row")


def model_vectors(model) -> DataFrame:
    """(word, vector array<double>) of a trained model."""
    if isinstance(model, WordVectors):
        return model.table.select("word", F.col("vector").cast("array<double>").alias("vector"))
    from pyspark.ml.functions import vector_to_array

    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


def interleave_tags(df: DataFrame, tokens_col: str = "tokens", tags_col: str = "tags", every: int = 10) -> DataFrame:
    """Sentences for the tag-aware embedding: after every ``every`` tokens the post's tags are inserted, so tags
    share context windows with the words they label (tokens without a post get no tags)."""
    chunks = F.expr(
        f"transform(sequence(0, greatest(ceil(size({tokens_col}) / {every}) - 1, 0)), "
        f"i -> concat(slice({tokens_col}, i * {every} + 1, {every}), {tags_col}))"
    )
    return df.withColumn(tokens_col, F.flatten(chunks))


def tag_aware_embedding(df: DataFrame, tokens_col: str = "tokens", tags_col: str = "tags", every: int = 10,
                        **w2v_kw):
    """Words and tags trained into one space (Word2Vec over tag-interleaved sentences)."""
    return word2vec_train(interleave_tags(df, tokens_col, tags_col, every), tokens_col, **w2v_kw)


def mean_vectors(tokens_long: DataFrame, vectors: DataFrame, id_col: str = "id", word_col: str = "word") -> DataFrame:
    """(id, vector, n_words) — mean of the in-vocabulary word vectors of each document; repeated words
    count each time. Every id of ``tokens_long`` gets a row: a document without any in-vocabulary word (a null word
    stands for a document without words) has a null vector and 0 words.

    Small vector tables go to the tokens; the mean is MLlib's Summarizer (a partial aggregate holding dim values per
    group), so a long document never materialises its word vectors in one place. Larger ones: ``_means_by_share``."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    vec = vectors.select(F.col("word").alias(word_col), F.col("vector").cast("array<double>").alias("vector"))
    dim = vec.select(F.size("vector")).first()
    most = BROADCAST_BYTES // (8 * max(dim[0], 1) if dim else 8)
    tokens = tokens_long.select(F.col(id_col).alias("id"), word_col)
    if not is_small(vec, most):
        return _means_by_share(tokens.withColumnRenamed(word_col, "word"), vec.withColumnRenamed(word_col, "word"))
    vec = F.broadcast(vec)
    agg = tokens.join(vec, word_col).groupBy("id").agg(
        Summarizer.mean(array_to_vector("vector")).alias("mean"), F.count(F.lit(1)).alias("n_words")
    )
    means = agg.select("id", vector_to_array("mean").alias("vector"), F.col("n_words").cast("bigint"))
    return tokens.select("id").distinct().join(means, "id", "left").select(
        "id", "vector", F.coalesce("n_words", F.lit(0)).cast("bigint").alias("n_words"))


MEAN_ROWS = 1 << 18  # tokens of a share: its distinct words' vectors are what a task holds


def _means_by_share(tokens: DataFrame, vectors: DataFrame, rows: int | None = None) -> DataFrame:
    """``mean_vectors`` of (id, word) and (word, vector) where vectors are many: documents lie in shares by their ids, and a
    share gets each of its words' vectors once, not once for every token."""
    ship_package(tokens.sparkSession)
    tokens = materialize(tokens, "mean_tokens")
    shares = max(1, -(-tokens.count() // (rows or MEAN_ROWS)))
    dealt = tokens.select(F.pmod(F.xxhash64("id"), F.lit(shares)).alias("share"), "id", "word")
    found = dealt.where("word IS NOT NULL").select(F.col("share").alias("of"), "word").distinct().join(vectors.where("vector IS NOT NULL"), "word").select("of", F.col("word").alias("name"), "vector")
    kind = tokens.schema["id"].dataType.simpleString()

    def means(key, left, right):
        ids = left.column("id").combine_chunks()
        ids = (ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids).dictionary_encode()
        doc = pc.fill_null(ids.indices, len(ids.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)  # the null id comes last
        n_docs = len(ids.dictionary)
        names = right.column("name").combine_chunks()
        x = right.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        x = x.reshape(right.num_rows, -1) if right.num_rows else np.zeros((0, 0))
        words = pc.unique(names)
        at = pc.index_in(names, words).to_numpy(zero_copy_only=False)
        order = np.argsort(at, kind="stable")
        ends = np.r_[np.searchsorted(at[order], np.arange(len(words))), len(at)]  # repeated words have several vectors
        each = pc.fill_null(pc.index_in(left.column("word").combine_chunks(), words), -1).to_numpy(zero_copy_only=False) if len(words) else np.full(len(doc), -1)
        keep = np.flatnonzero((each >= 0) & (doc < n_docs))
        keep = keep[np.argsort(doc[keep], kind="stable")]
        many = (ends[each[keep] + 1] - ends[each[keep]]) if len(keep) else np.zeros(0, np.int64)
        owner = np.repeat(doc[keep], many)
        place = order[np.repeat(ends[each[keep]], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)] if len(keep) else np.zeros(0, np.int64)
        sums, counts = np.zeros((n_docs, x.shape[1])), np.bincount(owner, minlength=n_docs)
        for s in range(0, len(owner), 16384):
            o = owner[s:s + 16384]
            first = np.flatnonzero(np.r_[True, o[1:] != o[:-1]])
            sums[o[first]] += np.add.reduceat(x[place[s:s + 16384]], first, axis=0)
        with np.errstate(invalid="ignore"):
            vector = pa.array(list(sums / counts[:, None]), pa.list_(pa.float64()), mask=counts == 0) if n_docs else pa.array([], pa.list_(pa.float64()))
        out = pa.table([ids.dictionary, vector, pa.array(counts.astype(np.int64))], names=["id", "vector", "n_words"])
        if (doc == n_docs).any():
            none = pa.table([pa.array([None], ids.dictionary.type), pa.array([None], pa.list_(pa.float64())), pa.array([0], pa.int64())], names=["id", "vector", "n_words"])
            out = pa.concat_tables([out, none])
        return out

    return dealt.groupBy("share").cogroup(found.groupBy("of")).applyInArrow(means, f"id {kind}, vector array<double>, n_words long")


def doc_embedding_matrix(df: DataFrame, vectors: DataFrame, tokens_col: str = "tokens", id_col: str = "id") -> DataFrame:
    """Mean vectors for every document from any token-array column (post text or tag text)."""
    long_df = df.select(F.col(id_col).alias("id"), F.explode_outer(tokens_col).alias("word"))
    return mean_vectors(long_df, vectors)


def similar_by_word(vectors: DataFrame, n: int = 10, words: DataFrame | None = None) -> DataFrame:
    """The n nearest words of each word (or of ``words``), the word itself excluded: (word, neighbor,
    cosine, rank)."""
    q = (words if words is not None else vectors).select(F.col("word").alias("qid"), "vector")
    res = nearest(q, vectors, n, "cosine", item_key="word", exclude_self=True)
    return res.select(F.col("qid").alias("word"), F.col("item").alias("neighbor"), F.col("score").alias("cosine"),
                      "rank")


def similar_by_vector(query_vectors: DataFrame, vectors: DataFrame, n: int = 10, id_col: str = "id") -> DataFrame:
    """The n words nearest to each query vector: (id, word, cosine, rank)."""
    q = query_vectors.select(F.col(id_col).alias("qid"), "vector")
    res = nearest(q, vectors, n, "cosine", item_key="word")
    return res.select(F.col("qid").alias(id_col), F.col("item").alias("word"), F.col("score").alias("cosine"), "rank")


def principal_axes(df: DataFrame, vector_col: str = "vector", k: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(mean, axes in columns, variance along each, variance in all) of the vectors: one pass of partial counts, means and
    centred products, merged pairwise; the driver factors the dim x dim covariance. Of each axis the largest entry (the first of
    equal ones) is positive. Rows without a vector do not count."""
    ship_package(df.sparkSession)
    vectors = df.where(F.col(vector_col).isNotNull()).select(F.col(vector_col).cast("array<double>").alias("v"))

    def add(a, b):
        if not a[0] or not b[0]:
            return b if not a[0] else a
        step, n = b[1] - a[1], a[0] + b[0]
        return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n)

    def part(batches):
        held = 0, None, None
        for batch in batches:
            if batch.num_rows:
                x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                mean = x.mean(axis=0)
                held = add(held, (len(x), mean, (x - mean).T @ (x - mean)))
        if held[0]:
            yield _state(held)

    def _state(held):
        return pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int64()), pa.array([held[1].tobytes()], pa.binary()), pa.array([held[2].tobytes()], pa.binary())],
                                          names=["n", "mean", "products"])

    def merge(rows):
        held = 0, None, None
        for r in rows:
            mean = np.frombuffer(r["mean"])
            held = add(held, (r["n"], mean, np.frombuffer(r["products"]).reshape(len(mean), -1)))
        return held

    def some(key, t):
        return pa.Table.from_batches([_state(merge(t.to_pylist()))])

    schema = "n long, mean binary, products binary"
    parts = vectors.mapInArrow(part, schema).withColumn("slot", F.spark_partition_id() % 32)
    n, mean, products = merge([r.asDict() for r in parts.groupBy("slot").applyInArrow(some, schema).collect()])  # 32 rows at most
    if not n:
        return np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0.0
    value, axis = np.linalg.eigh(products / n)
    order = np.argsort(-value, kind="stable")[:k]
    axis = axis[:, order]
    axis = axis * np.sign(axis[np.argmax(np.abs(axis), axis=0), np.arange(axis.shape[1])])
    return mean, axis, np.maximum(value[order], 0), float(np.trace(products) / n)


def project_2d(df: DataFrame, vector_col: str = "vector", k: int = 2) -> DataFrame:
    """PCA to k dimensions (re-aimed from t-SNE: distributed and deterministic). Adds x, y, ``residual`` (how far the
    vector is from the plane) and ``explained`` (share of the variance that the plane has); null for rows without vector."""
    mean, axes, variance, total = principal_axes(df, vector_col, k)
    explained = float(variance.sum() / total) if total else None
    cols = ("x", "y", *(f"x{i}" for i in range(3, k + 1)))[:k]
    kinds = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [f"{c} double" for c in (*cols, "residual", "explained")])

    def run(batches):
        for batch in batches:
            v = batch.column(batch.schema.get_field_index(vector_col))
            there = v.is_valid().to_numpy(zero_copy_only=False)
            out = np.full((batch.num_rows, len(cols) + 1), np.nan)
            if there.any():
                x = v.filter(pa.array(there)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(int(there.sum()), -1) - mean
                at = x @ axes
                out[there] = np.column_stack([at, np.linalg.norm(x - at @ axes.T, axis=1)])
            new = [pa.array(c, pa.float64(), mask=~there) for c in out.T] + [pa.array([explained] * batch.num_rows, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *cols, "residual", "explained"])

    return df.mapInArrow(run, kinds)


# ------------------------------------------------------------------ E6/E7 from counts
def cooccurrence(df: DataFrame, window: int = 5, tokens_col: str = "tokens") -> DataFrame:
    """(word, context, n): how often the two words stand at most ``window`` tokens apart, counted from both sides."""
    size = F.size(tokens_col)
    pairs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(window)), lambda o: F.when(size > o, F.transform(
        F.sequence(F.lit(0), size - o - 1), lambda i: F.struct(F.get(F.col(tokens_col), i).alias("word"), F.get(F.col(tokens_col), i + o).alias("context"))))
        .otherwise(F.array().cast("array<struct<word:string,context:string>>"))))
    once = df.where(size > 1).select(F.explode(pairs).alias("p")).select("p.word", "p.context").where("word IS NOT NULL AND context IS NOT NULL") \
        .groupBy("word", "context").agg(F.count("*").alias("n"))
    return once.union(once.select("context", "word", "n")).groupBy("word", "context").agg(F.sum("n").alias("n"))


def ppmi(counts: DataFrame) -> DataFrame:
    """(word, context, n, ppmi): positive pointwise mutual information, max(0, ln(n N / (n_word n_context))). The words' sums
    go to the pairs if they are small, else the frequent words' do and the others meet their pairs by key."""
    sums = materialize(counts.groupBy("word").agg(F.sum("n").alias("n_word"), F.count("*").alias("weight")), "word_sums")
    total = float(sums.agg(F.sum("n_word")).first()[0] or 0)
    small = small_terms(sums, "word")

    def meet(left, on):
        right = sums.select(F.col("word").alias(on), F.col("n_word").alias(f"n_{on}"), "weight")
        return left.join(F.broadcast(right.drop("weight")), on) if small else heavy_join(left, right, on, F.col("weight")).drop("weight")

    both = meet(meet(counts.select("word", "context", "n"), "word"), "context")
    value = F.log(F.col("n") * F.lit(total) / (F.col("n_word") * F.col("n_context")))
    return both.select("word", "context", "n", F.greatest(value, F.lit(0.0)).alias("ppmi"))


def _drawn(words: DataFrame, r: int, seed: int) -> DataFrame:
    """(word, v): r normal numbers for each word, by its hash."""
    def run(batches):
        for batch in batches:
            rows = [np.random.default_rng(h & ((1 << 64) - 1)).normal(size=r) for h in batch.column("h").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(rows, pa.list_(pa.float64()))], names=["word", "v"])

    return words.select("word", F.xxhash64(F.lit(seed), "word").alias("h")).mapInArrow(run, "word string, v array<double>")


def _times(matrix: DataFrame, x: DataFrame, r: int) -> DataFrame:
    """(word, v): the sparse (word, context, m) times the table x of r numbers for each context. Products are added up in
    each task before they are shuffled."""
    weights = matrix.groupBy("context").agg(F.count("*").alias("weight"))
    right = materialize(weights.join(x.withColumnRenamed("word", "context"), "context"), "factor")
    joined = matrix.join(F.broadcast(right.drop("weight")), "context") if right.count() * (8 * r + 64) < BROADCAST_BYTES \
        else heavy_join(matrix, right, "context", F.col("weight"))
    out = joined.groupBy("word").agg(*[F.sum(F.col("m") * F.col("v")[i]).alias(f"v{i}") for i in range(r)])
    return materialize(out.select("word", F.array(*[f"v{i}" for i in range(r)]).alias("v")), "factor")


def _gram(x: DataFrame, y: DataFrame | None, r: int) -> np.ndarray:
    """x' y (x' x without y): r x r sums."""
    both = x.select("word", "v", F.col("v").alias("w")) if y is None else x.join(y.withColumnRenamed("v", "w"), "word")

    def run(batches):
        total = np.zeros((r, r))
        for batch in batches:
            a, b = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, r) for c in ("v", "w"))
            total += a.T @ b
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(r * r)), pa.array(total.reshape(-1))], names=["i", "s"])

    out = np.zeros(r * r)
    for row in both.mapInArrow(run, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).collect():  # r x r rows
        out[row.i] = row.s
    return out.reshape(r, r)


def _turned(x: DataFrame, by: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            a = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, by.shape[0]) @ by
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(list(a), pa.list_(pa.float64()))], names=["word", "v"])

    return materialize(x.mapInArrow(run, "word string, v array<double>"), "factor")


def _orthonormal(x: DataFrame, r: int) -> DataFrame:
    """Columns with the same span at right angles: twice, since one pass leaves what rounding took."""
    for _ in range(2):
        value, axis = np.linalg.eigh(_gram(x, None, r))
        x = _turned(x, axis / np.sqrt(np.maximum(value, value.max() * 1e-14)))
    return x


def ppmi_vectors(weights: DataFrame, dim: int = 64, extra: int = 8, powers: int = 2, seed: int = 42) -> DataFrame:
    """E6, E7 without a vocabulary on the driver: (word, vector), word vectors by a randomised factorisation of the symmetric
    matrix (word, context, ppmi): its range is found by multiplying drawn vectors, which are kept at right angles, and the
    small matrix in that range is factored. A vector is the word's row of the ``dim`` leading axes times the roots of their
    values, largest first. Draws go by the words' hashes, so vectors can be made again; they are a written table, and the
    driver holds (dim + extra)^2 numbers."""
    ship_package(weights.sparkSession)
    r = dim + extra
    matrix = materialize(weights.where("ppmi > 0").select("word", "context", F.col("ppmi").alias("m")), "ppmi")
    words = matrix.select("word").distinct()
    q = _orthonormal(_times(matrix, _drawn(words, r, seed), r), r) if matrix.limit(1).count() else None
    if q is None:
        return weights.sparkSession.createDataFrame([], "word string, vector array<double>")
    for _ in range(powers):
        q = _orthonormal(_times(matrix, q, r), r)
    z = _times(matrix, q, r)
    small = _gram(q, z, r)
    value, axis = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-np.abs(value), kind="stable")[:dim]
    out = _turned(q, axis[:, order] * np.sqrt(np.abs(value[order])))
    return out.select("word", F.col("v").alias("vector"))


def context_vectors(df: DataFrame, dim: int = 64, window: int = 5, tokens_col: str = "tokens", tags_col: str | None = None, every: int = 10, **how) -> DataFrame:
    """E6 (E7 with ``tags_col``: tags are set between the words): ``ppmi_vectors`` of the corpus's co-occurrences."""
    sentences = interleave_tags(df, tokens_col, tags_col, every) if tags_col else df
    return ppmi_vectors(ppmi(materialize(cooccurrence(sentences, window, tokens_col), "cooccurrence")), dim, **how)


def minmax_scale(df: DataFrame, cols=("x", "y")) -> DataFrame:
    """Scale each column to [0, 1] with its global min and max (a constant column maps to 0). The min/max
    row is one small aggregate read back as literals."""
    stats = df.agg(*[F.min(c).alias(f"mn_{c}") for c in cols], *[F.max(c).alias(f"mx_{c}") for c in cols]).first()
    out = df
    for c in cols:
        mn, mx = stats[f"mn_{c}"], stats[f"mx_{c}"]
        if mn is None or mx is None or mx == mn:
            out = out.withColumn(c, F.when(F.col(c).isNotNull(), F.lit(0.0)))
        else:
            out = out.withColumn(c, (F.col(c) - F.lit(mn)) / F.lit(mx - mn))
    return out

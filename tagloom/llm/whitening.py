"""Embedding whitening: exact sums, centred scatter, pivoted Cholesky, one-sided Jacobi on the triangular factor."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import arrow
from tagloom.session import ship_package

SCALE, SHIFT = 64, 1_000_000   # entry c becomes floor(64 c) + 1000000
MOST = 32                      # components in the output
FAN_IN = 256                   # partial matrices that one task merges
BATCH = 1 << 14                # rows that are projected at a time


def fixed_point(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, x``: entries as longs. Rows whose vector is null, or holds a null, NaN or infinite entry, go."""
    ship_package(vectors.sparkSession)
    entries = F.col("x")
    sound = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("x")) \
        .where(entries.isNotNull() & sound) \
        .select("vec_id", F.transform("x", lambda c: F.floor(c * SCALE).cast("long") + F.lit(SHIFT)).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of one Arrow list column, all of one length, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    """(n, exact sum of each dimension) of the vectors with the most frequent length (the longer of equally frequent)."""
    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            x = batch.column("x")
            lens = np.diff(x.offsets.to_numpy())
            for d in np.unique(lens).tolist():
                here = x.filter(pa.array(lens == d))
                n, total = held.get(d, (0, np.zeros(d, np.int64)))
                held[d] = [n + len(here), total + _matrix(here).sum(axis=0) if d else total]
        for d, (n, total) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                                              pa.array(total, pa.int64())], names=["d", "i", "n", "total"])

    by_length = rows.mapInArrow(run, "d int, i int, n long, total long").groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    best = by_length.where("i = 0").orderBy(F.desc("n"), F.desc("d")).limit(1)
    got = sorted((r.i, r.n, r.total) for r in by_length.join(F.broadcast(best.select(F.col("d").alias("of"))), F.col("d") == F.col("of")).collect())
    return (got[0][1] if got else 0), np.array([t for *_, t in got], np.int64)


def _merge(parts: DataFrame, combine, schema: str) -> DataFrame:
    """Partial results ``slot, task, ...`` of many tasks to one row for each slot, at most ``FAN_IN`` at a time: first those
    of neighbouring tasks, then the rest. ``combine`` takes and gives lists of rows as tuples without slot and task."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(key, t):
        rest = combine([tuple(r[c] for c in names[2:]) for r in t.to_pylist()])
        cols = [[key[0].as_py()], [key[1].as_py()], *([x] for x in rest)]
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, t.schema)], schema=t.schema)

    near = parts.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int")).groupBy("slot", "task").applyInArrow(run, schema)
    return near.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int")).groupBy("slot", "task").applyInArrow(run, schema)


def centred_scatter(rows: DataFrame, n: int, total: np.ndarray) -> np.ndarray:
    """Sum of (x - S/n)(x - S/n)' over all vectors.

    Each x is centred before it is multiplied, at the integer m next to S/n: such products are small integers, exact in
    doubles up to 2^53 in whatever order they are added. What S/n is off m, half a step at most, is one outer product,
    taken off at the end: sum (x - m)(x - m)' - s s' / n with s = S - n m, an integer too."""
    d, middle = len(total), np.array([(2 * int(t) + n) // (2 * n) for t in total], np.int64)

    def run(batches):
        out = np.zeros((d, d))
        for batch in batches:
            x = _of_length(batch.column("x"), d)
            for i in range(0, len(x), BATCH):
                c = (x[i:i + BATCH] - middle).astype(np.float64)
                out += c.T @ c
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([task] * d, pa.int32()), pa.array([r.tobytes() for r in out], pa.binary())],
                                         names=["slot", "task", "line"])

    def add(lines):
        return (sum(np.frombuffer(x) for x, in lines).tobytes(),)

    schema = "slot int, task int, line binary"
    merged = _merge(rows.mapInArrow(run, schema), add, schema)
    out = np.zeros((d, d))
    for r in merged.collect():
        out[r.slot] += np.frombuffer(r.line)
    s = np.array([int(t) - n * int(m) for t, m in zip(total, middle)], np.float64)
    return out - np.outer(s, s) / n


def _of_length(x: pa.Array, d: int) -> np.ndarray:
    return _matrix(x.filter(pa.array(np.diff(x.offsets.to_numpy()) == d))) if len(x) else np.zeros((0, d), np.int64)


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L (rows in the order of v, one column for each rank) with L L' = v. At each step the largest diagonal entry that is
    left becomes the pivot; it stops where none rises above rounding, so the number of columns is the numerical rank.
    With its rows in pivot order L is lower triangular."""
    a, d = v.astype(np.float64).copy(), len(v)
    out, left = np.zeros((d, d)), np.diag(a).copy()
    least = d * np.finfo(np.float64).eps * max(float(left.max(initial=0.0)), 0.0)
    open_ = np.ones(d, bool)
    for k in range(d):
        p = int(np.argmax(np.where(open_, left, -np.inf)))
        if left[p] <= least:
            return out[:, :k]
        out[p, k] = np.sqrt(left[p])
        open_[p] = False
        out[open_, k] = (a[open_, p] - out[open_, :k] @ out[p, :k]) / out[p, k]
        left[open_] -= out[open_, k] ** 2
    return out


def one_sided_jacobi(factor: np.ndarray, most_sweeps: int = 60) -> np.ndarray:
    """``factor`` with its columns rotated against each other until all are orthogonal. Half of the pairs of a round are
    disjoint and turn at once; the rounds of a sweep pair every two columns once (round robin)."""
    g = factor.copy()
    r = g.shape[1]
    if r < 2:
        return g
    ring, eps = np.arange(r + r % 2), np.finfo(np.float64).eps
    for _ in range(most_sweeps):
        turned = False
        for _ in range(len(ring) - 1):
            p, q = ring[:len(ring) // 2], ring[len(ring) // 2:][::-1]
            ring = np.r_[ring[0], ring[-1], ring[1:-1]]
            use = (p < r) & (q < r)
            p, q = p[use], q[use]
            x, y = g[:, p], g[:, q]
            alpha, beta, gamma = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            far = np.abs(gamma) > eps * np.sqrt(alpha) * np.sqrt(beta)
            if not far.any():
                continue
            turned = True
            p, q, x, y, alpha, beta, gamma = p[far], q[far], x[:, far], y[:, far], alpha[far], beta[far], gamma[far]
            zeta = (beta - alpha) / (2 * gamma)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            g[:, p], g[:, q] = c * x - c * t * y, c * t * x + c * y
        if not turned:
            break
    return g


@dataclass
class Whitening:
    """What was fitted: ``n`` vectors with sums ``total``; ``components`` in columns, by falling ``eigenvalues`` of the
    covariance, whose trace is ``trace``. Its size is that of dim x dim numbers, whatever the number of vectors."""

    n: int
    total: np.ndarray
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float

    def first(self, most: int) -> "Whitening":
        return Whitening(self.n, self.total, self.eigenvalues[:most], self.components[:, :most], self.trace)

    def project(self, x: np.ndarray) -> np.ndarray:
        """x - S/n on the components over the roots of the eigenvalues; x are fixed-point longs. Dimensions are added one after
        the other, so that a vector gets the same numbers in every batch."""
        middle = np.array([(2 * int(t) + self.n) // (2 * self.n) for t in self.total], np.int64)
        rest = np.array([int(t) - self.n * int(m) for t, m in zip(self.total, middle)], np.float64) / self.n
        centred, by = (x - middle) - rest, self.components / np.sqrt(self.eigenvalues)
        out = np.zeros((len(x), by.shape[1]))
        for column, weights in zip(np.ascontiguousarray(centred.T), by):
            out += column[:, None] * weights
        return out

    def deviation(self, x: np.ndarray) -> list:
        """Sum over dimensions of (n x - S)^2, exact; None where it is beyond a long."""
        big = max((abs(int(t)) for t in self.total), default=0) + self.n * int(np.abs(x).max(initial=0))
        if big < 1 << 62:
            c = x * self.n - self.total
            if int(np.abs(c).max(initial=0)) ** 2 * max(len(self.total), 1) < 1 << 63:
                return (c * c).sum(axis=1).tolist()
        total = [int(t) for t in self.total]
        exact = [sum((self.n * a - t) ** 2 for a, t in zip(row, total)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def fit(rows: DataFrame) -> Whitening | None:
    """The whitening of all ``rows`` (``vec_id, x``); None without a vector or a dimension."""
    n, total = sums(rows)
    if not n:
        return None
    v = centred_scatter(rows, n, total) / n
    g = one_sided_jacobi(pivoted_cholesky(v))
    e = (g * g).sum(axis=0)
    order = np.argsort(-e, kind="stable")
    u = g[:, order] / np.sqrt(e[order])
    # either sign would do: the largest entry of each component (the first of equal ones) is positive
    u = u * np.sign(u[np.argmax(np.abs(u), axis=0), np.arange(u.shape[1])])
    return Whitening(n, total, e[order], u, float(np.trace(v)))


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of (covariance of the whitened rows - identity), from the rows as they come out. Every part
    is centred at its own mean before multiplying; parts are merged by their counts, means and centred products."""
    d, k = len(model.total), len(model.eigenvalues)
    if not k:
        return 0.0

    def add(a, b):
        (n, mean, m), (n2, mean2, m2) = a, b
        if not n or not n2:
            return b if not n else a
        step = mean2 - mean
        return n + n2, mean + step * (n2 / (n + n2)), m + m2 + np.outer(step, step) * (n * n2 / (n + n2))

    def run(batches):
        held = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            x = _of_length(batch.column("x"), d)
            for i in range(0, len(x), BATCH):
                w = model.project(x[i:i + BATCH])
                mean = w.mean(axis=0)
                held = add(held, (len(w), mean, (w - mean).T @ (w - mean)))
        if held[0]:
            row = [0], [TaskContext.get().partitionId()], [held[0]], [held[1].tobytes()], [held[2].tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, arrow(schema))], schema=arrow(schema))

    def combine(parts):
        held = 0, np.zeros(k), np.zeros((k, k))
        for n, mean, m in parts:
            held = add(held, (n, np.frombuffer(mean), np.frombuffer(m).reshape(k, k)))
        return held[0], held[1].tobytes(), held[2].tobytes()

    schema = "slot int, task int, n long, mean binary, products binary"
    got = combine([(r.n, r.mean, r.products) for r in _merge(rows.mapInArrow(run, schema), combine, schema).collect()])
    return float(np.abs(np.frombuffer(got[2]).reshape(k, k) / got[0] - np.eye(k)).max())


OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def transform(rows: DataFrame, model: Whitening, most: int = MOST) -> DataFrame:
    """One row for each vector and component (``OUTPUT``): whitened value, share of the trace, distance to the mean."""
    model = model.first(most)
    error = identity_error(rows, model)
    d, k = len(model.total), len(model.eigenvalues)
    share = model.eigenvalues / model.trace if k else model.eigenvalues
    shape = arrow(OUTPUT)

    def run(batches):
        for batch in batches:
            x = batch.column("x")
            mine = pa.array(np.diff(x.offsets.to_numpy()) == d)
            ids, x = batch.column("vec_id").filter(mine), _of_length(x, d)
            for i in range(0, len(x) if k else 0, BATCH):
                w = model.project(x[i:i + BATCH])
                m = len(w)
                row = np.repeat(np.arange(m), k)
                cols = [ids.slice(i, m).take(pa.array(row)), np.tile(np.arange(1, k + 1, dtype=np.int32), m), np.full(m * k, model.n),
                        pa.array(model.deviation(x[i:i + BATCH]), pa.int64()).take(pa.array(row)), w.reshape(-1), np.tile(share, m), np.full(m * k, error)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, shape)], schema=shape)

    return rows.mapInArrow(run, OUTPUT)


def whiten(vectors: DataFrame, column: str = "embedding", most: int = MOST) -> DataFrame:
    """``OUTPUT`` for every sound row of ``vectors`` and up to ``most`` components, fitted on all of them.

    One pass adds the dimensions up exactly, one the centred scatter; the driver factors that dim x dim matrix (pivoted
    Cholesky, then one-sided Jacobi on the factor: squared norms of the rotated columns are the eigenvalues, the normalised
    columns the components); one pass measures the whitened covariance and one writes the rows. Partial matrices are merged
    on Spark, ``FAN_IN`` at a time, and no vector reaches the driver.

    Rows with a null vector, or a null, NaN or infinite entry in it, are left out, and so are vectors whose length is not the
    most frequent one (the longer of two). An empty table gives no rows, and neither do vectors without entries or variance:
    components whose eigenvalue is zero up to rounding have no whitened values. Rows that repeat count and come out each for
    itself, null ids stay null. Entries beyond a long's range count as its ends. ``deviation`` is null beyond a long.
    Of ``vectors`` only ``vec_id`` and ``column`` are read."""
    rows = fixed_point(vectors, column)
    model = fit(rows)
    if model is None or not len(model.eigenvalues):
        return vectors.sparkSession.createDataFrame([], OUTPUT)
    return transform(rows, model, most)

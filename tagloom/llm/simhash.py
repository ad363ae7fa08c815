"""SimHash near-duplicates: fingerprints, generalised pigeonhole search, connected components."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import batches, id_text
from tagloom.llm.components import components
from tagloom.session import materialize

BITS = 64
#: What one row that is shuffled and one candidate pair cost, in microseconds; only the choice of the plan depends on it.
ROW_COST, PAIR_COST = 4.0, 0.05
#: Members of a bucket that are compared pair by pair; larger buckets meet at shared edges of the hypercube.
LARGE = 4096


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """A bit is 1 if more than half of the shingles' hashes have it; no words: 0."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    runs = zip(*(w[i:] for i in range(shingle))) if len(w) >= shingle else [w]
    hashes = np.array([xxhash.xxh64_intdigest(b" ".join(x), seed) for x in runs], "<u8")
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, fp, text_hash``: the 64 bits as a signed long, one row per row of ``docs``; a null text has no words."""
    def run(rows):
        for batch in batches(rows):
            fps = np.array([fingerprint(x, shingle) for x in batch.column("text").to_pylist()], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps), batch.column("text_hash")], names=["doc_id", "fp", "text_hash"])

    return id_text(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, "doc_id long, fp long, text_hash long")


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_statistics(nodes: DataFrame) -> np.ndarray:
    """How often bits i and j are both 1, over all fingerprints: 64 x 64 sums, whatever their number."""
    def run(rows):
        total = np.zeros((BITS, BITS), np.int64)
        for batch in rows:
            b = _bits(batch.column("fp").to_numpy()).astype(np.float64)
            total += np.rint(b.T @ b).astype(np.int64)
        i, j = np.triu_indices(BITS)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(i * BITS + j), pa.array(total[i, j])], names=["ij", "n"])

    out = np.zeros((BITS, BITS))
    for r in nodes.select("fp").mapInArrow(run, "ij long, n long").groupBy("ij").agg(F.sum("n").alias("n")).collect():
        out[divmod(r.ij, BITS)] = out[divmod(r.ij, BITS)[::-1]] = r.n
    return out


def group_bits(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size: each grows from the bit with the strongest links left, by the
    bit that correlates most with those it has. What one bit of a group tells, the others repeat, and the groups
    differ the more."""
    p = np.diag(together) / max(n, 1)
    dev = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(dev, dev))
    left, out = list(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        first = max(left, key=lambda b: (corr[b, left].sum() - corr[b, b], -b))
        group = [first]
        left.remove(first)
        while len(group) < size:
            best = max(left, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def allocate(cost: list[list[float]], budget: int) -> list[int]:
    """Thresholds (-1: group not used) that add up to ``budget`` at the least sum of ``cost[group][threshold + 1]``."""
    best = {0: (0.0, [])}
    for row in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (c, chosen) in best.items():
            for t, x in enumerate(row, -1):
                if used + t not in step or c + x < step[used + t][0]:
                    step[used + t] = (c + x, [*chosen, t])
        best = step
    return best[budget][1]


@lru_cache(maxsize=None)
def _masks(group: tuple[int, ...], t: int) -> np.ndarray:
    """Bits of the group left when t of them are not looked at: two values within t bits agree under one of the masks."""
    full = sum(1 << b for b in group)
    return np.array([full & ~sum(1 << b for b in drop) for drop in combinations(group, t)], np.uint64)


def plan(nodes: DataFrame, distance: int, choices=(2, 3, 4)) -> list[tuple[tuple[int, ...], int]]:
    """[(bits, threshold)]: the groups and the thresholds to probe them with.

    Generalised pigeonhole: with thresholds that add up to distance - groups + 1, two fingerprints within ``distance``
    bits are within its threshold in one group at least. For every number of groups the costs of each threshold are
    estimated, from the groups' value counts over all fingerprints and the bits' own rates, and the thresholds
    allocated by dynamic programming; the cheapest number of groups wins."""
    n = nodes.count()
    together = bit_statistics(nodes)
    p = np.diag(together) / max(n, 1)
    differ = 2 * p * (1 - p)
    layouts = {m: group_bits(together, n, m) for m in choices}
    masks = [(m, g, sum(1 << b for b in group)) for m, groups in layouts.items() for g, group in enumerate(groups)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    parts = F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(signed(x)).cast("long")).alias("key"))
                      for i, (*_, x) in enumerate(masks)])
    same = {r.part: float(r.pairs) for r in nodes.select(F.explode(parts).alias("x")).groupBy("x.part", "x.key").count()
            .groupBy("part").agg(F.sum(F.col("count") * (F.col("count") - 1) / 2).alias("pairs")).collect()}
    best = None
    for m, groups in layouts.items():
        budget, costs = distance - m + 1, []
        for g, group in enumerate(groups):
            base = same.get(next(i for i, x in enumerate(masks) if x[:2] == (m, g)), 0.0)
            # pairs that differ in d of the group's bits, from those that differ in none
            odds = np.array([differ[b] / max(1 - differ[b], 1e-9) for b in group])
            poly = np.array([1.0])
            for o in odds:
                poly = np.convolve(poly, [1, o])[:distance + 2]
            row = [0.0]
            for t in range(distance + 1):
                met = sum(base * poly[d] * comb(len(group) - d, t - d) for d in range(min(t, len(poly) - 1) + 1))
                row.append(n * comb(len(group), t) * ROW_COST + met * PAIR_COST)
            costs.append(row)
        chosen = allocate(costs, budget)
        total = sum(row[t + 1] for row, t in zip(costs, chosen))
        if best is None or total < best[0]:
            best = (total, [(tuple(g), t) for g, t in zip(groups, chosen) if t >= 0])
    return best[1]


def _forest(x: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join what is within ``distance`` in ``x``, as few as that takes."""
    out, left = [], np.arange(len(x))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            i = queue.pop()
            near = np.bitwise_count(x[left] ^ x[i]) <= distance
            out += [(i, j) for j in left[near]]
            queue += list(left[near])
            left = left[~near]
    return out


def _bucket_links(distance: int):
    """Rows sorted by (mask, key) to links. Neighbours up to 16 places apart are compared for all buckets at once,
    buckets beyond that size one by one."""
    def run(rows):
        rest = None
        def links(mask, key, fp):
            new = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            starts, ends = np.r_[0, new], np.r_[new, len(fp)]
            sizes = ends - starts
            a, b = [], []
            end = np.repeat(ends, sizes)
            small = np.repeat(sizes <= 16, sizes)
            for d in range(1, min(16, int(sizes.max())) if len(fp) else 0):
                i = np.flatnonzero(small[:-d] & (np.arange(len(fp) - d) + d < end[:-d]))
                if not len(i):
                    break
                i = i[np.bitwise_count((fp[i] ^ fp[i + d]).view(np.uint64)) <= distance]
                a.append(fp[i])
                b.append(fp[i + d])
            for s, e in zip(starts[sizes > 16], ends[sizes > 16]):
                x = np.unique(fp[s:e])
                found = _forest(x.view(np.uint64), distance)
                a.append(x[[i for i, _ in found]].astype("<i8") if found else x[:0])
                b.append(x[[j for _, j in found]].astype("<i8") if found else x[:0])
            a, b = (np.concatenate(y) if y else np.empty(0, "<i8") for y in (a, b))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in rows:
            now = [batch.column(c).to_numpy() for c in ("mask", "key", "fp")]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now)]
            if not len(now[0]):
                continue
            last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0  # the last bucket may go on in the next batch
            if cut:
                yield links(*(x[:cut] for x in now))
            rest = [x[cut:] for x in now]
        if rest is not None and len(rest[0]):
            yield links(*rest)

    return run


def _edges(free: list[int], distance: int) -> np.ndarray:
    """Ways to leave a fingerprint and reach a shared place: (bits flipped, bits not looked at).

    Two fingerprints within 2r bits share a point within r of both; within 2r + 1 they share an edge (a point with one
    bit not looked at) whose nearer end is within r of each. And what shares one is within that distance."""
    r, out = distance // 2, []
    for k in range(r + 1):
        for flip in combinations(free, k):
            f = sum(1 << b for b in flip)
            out += [(f, 1 << b) for b in free if b not in flip] if distance % 2 else [(f, 0)]
    return np.array(out, np.uint64)


def links(nodes: DataFrame, distance: int = 3, large: int = LARGE) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` so that what is connected within ``distance`` bits is
    connected by them. Every link is verified.

    Each fingerprint goes to the buckets of the plan; a bucket of up to ``large`` members is compared inside one task
    and yields no more than a spanning forest (or 15 links a member, in buckets of up to 16). The members of larger
    buckets (near copies by the ten thousand) are not compared: each names the edges of the hypercube around it, a
    fixed number, and meets at them exactly those within ``distance``; linked to the least there."""
    layout = [(_masks(g, t), t) for g, t in plan(nodes, distance)]
    masks = np.unique(np.concatenate([m for m, _ in layout]))

    def keys(rows):
        for batch in rows:
            fp = batch.column("fp").to_numpy()
            step = max(1, 200_000 // len(masks))
            for s in range(0, len(fp), step):
                part = fp[s:s + step]
                key = (part.view(np.uint64)[:, None] & masks[None, :]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(len(masks), dtype=np.int32), len(part))), pa.array(key.reshape(-1)),
                     pa.array(np.repeat(part, len(masks)))], names=["mask", "key", "fp"])

    keyed = nodes.select("fp").mapInArrow(keys, "mask int, key long, fp long")
    # one mask's counts by key: no bucket of more than ``large`` means that nothing has to be set apart
    crowded = keyed.groupBy("mask", "key").count().where(F.col("count") > large).select("mask", "key")
    crowded = materialize(crowded, "crowded")
    any_crowded = not crowded.isEmpty()
    plain = keyed.join(crowded, ["mask", "key"], "left_anti") if any_crowded else keyed
    out = plain.repartition("mask", "key").sortWithinPartitions("mask", "key").mapInArrow(_bucket_links(distance), "a long, b long")
    if not any_crowded:
        return out
    # within a bucket the bits of its mask agree, so only the others differ
    table = masks.copy()

    def around(rows):
        ways: dict[int, np.ndarray] = {}
        for batch in rows:
            for m, k, fp in zip(*(batch.column(c).to_pylist() for c in ("mask", "key", "fp"))):
                if m not in ways:
                    free = [b for b in range(BITS) if not int(table[m]) >> b & 1]
                    ways = {m: _edges(free, distance)}
                flip, blind = ways[m][:, 0], ways[m][:, 1]
                x = (np.uint64(fp & (1 << 64) - 1) ^ flip) & ~blind
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), m, np.int32)), pa.array(x.view(np.int64)), pa.array(blind.view(np.int64)),
                     pa.array(np.full(len(x), fp, np.int64))], names=["mask", "point", "blind", "fp"])

    hot = keyed.join(crowded, ["mask", "key"]).repartition("fp").mapInArrow(around, "mask int, point long, blind long, fp long")
    # who meets at a place links to the least there; the places themselves are aggregated, never collected
    least = hot.groupBy("mask", "point", "blind").agg(F.min("fp").alias("a"), F.max("fp").alias("z"), F.count("*").alias("n"))
    two = least.where("n = 2").select("a", F.col("z").alias("b"))
    more = hot.join(least.where("n > 2").select("mask", "point", "blind", "a"), ["mask", "point", "blind"]) \
        .select("a", F.col("fp").alias("b"))
    return out.union(two).union(more.where("a <> b").distinct())


def _rooted(nodes: DataFrame, distance: int) -> DataFrame:
    """``nodes`` (distinct ``fp``) with the ``root`` of their group."""
    found = components(links(nodes, distance))
    return nodes.join(found, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp")).drop("node")


def survivors(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """``doc_id, text_hash`` (xxhash64) of the row that stays of each group of near duplicates: the smallest id, then the
    smallest fingerprint, then the smallest hash. Ids must not be null; groups that share a smallest id keep a row each."""
    row = F.struct("doc_id", "fp", "text_hash")
    nodes = materialize(fingerprints(docs, shingle).groupBy("fp").agg(F.min(row).alias("row")), "nodes")
    return _rooted(nodes, distance).groupBy("root").agg(F.min("row").alias("row")).select("row.doc_id", "row.text_hash")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``, the smallest
    ``doc_id`` reachable over links of at most ``distance`` bits, its own included.

    Exact copies (and all texts without words) have one fingerprint, which is one node, so a group of copies costs one
    row however large. Null ids take part but are never the smallest; a group of null ids only has a null
    ``component_id``. Repeated rows get the same row each. An empty table gives none."""
    prints = materialize(fingerprints(docs, shingle).select("doc_id", "fp"), "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    rooted = _rooted(nodes, distance)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.join(least, "root").select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(labels, F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

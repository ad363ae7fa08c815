"""N-gram Jaccard join by PartEnum signatures: exact links between sets of word shingles, and their components."""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import arrow, batches, id_text
from tagloom.operators.skew import heavy_join
from tagloom.session import materialize, maybe_broadcast

SHINGLE, PERCENT = 4, 85   # words of a shingle; 100 * intersection >= PERCENT * union
ELEMENTS = 4               # shingles that a signature covers in the middle of a band, at least, where the band allows it
CHUNK = 4096               # sets of one signature that are compared with as many others in one place
SET_BYTES = 32 << 20       # of sets that are brought to one place, about
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingles:
    """``text -> sorted distinct 64-bit hashes of its shingles``: each distinct word is hashed once in a worker (the table
    is emptied when full), and the hashes of neighbouring words are combined."""

    def __init__(self, shingle: int = SHINGLE, most_words: int = 1 << 20):
        self.shingle, self.most, self.words = shingle, most_words, {}
        self.factors = _mix(np.arange(1, shingle + 1, dtype=_U)) | _U(1)

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, _U)
        words, known = text.encode("utf-8", "surrogatepass").lower().split(), self.words
        if len(known) > self.most:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), _U, len(words))
        n = min(self.shingle, len(words))
        if not n:
            return h
        count = len(h) - n + 1
        out = np.full(count, n, _U)  # sequences shorter than a shingle are told apart by their number of words
        for i in range(n):
            out += h[i:i + count] * self.factors[i]
        return np.unique(_mix(out))


def class_of(hashes: np.ndarray) -> int:
    """One signed 64-bit name for equal sets."""
    return int(_mix(np.array([_mix(hashes ^ _U(0x9E3779B97F4A7C15)).sum(dtype=_U) + _U(len(hashes))]))[0].view("<i8")) if len(hashes) else 0


def most_apart(total: int, percent: int = PERCENT) -> int:
    """How many shingles two linked sets whose sizes add up to ``total`` at most do not share."""
    # intersection >= percent / (100 + percent) * total
    return max((t + 2 * (-percent * t // (100 + percent)) for t in range(max(total - 5, 0), total + 1)), default=0)


@lru_cache(maxsize=None)
def band(index: int, percent: int = PERCENT) -> tuple[int, int]:
    """Sizes (first, last) of a band: a set links only within its band and with the next one on either side. Bands are two
    steps of 100 / ``percent`` wide, so half of the sets are too small to link with the next one at all."""
    first = 1 if index == 0 else band(index - 1, percent)[1] + 1
    return first, first * 100 // percent * 100 // percent


@lru_cache(maxsize=None)
def plan(index: int, percent: int = PERCENT) -> tuple[int, int, tuple[tuple[int, ...], ...], int] | None:
    """(n1, n2, subsets, spare): how sets whose larger one is in a band are signed; None where only equal sets link.

    The domain of shingles falls into n1 partitions and each of these into n2 parts. Two linked sets differ in k elements at
    most. If n1 = floor(k / (k2 + 1)) + 1 + spare, then in 1 + spare partitions they differ in k2 at most, so n2 - k2 of
    the parts there are equal: some subset of that size signs both alike. Chosen is what needs the fewest signatures of
    ``ELEMENTS`` elements on average, those of nothing (``Signer``) included, with less than one chance in 100,000 that two
    strangers share one of nothing; where the sets are too small for that, what comes nearest."""
    first, last = band(index, percent)
    k = most_apart(2 * last, percent)
    if not k:
        return None
    options = []
    for k2 in range(1, min(k, 4) + 1):
        for n2 in range(k2 + 1, k2 + 5):
            subsets = tuple(combinations(range(n2), n2 - k2))
            for spare in (*range(33), *range(40, 400, 20)):
                n1 = k // (k2 + 1) + 1 + spare
                share = (n2 - k2) / n2 / n1
                # empty subsets of the smallest set that is signed here, and how many choices of 1 + spare of them
                least = share * percent * first / 100
                of = lambda one: (1 + spare) * (math.log(n1 * len(subsets)) - one) - math.lgamma(2 + spare)
                choices, strangers = math.exp(min(of(least), 30)), of(2 * least) / math.log(10)
                short = max(ELEMENTS - share * (first * last) ** 0.5, 0) + max(strangers + 5, 0)
                options.append((short, n1 * len(subsets) + choices, n1, n2, subsets, spare))
    return min(options, key=lambda o: (round(o[0], 3), *o[1:4]))[2:]


def sketch(h: np.ndarray, index: int, percent: int = PERCENT) -> bytes:
    """Parities of a set's elements hashed to 1.5 bits for each element of the band's largest set. Every bit in which two
    sketches differ takes an element that only one of the sets has."""
    bits = 64 * -(-3 * band(index, percent)[1] // 128)
    place = ((_mix(h ^ _U(0xA0761D6478BD642F)) >> _U(32)) * _U(bits) >> _U(32)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits) & 1).tobytes()


class Signer:
    """``sorted distinct hashes -> signatures``, for the set's band and, as the smaller set of a pair, for the next one."""

    def __init__(self, percent: int = PERCENT):
        self.percent, self.last = percent, [band(0, percent)[1]]

    def bands(self, size: int) -> list[int]:
        """The band of a set and, if it can link with larger sets there, the next one."""
        while self.last[-1] < size:
            self.last.append(band(len(self.last), self.percent)[1])
        own = int(np.searchsorted(self.last, size))
        return [own, own + 1] if 100 * size >= self.percent * band(own + 1, self.percent)[0] else [own]

    def __call__(self, h: np.ndarray) -> np.ndarray:
        return np.concatenate([self.sign(h, b) for b in self.bands(len(h))])

    def sign(self, h: np.ndarray, index: int) -> np.ndarray:
        how = plan(index, self.percent)
        if how is None:
            return np.empty(0, _U)
        n1, n2, subsets, spare = how
        cell = ((h >> _U(32)) * _U(n1) >> _U(32)) * _U(n2) + ((h & _U(0xFFFFFFFF)) * _U(n2) >> _U(32))
        cell = cell.astype(np.int64)
        sums, size = np.zeros(n1 * n2, _U), np.bincount(cell, minlength=n1 * n2).reshape(n1, n2)
        np.add.at(sums, cell, _mix(h + _U(0xD1B54A32D192ED03)))
        sums = sums.reshape(n1, n2)
        places = np.array([sum(1 << p for p in s) for s in subsets], _U)
        signs = np.stack([sums[:, list(s)].sum(axis=1, dtype=_U) for s in subsets], axis=1)
        held = np.stack([size[:, list(s)].sum(axis=1) for s in subsets], axis=1)
        where = (_U(index) << _U(40)) + (np.arange(n1, dtype=_U)[:, None] << _U(8)) + places[None, :]
        signs = _mix(signs ^ _mix(where))
        empty = held == 0
        some = signs[~empty]
        # 1 + spare partitions agree. Either one agrees in some elements, or all agree in nothing: then both sets have
        # nothing there, and so share one choice of 1 + spare such places. Strangers hardly ever do.
        thin = np.flatnonzero(empty.any(axis=1))
        if len(thin) <= spare:
            return some
        marks = [_mix(where[i][empty[i]]) for i in thin]
        none = [_mix(_mix(np.array(m, _U)).sum(keepdims=True, dtype=_U) + _U(index)) for c in combinations(marks, 1 + spare) for m in product(*c)]
        return np.concatenate([some, *none])


ROWS = "doc_id long, text_hash long, cls long, size long, band int, own binary, next binary, own_sigs binary, next_sigs binary"


def profiles(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, most_seen: int = 1 << 20) -> DataFrame:
    """``ROWS``: one row per row of ``docs``: the name and size of its shingle set and its band; and, once for each set in a
    stretch of rows, its sketches and signatures for that band and, where it takes part there, for the next one."""
    def run(rows):
        sets, sign, shape, seen = Shingles(shingle), Signer(percent), arrow(ROWS), set()
        for batch in batches(rows):
            out = []
            for doc, code, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "text"))):
                h = sets(text)
                cls, bands = class_of(h), sign.bands(len(h)) if len(h) else [-1]
                cells = {}
                if len(h) and cls not in seen:
                    seen.add(cls)
                    cells = {b: (sketch(h, b, percent), sign.sign(h, b).tobytes()) for b in bands if plan(b, percent)}
                own, after = (cells.get(bands[0] + i, (None, None)) for i in (0, 1))
                out.append((doc, code, cls, len(h), bands[0], own[0], after[0], own[1], after[1]))
            if len(seen) > most_seen:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), shape)], schema=shape)

    return id_text(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, ROWS)


SIGNED = "sig long, cls long, size int, band int, lead long, lead_size int"


def signatures(rows: DataFrame, most: int = 1 << 19) -> DataFrame:
    """``SIGNED``: the signatures of all sets (``ROWS``), one row for each in a stretch of about ``most`` signatures.

    Where a signature has several sets within a stretch, the least is their ``lead`` there and only its row (lead null)
    goes on to meet the same signature of other stretches; the rows of the others say whom they met already."""
    def run(rows):
        shape, held, n = arrow(SIGNED), [], 0

        def flush():
            sig, cls, size, level = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((cls, sig))
            sig, cls, size, level = sig[order], cls[order], size[order], level[order]
            new = np.r_[True, sig[1:] != sig[:-1]]
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            keep = ~np.r_[False, (sig[1:] == sig[:-1]) & (cls[1:] == cls[:-1])]
            cols = sig[keep], cls[keep], size[keep], level[keep], pa.array(cls[first][keep], mask=new[keep]), pa.array(size[first][keep], mask=new[keep])
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], schema=shape)

        for batch in rows:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for column, step in (("own_sigs", 0), ("next_sigs", 1)):
                    here = part.filter(pc.is_valid(part.column(column)))
                    blobs = here.column(column).to_pylist()
                    counts = [len(x) // 8 for x in blobs]
                    sig = np.frombuffer(b"".join(blobs), "<i8")
                    cls, size, level = (np.repeat(here.column(c).to_numpy(), counts) for c in ("cls", "size", "band"))
                    held.append((sig, cls, size.astype("<i4"), (level + step).astype("<i4")))
                    n += len(sig)
                if n > most:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    return rows.where("own_sigs IS NOT NULL OR next_sigs IS NOT NULL").select("cls", "size", "band", "own_sigs", "next_sigs").mapInArrow(run, SIGNED)


MET = "sig long, band int, lead long, lead_size int, cls long, size int"


def meetings(signed: DataFrame) -> DataFrame:
    """``MET``: rows of one signature next to each other; each set but the first of a signature meets that first one. Rows
    with a lead have met it already, and lie wherever they fall: a signature has one other row for each stretch."""
    def run(rows):
        shape, last = arrow(MET), (None, None, 0, 0)  # (sig, cls, lead, lead_size) of the last row that takes part
        for batch in rows:
            sig, cls, size, level, lead, lead_size = (batch.column(i) for i in range(6))
            met = pc.is_valid(lead)
            out = [pa.RecordBatch.from_arrays([c.filter(met) for c in (sig, level, lead, lead_size, cls, size)], schema=shape)]
            alone = np.flatnonzero(~met.to_numpy(zero_copy_only=False))
            if len(alone):
                sig, cls, size, level = (c.to_numpy(zero_copy_only=False)[alone] for c in (sig, cls, size, level))
                joins = bool(sig[0] == last[0])
                new = np.r_[not joins, sig[1:] != sig[:-1]]
                again = np.r_[joins and bool(cls[0] == last[1]), (sig[1:] == sig[:-1]) & (cls[1:] == cls[:-1])]
                at = np.cumsum(new) - 1  # -1: still the signature that the batch before ended with
                first = np.flatnonzero(new)[np.maximum(at, 0)] if new.any() else np.zeros(len(sig), np.int64)
                lead = np.where(at < 0, last[2], cls[first])
                lead_size = np.where(at < 0, last[3], size[first]).astype("<i4")
                last = sig[-1], cls[-1], lead[-1], lead_size[-1]
                keep = ~new & ~again & (cls != lead)
                out.append(pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (sig, level, lead, lead_size, cls, size)], schema=shape))
            yield from (b for b in out if b.num_rows)

    parts = int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    where = F.when(F.col("lead").isNull(), F.col("sig")).otherwise(F.xxhash64("cls", "sig"))
    return signed.withColumn("at", where).repartition(parts, "at").drop("at").sortWithinPartitions("sig", "cls").mapInArrow(run, MET)


def shingle_sets(docs: DataFrame, wanted: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``cls, shingles`` (distinct hashes) of the classes in ``wanted`` (``cls, text_hash`` of one of its texts). Only those
    texts are read again word by word."""
    def run(rows):
        sets = Shingles(shingle)
        for batch in batches(rows):
            found = {}
            for text in batch.column("text").to_pylist():
                h = sets(text)
                if len(h):
                    found.setdefault(class_of(h), h.view("<i8"))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.list_(pa.int64()))],
                                             names=["cls", "shingles"])

    texts = id_text(docs).withColumn("text_hash", F.xxhash64("text"))
    texts = texts.join(maybe_broadcast(wanted.select("text_hash").distinct(), 1_000_000), "text_hash", "left_semi").select("text")
    return texts.mapInArrow(run, "cls long, shingles array<long>").dropDuplicates(["cls"])


def verified(pairs: DataFrame, docs: DataFrame, sketches: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The pairs ``a, b`` whose sets are linked, by the exact intersection of the sets."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = materialize(shingle_sets(docs, sketches.join(nodes, "cls", "left_semi"), shingle), "jaccard-sets")
    one, two = (sets.select(F.col("cls").alias(c), F.col("shingles").alias(s)) for c, s in (("a", "of_a"), ("b", "of_b")))
    both = F.size(F.array_intersect("of_a", "of_b"))
    return pairs.join(two, "b").join(one, "a").where(100 * both >= percent * (F.size("of_a") + F.size("of_b") - both)).select("a", "b")


def _apart_bound(total, percent: int):
    """``most_apart`` for a pair of sizes: beyond it two sets are not linked."""
    return total - 2 * F.ceil(F.lit(percent) * total / F.lit(100 + percent) - F.lit(1e-9))


def near_by_sketch(pairs: DataFrame, sketches: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``a, b, n`` of the pairs (a, b, band, n) whose sketches differ in no more bits than linked sets may in elements."""
    one, two = (sketches.select(F.col("cls").alias(c), "band", F.col("bits").alias(f"bits_{c}"), F.col("size").alias(f"size_{c}")) for c in "ab")
    joined = pairs.join(two, ["b", "band"]).join(one, ["a", "band"])

    def run(rows):
        for batch in rows:
            x, y = (batch.column(c).to_pylist() for c in ("bits_a", "bits_b"))
            differ = np.array([(int.from_bytes(p, "little") ^ int.from_bytes(q, "little")).bit_count() for p, q in zip(x, y)], np.int64)
            yield batch.select(["a", "b", "n"]).filter(pa.array(differ <= batch.column("most").to_numpy(zero_copy_only=False)))

    return joined.withColumn("most", _apart_bound(F.col("size_a") + F.col("size_b"), percent)) \
        .select("a", "b", "n", "most", "bits_a", "bits_b").mapInArrow(run, "a long, b long, n long")


def _pairs_of(bits: np.ndarray, cut: int | None, root: np.ndarray, size: np.ndarray, percent: int):
    """(places, places, bits apart) of sets in different components whose sizes and sketches allow a link: among all sets, or
    between those before ``cut`` and those from it on."""
    words = np.ascontiguousarray(bits).view("<u8")
    rows, cols = (np.arange(len(words)),) * 2 if cut is None else (np.arange(cut), np.arange(cut, len(words)))
    found = [(np.zeros(0, np.int64),) * 3]
    for at in range(0, len(rows), 256):
        i = rows[at:at + 256]
        x, y = np.nonzero((root[i][:, None] != root[cols][None, :]) & ((cut is not None) | (i[:, None] < cols[None, :])))
        x, y = i[x], cols[y]
        total = size[x] + size[y]
        fits = 100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])
        x, y, total = x[fits], y[fits], total[fits]
        apart = np.zeros(len(x), np.int64)
        for w in range(words.shape[1]):
            apart += np.bitwise_count(words[x, w] ^ words[y, w])
        near = apart <= total - 2 * -(-percent * total // (100 + percent))
        found.append((x[near], y[near], apart[near]))
    return tuple(np.concatenate(c) for c in zip(*found))


def _nearest_only(x, y, apart, most: int = 2):
    """Of the pairs those that are among the ``most`` nearest of one of their sets."""
    one, two, d = np.r_[x, y], np.r_[y, x], np.r_[apart, apart]
    order = np.lexsort((two, d, one))
    new = np.r_[True, one[order][1:] != one[order][:-1]]
    rank = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    keep = order[rank < most]
    return one[keep], two[keep]


def _members(met: DataFrame, sketches: DataFrame, roots: DataFrame, most_bytes: int | None = None) -> DataFrame:
    """``sig, cls, root, size, bits, cut, i, j``: the sets of each signature that holds several components. Signatures with the
    same sets count once. One with more than ``CHUNK`` sets (or, with ``most_bytes``, larger ones) is cut, and each two of its
    cuts meet in a place (i, j) of their own."""
    size = ["size"] if most_bytes else []
    members = met.select("sig", "band", "cls", *size).union(met.select("sig", "band", "lead", *(f"lead_{c}" for c in size))).distinct()
    members = _labelled(members, "cls", roots, "root")
    most = F.col("n") / CHUNK
    if most_bytes:
        most = F.greatest(most, F.col("bytes") / most_bytes)
    total = F.sum(8 * F.col("size").cast("long")) if most_bytes else F.lit(0)
    mixed = members.groupBy("sig", "band").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("n"), F.sum(F.xxhash64("cls").cast("decimal(38,0)")).alias("sets"), total.alias("bytes"))
    mixed = mixed.where("x <> y").groupBy("band", "x", "y", "n", "sets").agg(F.min("sig").alias("sig"), F.max("bytes").alias("bytes"))
    members = members.drop("size").join(mixed.select("sig", F.ceil(most).alias("cuts")), "sig").join(sketches.drop("text_hash"), ["cls", "band"])
    members = members.withColumn("cut", F.pmod(F.xxhash64("cls"), F.col("cuts")))
    others = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1).cast("array<bigint>"), lambda o: F.struct(F.least("cut", o).alias("i"), F.greatest("cut", o).alias("j")))
    return members.select("sig", "cls", "root", "size", "bits", "cut", F.inline(others))


def _by_place(members: DataFrame, settle, schema: str) -> DataFrame:
    """``settle`` over tables of whole places: it is given the table and where its places begin and end, and gives batches."""
    def starts(t):
        key = [t.column(c).to_numpy() for c in ("sig", "i", "j")]
        return np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in key], axis=0)])

    def whole(t):
        t = t.combine_chunks()
        at = starts(t).tolist()
        return settle(t, list(zip(at, [*at[1:], t.num_rows])))

    def run(rows):
        held = None
        for batch in rows:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            last = int(starts(t)[-1]) if t.num_rows else 0
            if last:  # the last place may go on in the next batch
                yield from whole(t.slice(0, last))
            held = t.slice(last)
        if held is not None and held.num_rows:
            yield from whole(held)

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return members.repartition(parts, "sig", "i", "j").sortWithinPartitions("sig", "i", "j", "cut").mapInArrow(run, schema)


def _apart_pairs(t: pa.Table, places, percent: int):
    """Of each place with several components: (first row, last row + 1, pairs that sizes and sketches allow, their bits apart)."""
    i, j, cut, root, size = (t.column(c).to_numpy() for c in ("i", "j", "cut", "root", "size"))
    bits = t.column("bits").to_pylist()
    for s, e in places:
        if e - s > 1 and (root[s:e] != root[s]).any():
            table = np.frombuffer(b"".join(bits[s:e]), np.uint8).reshape(e - s, -1)
            yield s, e, *_pairs_of(table, None if i[s] == j[s] else int((cut[s:e] == i[s]).sum()), root[s:e], size[s:e].astype(np.int64), percent)


CROSS = "a long, b long, open long"


def cross_pairs(met: DataFrame, sketches: DataFrame, roots: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``CROSS``: pairs of sets that share a signature, lie in different components and may be linked by their sketches.

    Where a signature has more than two such pairs for each of its sets, only the two nearest of each set are given, and the
    signature is named as ``open``: ``closing_links`` settles the rest."""
    def settle(t, places):
        cls, sig = (t.column(c).to_numpy() for c in ("cls", "sig"))
        a, b, left = [], [], []
        for s, e, x, y, apart in _apart_pairs(t, places, percent):
            if len(x) > 2 * (e - s):
                x, y = _nearest_only(x, y, apart)
                left.append(sig[s])
            a.append(cls[s:e][x])
            b.append(cls[s:e][y])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        none = [None] * len(left)
        return [pa.RecordBatch.from_arrays([pa.array([*pairs[0].tolist(), *none], pa.int64()), pa.array([*pairs[1].tolist(), *none], pa.int64()),
                                            pa.array([None] * pairs.shape[1] + left, pa.int64())], names=["a", "b", "open"])]

    return _by_place(_members(met, sketches, roots), settle, CROSS)


def closing_links(met: DataFrame, sketches: DataFrame, roots: DataFrame, docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``a, b``: links that connect what is still apart in each signature of ``met``, found among all its pairs.

    The sets come to the places where they have a pair left, and are intersected there, the nearest pairs first; pairs that
    links of the place connect already are passed over. So a place gives less links than it has sets, however many pairs it
    holds."""
    def paired(t, places):
        rows = [np.unique(np.r_[x, y]) + s for s, e, x, y, apart in _apart_pairs(t, places, percent)]
        return t.take(pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))).to_batches()

    members = _members(met, sketches, roots, SET_BYTES)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema)
    members = materialize(_by_place(members, paired, kinds), "jaccard-members")
    nodes = members.select("cls").distinct()
    sets = materialize(shingle_sets(docs, sketches.join(nodes, "cls", "left_semi"), shingle), "jaccard-sets")

    def settle(t, places):
        cls, lists, a, b = t.column("cls").to_numpy(), t.column("shingles").combine_chunks(), [], []
        ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        for s, e, x, y, apart in _apart_pairs(t, places, percent):
            up = {}

            def find(k):
                while up.setdefault(k, k) != k:
                    up[k] = k = up[up[k]]
                return k

            root = t.column("root").to_numpy()[s:e].tolist()
            sets_ = [values[ends[k]:ends[k + 1]] for k in range(s, e)]
            order = np.argsort(apart, kind="stable")
            for p, q in zip(x[order].tolist(), y[order].tolist()):
                one, two = find(root[p]), find(root[q])
                if one == two:
                    continue
                both = len(np.intersect1d(sets_[p], sets_[q], assume_unique=True))
                if 100 * both >= percent * (len(sets_[p]) + len(sets_[q]) - both):
                    up[max(one, two)] = min(one, two)
                    a.append(int(cls[s + p]))
                    b.append(int(cls[s + q]))
        return [pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])]

    return _by_place(members.join(sets, "cls"), settle, "a long, b long").distinct()


def connected(links: DataFrame, most_rounds: int = 40) -> DataFrame:
    """``node, root`` as ``components`` gives them, in one exchange a round: every node and its neighbours, in order, move to
    the least of them (hash to min). Links of one task are first reduced to those that connect something new there."""
    def thin(rows):
        up = {}

        def find(x):
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        for batch in rows:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = find(a), find(b)
                if a != b:
                    up[max(a, b)] = min(a, b)
            if len(up) > 1 << 18:
                yield stars(up, find)
                up.clear()
        if up:
            yield stars(up, find)

    def stars(up, find):
        rows = [(x, find(x)) for x in list(up) if find(x) != x]
        x, r = (np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 2
        return pa.RecordBatch.from_arrays([pa.array(np.r_[x, r]), pa.array(np.r_[r, x])], names=["u", "v"])

    def step(rows):
        node, least, last = None, None, None
        for batch in rows:
            u, v = batch.column("u").to_numpy(), batch.column("v").to_numpy()
            if not len(u):
                continue
            goes_on = u[0] == node
            new = np.r_[not goes_on, u[1:] != u[:-1]]
            at = np.flatnonzero(new)
            low = np.empty(len(u), np.int64)  # v ascends: the least neighbour comes first
            if len(at):
                low[at[0]:] = np.repeat(np.minimum(u[at], v[at]), np.diff(np.r_[at, len(u)]))
            low[:at[0] if len(at) else len(u)] = 0 if least is None else least
            again = np.r_[bool(goes_on and v[0] == last), (u[1:] == u[:-1]) & (v[1:] == v[:-1])]
            # the node itself and all its neighbours learn of the least; it has settled if that is all that it knows
            mine, theirs = new & (low != u), ~again & (low != v)
            settled = np.where(low == u, True, v == low)
            a = np.r_[u[mine], low[mine], v[theirs], low[theirs]]
            b = np.r_[low[mine], u[mine], low[theirs], v[theirs]]
            still = np.zeros(len(a), bool)
            still[len(a) - int(theirs.sum()):] = ~settled[theirs]
            node, least, last = u[-1], low[-1], v[-1]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(still)], names=["u", "v", "moving"])

    parts = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = links.select("a", "b").mapInArrow(thin, "u long, v long")
    for _ in range(most_rounds):
        edges = edges.select("u", "v").repartition(parts, "u").sortWithinPartitions("u", "v").mapInArrow(step, "u long, v long, moving boolean")
        edges = materialize(edges, "jaccard-edges")
        if not edges.where("moving").limit(1).count():
            return edges.where("v < u").select(F.col("u").alias("node"), F.col("v").alias("root")).distinct()
    raise RuntimeError("components did not settle")


def _labelled(rows: DataFrame, column: str, roots: DataFrame, name: str) -> DataFrame:
    """``rows`` with the component of the class in ``column`` (itself where it has no link)."""
    return rows.join(roots.select(F.col("node").alias(column), F.col("root").alias("__root")), column, "left") \
        .withColumn(name, F.coalesce("__root", column)).drop("__root")


def linked_classes(docs: DataFrame, rows: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``node, root``: classes with a link to another class, and the least class that each can reach. ``rows``: ``ROWS``.

    All pairs of sets that share a signature are settled: ruled out by sizes or sketches, verified by their intersection, or
    connected already by others. In the order that spares most: first each set against the lead that it shares the most
    signatures with; then, in signatures that hold several components, the pairs that are still apart, where they are many
    the nearest ones; at last all pairs of those where some were left, in the place where their sets meet."""
    met = materialize(meetings(signatures(rows)), "jaccard-met")
    each = F.array(F.struct(F.col("band").alias("band"), F.col("own").alias("bits")), F.struct((F.col("band") + 1).alias("band"), F.col("next").alias("bits")))
    sketches = rows.where("own IS NOT NULL OR next IS NOT NULL").select("cls", "text_hash", F.col("size").cast("int").alias("size"), F.inline(each))
    sketches = materialize(sketches.where("bits IS NOT NULL").dropDuplicates(["cls", "band"]), "jaccard-sketches")
    star = met.where(100 * F.least("lead_size", "size") >= percent * F.greatest("lead_size", "size")) \
        .groupBy(F.least("lead", "cls").alias("a"), F.greatest("lead", "cls").alias("b")).agg(F.min("band").alias("band"), F.count("*").alias("n"))
    best = near_by_sketch(star, sketches, percent).groupBy("b").agg(F.max_by("a", F.struct("n", -F.col("a"))).alias("a"))
    done = materialize(best.select("a", "b"), "jaccard-done")
    links = materialize(verified(done, docs, sketches, shingle, percent), "jaccard-links")
    roots = materialize(connected(links), "jaccard-roots")
    cross = materialize(cross_pairs(met, sketches, roots, percent), "jaccard-cross")
    pairs = materialize(cross.where("a IS NOT NULL").select("a", "b").distinct().join(done, ["a", "b"], "left_anti"), "jaccard-pairs")
    if pairs.limit(1).count():
        links = links.union(materialize(verified(pairs, docs, sketches, shingle, percent), "jaccard-links"))
        roots = materialize(connected(links), "jaccard-roots")
    left = cross.where("open IS NOT NULL").select(F.col("open").alias("sig")).distinct()
    if left.limit(1).count():
        new = materialize(closing_links(met.join(left, "sig", "left_semi"), sketches, roots, docs, shingle, percent), "jaccard-links")
        if new.limit(1).count():
            roots = materialize(connected(links.union(new)), "jaccard-roots")
    return roots


def similar_documents(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per row of ``docs``.

    Documents are sets of distinct shingles of lower-cased (A-Z) words; those with fewer words are one shingle, the whole
    sequence. Two link where 100 * intersection >= ``percent`` * union. ``component_id`` is the smallest ``doc_id`` that
    links reach; rows without words (null and empty texts) link with nothing.

    Method: PartEnum. Sets fall into bands of sizes; for each band the domain of shingles is cut into partitions and parts,
    and a set's signatures are its elements in each subset of a partition's parts (``plan``), such that linked sets share
    one. Signatures meet in one exchange of (signature, set) rows, exact copies and hot signatures reduced to one row for
    each stretch of the input before it. Candidates are verified by their exact intersections. Shingles and sets
    stand as 64-bit hashes. Nothing is capped: any set of any signature is settled against any other; parities of a set's
    elements (a bound from below for what two sets do not share) rule out most pairs before their sets are fetched.

    Repeated rows, and rows of one id with different texts, are rows of their own. Rows without id link like others and get
    the smallest id of their component, null if it has none. Very long texts are as many shingles and signatures. An empty
    table gives no rows; of ``docs`` only ``doc_id`` and ``text`` are read."""
    rows = materialize(profiles(docs, shingle, percent), "jaccard-rows")
    roots = linked_classes(docs, rows, shingle, percent)
    each = rows.where("size > 0").groupBy("cls").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    each = _labelled(each, "cls", roots, "root")
    least = each.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("n_classes"))
    each = materialize(heavy_join(materialize(each, "jaccard-classes"), least, "root", F.col("n_classes")).select("cls", "n", "component_id"), "jaccard-labels")
    linked = heavy_join(rows.where("size > 0").select("doc_id", "cls", "size"), each, "cls", F.col("n"))
    shape = ["doc_id", F.col("size").alias("n_shingles"), "component_id"]
    return linked.select(*shape).union(rows.where("size = 0").select("doc_id", F.col("size"), F.col("doc_id")))

"""Cross-tokenizer alignment: two tokenizers' tokens cut at common byte offsets, and corpus counts of the linked pairs."""

from __future__ import annotations

import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.blocks import pack, unpack
from tagloom.llm.common import arrow, batches, id_text
from tagloom.llm.token_counts import byte_letters
from tagloom.session import materialize

BLOCK_BYTES = 8 << 20    # text of a stretch whose records are spilled together, unless one text is longer
BATCH_BYTES = 1 << 20    # text that is tokenised at a time
WINDOW = 1 << 16         # records that a step of the merge takes, about


@lru_cache(maxsize=None)
def side_a(path: str):
    """(texts -> ids of space + text, bytes of each id) of a byte-level tokenizer file; strings of its added tokens are text."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    t.encode_special_tokens = True
    letters = byte_letters()
    names = (t.id_to_token(i) or "" for i in range(t.get_vocab_size(with_added_tokens=True)))
    pieces = [bytes(letters[c] for c in x) if all(c in letters for c in x) else x.encode() for x in names]
    return lambda texts: [e.ids for e in t.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)], pieces


@lru_cache(maxsize=None)
def side_b(path: str):
    """(texts -> ids, bytes of each id) of a sentence-piece model, which adds the space itself."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(m.get_piece_size()):
        x = m.id_to_piece(i)
        pieces.append(bytes([int(x[3:-1], 16)]) if m.is_byte(i) else x.replace("▁", " ").encode())
    return lambda texts: m.encode(texts, num_threads=1), pieces


@lru_cache(maxsize=None)
def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..n-1, from the left, zero bytes behind them (one at least); and how many each has."""
    text = np.array([str(i) for i in range(n)], f"S{len(str(n)) + 1}")
    return text.view(np.uint8).reshape(n, -1), np.char.str_len(text)


class Aligned:
    """What a batch of texts comes to: per text the numbers of tokens and groups and the groups' text, and all links."""

    def __init__(self, texts: list[str | None], path_a: str, path_b: str):
        (encode_a, bytes_a), (encode_b, bytes_b) = side_a(path_a), side_b(path_b)
        at = [i for i, x in enumerate(texts) if x]
        full = [texts[i] for i in at]
        tokens = []
        for i, text, a, b in zip(at, full, encode_a(full), encode_b(full)) if at else ():
            raw = b" " + text.encode()
            if b"".join(map(bytes_a.__getitem__, a)) == raw and b"".join(map(bytes_b.__getitem__, b)) == raw:
                tokens.append((i, a, b))
        n, self.sides = len(texts), (len(bytes_a), len(bytes_b))
        self.n_a, self.n_b, self.n_groups, self.groups = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), [""] * n
        self.doc, self.a, self.b = (np.empty(0, np.int64),) * 3
        if not tokens:
            return
        at = np.array([i for i, *_ in tokens])
        len_a, len_b = (np.array([len(t[k]) for t in tokens], np.int64) for k in (1, 2))
        a, b = (np.fromiter((x for t in tokens for x in t[k]), np.int64, int(m.sum())) for k, m in ((1, len_a), (2, len_b)))
        self.n_a[at], self.n_b[at] = len_a, len_b
        # offsets run on over all texts: both sides of a text have its bytes, so its end is a common one
        end_a, end_b = (np.cumsum(_widths(path, which)[x]) for path, which, x in ((path_a, side_a, a), (path_b, side_b, b)))
        here = np.zeros(int(end_a[-1]) + 1, bool)
        here[end_a] = True
        cut_b = here[end_b]
        here[:] = False
        here[end_b[cut_b]] = True
        cut_a = here[end_a]
        last_a, last_b = np.flatnonzero(cut_a), np.flatnonzero(cut_b)
        self.a, self.b = a[last_a], b[last_b]
        text_of = np.repeat(at, len_a)
        self.doc = text_of[last_a]
        self.n_groups = np.bincount(self.doc, minlength=n)
        # the groups' text: A's tokens of a group, "|", B's, ";"
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        place_a = np.arange(len(a)) + np.r_[0, last_b + 1][group_a]
        place_b = np.arange(len(b)) + (last_a + 1)[group_b]
        ids, mark = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        mark[place_a[last_a]], mark[place_b[last_b]] = ord("|"), ord(";")
        table, size = _digits(max(self.sides))
        out, size = table[ids], size[ids]
        out[np.arange(len(ids)), size] = mark
        flat = out.reshape(-1)
        flat = flat[flat != 0].tobytes()
        ends = np.cumsum(size + 1)[np.cumsum(len_a + len_b) - 1].tolist()
        for i, s, e in zip(at.tolist(), [0, *ends], ends):
            self.groups[i] = flat[s:e - 1].decode()


@lru_cache(maxsize=None)
def _widths(path: str, side) -> np.ndarray:
    return np.array([len(x) for x in side(path)[1]], np.int64)


BLOCK = "block long, doc_ids array<long>, facts binary, sha array<string>, records binary, runs array<struct<radix:int,n:int,body:binary>>"


def spilled(docs: DataFrame, path_a: str, path_b: str, radix: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``BLOCK``: stretches of rows with their records (pair, document, how often), and their runs: the pairs and counts
    of each radix partition of B's ids, sorted by (B, A), zstd-packed. Pairs are numbered by (partition, B, A)."""
    def run(rows):
        task, seq = TaskContext.get().partitionId(), 0
        ids, facts, sha, doc, code, held = [], [], [], [], [], 0

        def spill():
            codes, at = np.unique(np.concatenate(code), return_inverse=True)
            part = (codes >> 32) % radix
            order = np.argsort(part, kind="stable")
            number = np.empty(len(codes), np.int64)
            number[order] = np.arange(len(codes))
            count = np.bincount(at, minlength=len(codes))
            key, times = np.unique(np.concatenate(doc) * max(len(codes), 1) + number[at], return_counts=True)
            where, pair = np.divmod(key, max(len(codes), 1))
            per = np.bincount(where, minlength=len(ids))
            step = np.diff(pair, prepend=0)
            first = np.flatnonzero(np.diff(where, prepend=-1))
            step[first] = pair[first]
            runs, codes, part, count = [], codes[order], part[order], count[order]
            cuts = np.r_[np.flatnonzero(np.diff(part, prepend=-1)), len(part)]
            for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                mine = codes[s:e]
                runs.append({"radix": int(part[s]), "n": e - s, "body": pack((mine >> 32).astype("<u4"), (mine & 0xFFFFFFFF).astype("<u4"), count[s:e].astype("<u4"))})
            facts_ = pack(*(np.concatenate(x).astype("<u4") for x in zip(*facts)))
            row = {"block": (task << 32) + seq, "doc_ids": ids, "facts": facts_, "sha": sha, "runs": runs,
                   "records": pack(per.astype("<u4"), step.astype("<u4"), times.astype("<u4"))}
            kind = pa.list_(pa.struct([("radix", pa.int32()), ("n", pa.int32()), ("body", pa.binary())]))
            kinds = {"block": pa.int64(), "doc_ids": pa.list_(pa.int64()), "facts": pa.binary(), "sha": pa.list_(pa.string()), "records": pa.binary(), "runs": kind}
            return pa.RecordBatch.from_arrays([pa.array([row[k]], t) for k, t in kinds.items()], names=list(kinds))

        for batch in batches(rows, BATCH_BYTES):
            texts = batch.column("text").to_pylist()
            got = Aligned(texts, path_a, path_b)
            size = sum(len(x) for x in texts if x)
            if ids and held + size > block_bytes:
                yield spill()
                seq += 1
                ids, facts, sha, doc, code, held = [], [], [], [], [], 0
            doc.append(got.doc + len(ids))
            code.append((got.b << 32) + got.a)
            facts.append((got.n_a, got.n_b, got.n_groups))
            sha += [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in got.groups]
            ids += batch.column("doc_id").to_pylist()
            held += size
        if ids:
            yield spill()

    return id_text(docs).mapInArrow(run, BLOCK)


def merge(runs: list[tuple[np.ndarray, np.ndarray]], window: int = WINDOW):
    """K-way merge of runs (codes ascending, counts): (codes, counts, best) of all pairs, one window after the other,
    ``best`` where no pair of the same B has more; and for each run where its records lie in the window. The heap holds
    each run's next B; a window takes whole Bs, from all runs that have them."""
    at, heap = [0] * len(runs), [(int(c[0]) >> 32, i) for i, (c, _) in enumerate(runs) if len(c)]
    heapq.heapify(heap)
    while heap:
        # as far as the run with the least next B has a share of the window, but that B at least
        b, i = heap[0]
        codes = runs[i][0]
        bound = max(b, (int(codes[min(at[i] + max(window // len(runs), 1), len(codes)) - 1]) >> 32) - 1)
        parts = []
        while heap and heap[0][0] <= bound:
            i = heapq.heappop(heap)[1]
            codes, start = runs[i][0], at[i]
            at[i] = start + int(np.searchsorted(codes[start:], (bound + 1) << 32))
            parts.append((i, start, at[i]))
            if at[i] < len(codes):
                heapq.heappush(heap, (int(codes[at[i]]) >> 32, i))
        codes, back = np.unique(np.concatenate([runs[i][0][s:e] for i, s, e in parts]), return_inverse=True)
        counts = np.zeros(len(codes), np.int64)
        np.add.at(counts, back, np.concatenate([runs[i][1][s:e] for i, s, e in parts]).astype(np.int64))
        first = np.flatnonzero(np.diff(codes >> 32, prepend=-1))
        most = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.r_[first, len(codes)]))
        ends = np.cumsum([e - s for _, s, e in parts])
        yield codes, counts, counts == most, [(i, s, e, back[z - (e - s):z]) for (i, s, e), z in zip(parts, ends.tolist())]


def _runs(bodies: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for x in bodies:
        b, a, n = unpack(x, "<u4", "<u4", "<u4")
        out.append(((b.astype(np.int64) << 32) + a, n))
    return out


def contributions(runs: DataFrame) -> DataFrame:
    """``radix, block, body`` (runs) to ``block, radix, body``: for each record of a run, in its order, its pair's count and
    whether it is its B's highest."""
    def run(key, t):
        found = _runs(t.column("body").to_pylist())
        counts, best = [np.zeros(len(c), "<i8") for c, _ in found], [np.zeros(len(c), "u1") for c, _ in found]
        for _, n, top, parts in merge(found):
            for i, s, e, back in parts:
                counts[i][s:e], best[i][s:e] = n[back], top[back]
        return pa.table([t.column("block"), t.column("radix"), pa.array([pack(n, x) for n, x in zip(counts, best)], pa.binary())],
                        names=["block", "radix", "body"])

    return runs.groupBy("radix").applyInArrow(run, "block long, radix int, body binary")


def pair_counts(docs: DataFrame, path_a: str, path_b: str, radix: int = 64) -> DataFrame:
    """``a, b, n, best``: every linked pair of ids, how many links hold it, and whether no pair of the same b has more."""
    def run(key, t):
        found = [w[:3] for w in merge(_runs(t.column("body").to_pylist()))]
        codes, n, best = (np.concatenate(x) for x in zip(*found))
        return pa.table([pa.array(codes & 0xFFFFFFFF), pa.array(codes >> 32), pa.array(n), pa.array(best)], names=["a", "b", "n", "best"])

    return spilled(docs, path_a, path_b, radix).select(F.explode("runs").alias("r")).select("r.*") \
        .groupBy("radix").applyInArrow(run, "a long, b long, n long, best boolean")


RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align(docs: DataFrame, path_a: str, path_b: str, radix: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``RESULT``, one row per row of ``docs``.

    A encodes space + text, B the text (its model adds the space), both without special tokens. Offsets where tokens of
    both sides end cut them into groups; a link is an A and a B token that end together, the last ones of a group. A pair's
    count is how many links of the corpus hold it; ``n_best`` are the links whose count is their B's highest, ties included.

    Flow: stretches of ``block_bytes`` of text spill their (pair, document) records, and one sorted run of (B, A, count) for
    each radix partition of B's ids, so a pair that every document has is one record of a stretch. A partition's runs meet
    in one task and are merged by a heap, B after B; counts and maxima go back to the runs as they come up, and from there
    into the documents' sums. Runs have no more records than the two vocabularies have pairs; there are 64 partitions, more
    (up to 2,048) for more than 1,024 stretches, so that what meets in one stays bounded; for inputs beyond some TB give larger
    stretches.

    Null and empty texts, and texts that a side does not give back byte by byte, have no tokens: zeros and ''. Texts of any
    length are taken whole. Repeated rows count, and come out, each for itself; null ids stay null. An empty table gives no
    rows. Of ``docs`` only ``doc_id`` and ``text`` are read."""
    if radix is None:
        stretches = (docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0) // block_bytes
        radix = min(2048, max(64, 1 << (stretches // 16).bit_length()))
    blocks = materialize(spilled(docs, path_a, path_b, radix, block_bytes), "alignment-blocks", "zstd")
    answers = contributions(blocks.select("block", F.explode("runs").alias("r")).select("block", "r.radix", "r.body"))
    shape = arrow(RESULT)

    def finish(key, left, right):
        row = left.to_pylist()[0]
        found = sorted(zip(right.column("radix").to_pylist(), right.column("body").to_pylist()))
        parts = [unpack(x, "<i8", "u1") for _, x in found]
        count, best = (np.concatenate(x).astype(np.int64) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 2
        per, step, times = (x.astype(np.int64) for x in unpack(row["records"], "<u4", "<u4", "<u4"))
        ends = np.cumsum(per)
        run_on = np.cumsum(step)
        pair = run_on - np.repeat(np.r_[0, run_on][ends - per], per)
        total, top = (np.r_[0, np.cumsum(x)] for x in (count[pair] * times, best[pair] * times))
        n_a, n_b, groups = unpack(row["facts"], "<u4", "<u4", "<u4")
        cols = [row["doc_ids"], n_a, n_b, groups, groups, top[ends] - top[ends - per], total[ends] - total[ends - per], row["sha"]]
        return pa.table([pa.array(c if isinstance(c, list) else c.astype(np.int64), f.type) for c, f in zip(cols, shape)], schema=shape)

    return blocks.drop("runs").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, RESULT)

"""Bigram language model: trained on and applied to the whole corpus in one flow of DataFrames."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.blocks import bundles, give_back, pack, pack_strings, split, unpack, unpack_strings, write_blocks
from tagloom.llm.common import arrow, batches, id_text
from tagloom.llm.elias_fano import BigramTrie, dequantise, quantise
from tagloom.session import materialize

DELTA = 0.1        # added to every word's count
STRENGTH = 50.0    # words without context are worth so many observations after each context
BLOCK_BYTES = 4 << 20  # text of a block: its pairs and their documents are sorted in memory
SPLIT = 1 << 20    # a context with more training tokens is dealt to several tasks, by the word after it
END, BEGIN, UNKNOWN = b"", -1, -2  # no word is empty


def held_out(doc_id) -> bool:
    """crc32 of the id as text is divisible by 10; a null id counts as empty text and is held out."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


BLOCK = "block long, doc_ids array<long>, lens array<int>, at binary, names binary, counts binary, train_docs long"


def word_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of neighbouring rows: distinct tokens, the most frequent first, the number of the token at every place,
    and how often each occurs in the block's training rows. A text's tokens are its words (A-Z lower-cased) and the end."""
    def run(rows):
        task, seq = TaskContext.get().partitionId(), 0
        ids, lens, at, seen, held = [], [], [], {}, 0

        def block():
            train = np.array([not held_out(i) for i in ids])
            places = np.concatenate(at)
            order = np.argsort(-np.bincount(places, minlength=len(seen)), kind="stable")
            new = np.empty(len(order), "<u4")
            new[order] = np.arange(len(order), dtype="<u4")
            places, names = new[places], list(seen)
            counts = np.bincount(places[np.repeat(train, lens)], minlength=len(order))
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + seq], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([lens], pa.list_(pa.int32())),
                 pa.array([pack(places)], pa.binary()), pa.array([pack_strings([names[i] for i in order])], pa.binary()),
                 pa.array([pack(counts.astype("<u4"))], pa.binary()), pa.array([int(train.sum())], pa.int64())],
                names=[c.split()[0] for c in BLOCK.split(", ")])

        for batch in batches(rows):
            for doc, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
                words = (text or "").encode().lower().split() + [END]
                if ids and held + len(text or "") > block_bytes:
                    yield block()
                    seq += 1
                    ids, lens, at, seen, held = [], [], [], {}, 0
                    give_back()
                for w in set(words).difference(seen):
                    seen[w] = len(seen)
                ids.append(doc)
                lens.append(len(words))
                at.append(np.fromiter(map(seen.__getitem__, words), "<u4", len(words)))
                held += len(text or "")
        if ids:
            yield block()
        ids, lens, at, seen = [], [], [], {}
        give_back()

    return id_text(docs).mapInArrow(run, BLOCK)


def word_totals(words: DataFrame) -> DataFrame:
    """Bundles of words and counts to ``block, bucket, totals`` (each word's number and corpus-wide training count),
    ``kinds, tokens`` (of the whole bucket, in one of its rows). A word's number is its bucket's and its place in it."""
    def run(key, t):
        bucket = key[0].as_py()
        parts = [unpack_strings(x) for x in t.column("names").to_pylist()]
        number = {x: i for i, x in enumerate(dict.fromkeys(x for p in parts for x in p))}
        at = [np.fromiter(map(number.__getitem__, p), np.int64, len(p)) for p in parts]
        n = np.concatenate([unpack(x, "<u4")[0] for x in t.column("counts").to_pylist()])
        total = np.bincount(np.concatenate(at), n, len(number)).astype("<i8")
        blobs = [pack(x.astype("<u4"), total[x]) for x in at]
        give_back()
        one = [0] * (len(parts) - 1)
        return pa.table([t.column("block"), pa.array([bucket] * len(parts), pa.int32()), pa.array(blobs, pa.binary()),
                         pa.array([int((total > 0).sum()), *one], pa.int64()), pa.array([int(total.sum()), *one], pa.int64())],
                        names=["block", "bucket", "totals", "kinds", "tokens"])

    return words.groupBy("bucket").applyInArrow(run, "block long, bucket int, totals binary, kinds long, tokens long")


PART = "bucket int, block long, body binary"


def _spread(x: np.ndarray) -> np.ndarray:
    """A number below 2^31 for each of ``x``, in which every bit counts: words of different buckets have the same places,
    the most frequent ones the first."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(33)).astype(np.int64)


def _entries(n_tokens: int, n_words: int, train_docs: int, buckets: int, owners: int, hot: int):
    """Blocks and their words' totals to bundles: a block's pairs (context, word) with how often its training rows
    have them and which documents do, for each owner of contexts; and, under owner -1 - ..., the documents' own facts."""
    norm = n_tokens + DELTA * (n_words + 1)

    def run(key, left, right):
        got = dict(zip(right.column("bucket").to_pylist(), right.column("totals").to_pylist()))
        out = [], [], []
        for row in left.to_pylist():
            names = unpack_strings(row["names"])
            gid, c = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
            for bucket, numbers in split(names, buckets):
                place, total = unpack(got[bucket], "<u4", "<i8")
                gid[numbers], c[numbers] = place.astype(np.int64) + ((bucket + 1) << 32), total
            gid[c == 0] = UNKNOWN
            log_p = np.log10((c + DELTA) / norm)
            code = quantise(log_p)
            at, lens = unpack(row["at"], "<u4")[0].astype(np.int64), np.array(row["lens"], np.int64)
            doc = np.repeat(np.arange(len(lens)), lens)
            train = np.array([not held_out(i) for i in row["doc_ids"]])
            # contexts: the token before plus 1, or 0 at the beginning of a text
            ctx = np.r_[0, at[:-1] + 1]
            ctx[np.cumsum(lens) - lens] = 0
            ctx_id, ctx_n = np.r_[BEGIN, gid], np.r_[train_docs, c]
            own = ctx_n[ctx] == 0  # after what training never saw only the word itself counts
            facts = pack(np.array([-1 if i is None else i for i in row["doc_ids"]], "<i8"), np.array([i is None for i in row["doc_ids"]], "u1"),
                         lens.astype("<i8"), np.bincount(doc, c[at] > 0, len(lens)).astype("<i8"),
                         np.bincount(doc, log_p[at], len(lens)).view("<i8"),
                         np.bincount(doc[own], dequantise(code)[at[own]], len(lens)).view("<i8"))
            out[0].append(-1 - row["block"] % owners)
            out[1].append(row["block"])
            out[2].append(facts)
            seen = ~own
            if not seen.any():
                continue
            key_ = (ctx[seen] * len(names) + at[seen]) * len(lens) + doc[seen]
            del ctx, at, doc, own, seen
            key_.sort()
            first = np.flatnonzero(np.r_[True, key_[1:] != key_[:-1]])
            tf = np.diff(np.r_[first, len(key_)]).astype(np.int32)
            pair, doc = np.divmod(key_[first], len(lens))
            del key_, first
            doc = doc.astype(np.int32)
            new = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
            posts = np.diff(np.r_[new, len(pair)])
            n = np.add.reduceat(tf * train[doc], new)
            ctx, word = np.divmod(pair[new], len(names))
            del pair
            # a context that is hot in the whole corpus has several owners, by the word that follows
            sub = _spread(gid[word]) % (1 + ctx_n[ctx] // hot)
            owner = _spread(ctx_id[ctx] + 977 * sub) % owners
            order = np.lexsort((gid[word], ctx, owner))
            starts = np.cumsum(posts) - posts
            owner, ctx, word, n, posts, starts = (x[order] for x in (owner, ctx, word, n, posts, starts))
            ends = np.cumsum(posts)
            take = np.repeat(starts - (ends - posts), posts)
            take += np.arange(len(doc))
            doc, tf, ends = doc[take], tf[take], np.r_[0, ends]
            del take, starts, order
            used, cuts = np.unique(owner, return_index=True)
            for o, s, e in zip(used.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(owner)]):
                first = np.flatnonzero(np.r_[True, ctx[s + 1:e] != ctx[s:e - 1]]) + s
                p, q = ends[s], ends[e]
                out[0].append(o)
                out[1].append(row["block"])
                out[2].append(pack(ctx_id[ctx[first]], ctx_n[ctx[first]], np.diff(np.r_[first, e]).astype("<u4"), gid[word[s:e]],
                                   code[word[s:e]], n[s:e].astype("<u4"), posts[s:e].astype("<u4"), doc[p:q].astype("<u4"), tf[p:q].astype("<u4")))
        table = pa.table([pa.array(x, k) for x, k in zip(out, (pa.int32(), pa.int64(), pa.binary()))], names=["bucket", "block", "body"])
        del out
        give_back()
        return table

    return run


def _score(key, t):
    """All bundles of one owner: the pairs' counts are added up, a trie is built of them, and every pair of the bundles
    looked up in it; each block gets the sums for its documents."""
    if key[0].as_py() < 0:
        return t.append_column("own", pa.array([True] * t.num_rows)).select(["block", "own", "body"])
    blocks = t.column("block").to_pylist()
    parts = [unpack(x, "<i8", "<i8", "<u4", "<i8", "<u2", "<u4", "<u4", "<u4", "<u4") for x in t.column("body").to_pylist()]
    entries = [len(p[3]) for p in parts]
    ctx, total, per, word, code, n, posts, doc, tf = (np.concatenate(x) for x in zip(*parts))
    names, first, context = np.unique(ctx, return_index=True, return_inverse=True)
    total, where = total[first].astype(np.float64), np.repeat(context, per)
    words, word = np.unique(word, return_inverse=True)
    lower, wide = dequantise(code), len(words)
    pair, first, back = np.unique(where * wide + word, return_index=True, return_inverse=True)
    counts = np.bincount(back, n, len(pair))
    known = counts > 0
    c, w = (pair // wide)[known], (pair % wide)[known]
    log_p = np.log10((counts[known] + STRENGTH * 10 ** lower[first][known]) / (total[c] + STRENGTH))
    trie = BigramTrie(c, w, log_p, np.log10(STRENGTH / (total + STRENGTH)), wide)
    value = trie.score(pair // wide, pair % wide, lower[first])[back]
    value, ends = np.repeat(value, posts) * tf, np.r_[0, np.cumsum(posts, dtype=np.int64)]
    bodies, at = [], 0
    for k in entries:
        s, e = ends[at], ends[at + k]
        docs, back = np.unique(doc[s:e], return_inverse=True)
        bodies.append(pack(docs, np.bincount(back, value[s:e], len(docs)).view("<i8")))
        at += k
    del ctx, total, per, word, code, n, posts, doc, tf, value, back, parts, trie
    give_back()
    return pa.table([pa.array(blocks, pa.int64()), pa.array([False] * len(blocks)), pa.array(bodies, pa.binary())], names=["block", "own", "body"])


def score(docs: DataFrame, hot: int = SPLIT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Learns from the rows that are not held out, all of them. With N training tokens of V kinds and c(w) of word w,
    p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)) (a word never seen has c = 0), and
    p(w | v) = (c(v w) + S p(w)) / (c(v) + S), S = ``STRENGTH``, v the token before or the text's beginning: it adds up
    to 1 over the V words and one unknown, and c(v) is known before the pairs are counted, so that a hot v can be
    dealt to many tasks by w. ``score`` is the sum of log10 p(w | v), with log10 of p and of back-off weights in 16-bit
    steps of 0.00024; ``base_score`` the exact sum of log10 p(w).

    Flow: blocks of rows with their distinct words (written once, bucketed); the words in bundles to their buckets,
    where the counts are added up, and back; from there the blocks' pairs, in bundles, to the owners of the contexts, 8 for each
    block, 512 from 64 blocks to 4,096 (bundles of some 10 KB), one for 8 blocks beyond. An owner adds the counts up, builds a trie, looks all
    pairs up and answers with sums for each block's documents. Null texts
    are empty (one token, the end). Repeated rows are separate rows, and count each. An empty table gives none."""
    blocks, n_blocks = write_blocks(word_blocks(docs), "lm_blocks")
    # a share of an owner does not grow up to 64 blocks; from there on bundles do not shrink, until shares reach 32 MB
    buckets, owners = (max(16, min(k * n_blocks, max(512, n_blocks // 8))) for k in (4, 8))
    totals = materialize(word_totals(bundles(blocks, buckets)), "lm-totals")
    n_words, n_tokens = totals.agg(F.coalesce(F.sum("kinds"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    train_docs = blocks.agg(F.coalesce(F.sum("train_docs"), F.lit(0))).first()[0]
    entries = blocks.select("block", "doc_ids", "lens", "at", "names").groupBy("block") \
        .cogroup(totals.select("block", "bucket", "totals").groupBy("block")) \
        .applyInArrow(_entries(n_tokens, n_words, train_docs, buckets, owners, hot), PART)
    partial = entries.groupBy("bucket").applyInArrow(_score, "block long, own boolean, body binary")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def finish(key, t):
        own, bodies = t.column("own").to_pylist(), t.column("body").to_pylist()
        ids, null, n, known, base, total = unpack(bodies[own.index(True)], "<i8", "u1", "<i8", "<i8", "<f8", "<f8")
        total = total.copy()
        for mine, body in zip(own, bodies):
            if not mine:
                docs, value = unpack(body, "<u4", "<f8")
                total[docs] += value
        names = [None if z else i for i, z in zip(ids.tolist(), null.tolist())]
        shape = arrow(schema)
        cols = [names, [held_out(i) for i in names], n, known, np.full(len(n), n_tokens), base, total]
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, shape)], schema=shape)

    return partial.groupBy("block").applyInArrow(finish, schema)

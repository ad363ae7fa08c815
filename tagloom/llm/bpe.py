"""BPE encoding through a table of distinct pieces, and decoding through the id-to-piece table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.blocks import bundles, pack, pack_strings, split, unpack, unpack_strings, write_blocks
from tagloom.llm.bpe_tables import BYTE_SPLIT, pieces_of, splitter, tokenizer
from tagloom.llm.common import batches, id_text
from tagloom.llm.token_counts import byte_letters

BLOCK_BYTES = 8 << 20  # ids and text of a block are held together, so blocks are smaller here
BLOCK = "block long, doc_ids array<long>, lens array<int>, at binary, names binary"


def split_blocks(docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Texts split into pieces, in blocks of neighbouring rows. A block has its distinct pieces, the most frequent
    first, and for every place of its texts the number of the piece there (``at``)."""
    found = tokenizer(path)[2]

    def run(rows):
        cut, task, seq = splitter(BYTE_SPLIT), TaskContext.get().partitionId(), 0
        ids, lens, at, seen, held = [], [], [], {}, 0

        def block():
            places = np.concatenate(at)
            order = np.argsort(-np.bincount(places, minlength=len(seen)), kind="stable")
            new = np.empty(len(order), "<u4")
            new[order] = np.arange(len(order), dtype="<u4")
            names = [x.encode() for x in seen]
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + seq], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([lens], pa.list_(pa.int32())),
                 pa.array([pack(new[places])], pa.binary()), pa.array([pack_strings([names[i] for i in order])], pa.binary())],
                names=["block", "doc_ids", "lens", "at", "names"])

        for batch in batches(rows):
            for doc, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
                text = text or ""
                if ids and held + len(text) > block_bytes:
                    yield block()
                    seq += 1
                    ids, lens, at, seen, held = [], [], [], {}, 0
                pieces = pieces_of(text, cut, found)
                for p in set(pieces).difference(seen):
                    seen[p] = len(seen)
                ids.append(doc)
                lens.append(len(pieces))
                at.append(np.fromiter(map(seen.__getitem__, pieces), "<u4", len(pieces)))
                held += len(text)
        if ids:
            yield block()

    return id_text(docs).mapInArrow(run, BLOCK)


def encode_distinct(pieces: DataFrame, path: str) -> DataFrame:
    """Bundles of pieces to ``block, bucket, codes``: equal pieces have one bucket and are encoded once there."""
    def run(key, t):
        bucket, tk = key[0].as_py(), tokenizer(path)[0]
        parts = [unpack_strings(x) for x in t.column("names").to_pylist()]
        names = sorted({x for p in parts for x in p})
        coded = tk.encode_batch_fast([x.decode() for x in names], add_special_tokens=False)
        table = {x: np.array(e.ids, "<u4") for x, e in zip(names, coded)}
        blobs = []
        for p in parts:
            codes = [table[x] for x in p]
            blobs.append(pack(np.array([len(x) for x in codes], "<u4"), np.concatenate(codes)))
        return pa.table([t.column("block"), pa.array([bucket] * len(parts), pa.int32()), pa.array(blobs, pa.binary())],
                        names=["block", "bucket", "codes"])

    return pieces.groupBy("bucket").applyInArrow(run, "block long, bucket int, codes binary")


def encode(docs: DataFrame, path: str, decoded: bool = False, buckets_per_block: int = 4) -> DataFrame:
    """``doc_id, ids``: little-endian uint32 ids of each text, one row per row of ``docs``; null texts are empty. With
    ``decoded``, ``text`` too: the ids decoded again, in the same worker, which saves a second one beside it.

    Spark splits the texts into blocks (written once, bucketed); a block names a distinct piece once, and its pieces
    travel in bundles, one for each bucket of pieces. Equal pieces meet and are encoded once; the ids go back to the
    block by position in the bundle, where the places turn into ids. No piece is hot: a block has it once."""
    blocks, n = write_blocks(split_blocks(docs, path), "bpe_blocks")
    buckets = max(16, min(buckets_per_block * n, max(512, n // 8)))  # bundles stay worth their headers on large inputs
    coded = encode_distinct(bundles(blocks, buckets), path)
    names_of_ids = id_pieces(path) if decoded else None

    def join(key, left, right):
        got = dict(zip(right.column("bucket").to_pylist(), right.column("codes").to_pylist()))
        ids, out = [], []
        for row in left.to_pylist():
            names = unpack_strings(row["names"])
            first, size, parts, held = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64), [], 0
            for bucket, numbers in split(names, buckets):
                lens, codes = unpack(got[bucket], "<u4", "<u4")
                size[numbers] = lens
                first[numbers] = held + np.cumsum(lens, dtype=np.int64) - lens
                parts.append(codes)
                held += len(codes)
            data = np.concatenate(parts) if parts else np.empty(0, "<u4")
            at, start = unpack(row["at"], "<u4")[0], 0
            for doc, n in zip(row["doc_ids"], row["lens"]):
                here = at[start:start + n]
                length = size[here]
                ends = np.cumsum(length)
                take = np.repeat(first[here] - (ends - length), length) + np.arange(int(ends[-1]) if n else 0)
                ids.append(doc)
                out.append(data[take].tobytes())
                start += n
            del at, data
        cols = {"doc_id": pa.array(ids, pa.int64()), "ids": pa.array(out, pa.binary())}
        if decoded:
            read = decoder(names_of_ids)
            cols["text"] = pa.array([read(np.frombuffer(x, "<u4")) for x in out], pa.string())
        return pa.table(cols)

    return blocks.groupBy("block").cogroup(coded.groupBy("block")) \
        .applyInArrow(join, "doc_id long, ids binary" + ", text string" * decoded)


def id_pieces(path: str) -> list[bytes]:
    """The bytes of every id: the id-to-piece table, as long as the vocabulary."""
    t, added, _ = tokenizer(path)
    letters, out = byte_letters(), []
    for i in range(t.get_vocab_size(with_added_tokens=True)):
        x = t.id_to_token(i) or ""
        plain = all(c in letters for c in x) and x not in added
        out.append(bytes(letters[c] for c in x) if plain else x.encode())
    return out


def decoder(names: list[bytes]):
    """``ids -> text`` over the id-to-piece table: each id joined to its piece by position; what is no UTF-8 becomes
    U+FFFD."""
    size = np.array([len(x) for x in names], np.int64)
    first, data = np.cumsum(size) - size, np.frombuffer(b"".join(names), np.uint8)

    def read(ids: np.ndarray) -> str:
        length = size[ids]
        ends = np.cumsum(length)
        take = np.repeat(first[ids] - (ends - length), length) + np.arange(int(ends[-1]) if len(ids) else 0)
        return data[take].tobytes().decode("utf-8", "replace")

    return read


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` to ``doc_id, ids, text``. The id-to-piece table is as long as the vocabulary; tasks hold it."""
    names = id_pieces(path)

    def run(rows):
        read = decoder(names)
        for batch in rows:
            texts = [read(np.frombuffer(x.as_buffer(), "<u4")) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())],
                                             names=["doc_id", "ids", "text"])

    return encoded.mapInArrow(run, "doc_id long, ids binary, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the encoded and decoded texts."""
    return encode(docs, path, decoded=True).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))

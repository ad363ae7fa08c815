"""Token-id files: frequency-ranked ids, four to a control byte, one to four data bytes each, in ascending doc_id order."""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.bpe_tables import BYTE_SPLIT, tokenizer
from tagloom.llm.common import arrow, batches, id_text
from tagloom.llm.token_counts import byte_letters
from tagloom.session import scratch_path

#: Bytes of the four values of a control byte, by control byte; and which of four bytes a length keeps.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8)
KEEP = np.arange(4) <= np.arange(4)[:, None]


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of uint32 values: two bits for each value's length - 1, then its low bytes."""
    values = np.ascontiguousarray(values, "<u4")
    more = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    data = values.view(np.uint8).reshape(-1, 4)[KEEP[more]]
    four = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    four[:len(values)] = more
    control = (four.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of ``pack``: lengths by table lookup from the control bytes, then one masked copy."""
    more = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    out = np.zeros((n, 4), np.uint8)
    out[KEEP[more]] = np.frombuffer(data, np.uint8)
    return out.reshape(-1).view("<u4")


@lru_cache(maxsize=None)
def encoder(path: str):
    """``text -> uint32 ids``, as the tokenizer file's own library gives them. Where the file is byte-level BPE whose ids
    follow its merges (checked here, merge by merge) the ids are the ranks of a faster encoder."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    t, added, found = tokenizer(path)
    letters, vocab = byte_letters(), {k: v for k, v in model["vocab"].items() if k not in added}
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    if t.normalizer is None and all(vocab[m] == 256 + i for i, m in enumerate(merges)):
        ranks = {bytes(letters[c] for c in k): v for k, v in vocab.items()}
        fast = tiktoken.Encoding(path, pat_str=BYTE_SPLIT, mergeable_ranks=ranks, special_tokens={})
        plain = lambda x: np.asarray(fast.encode_to_numpy(x, disallowed_special=()), "<u4")
    else:
        plain = lambda x: np.array(t.encode(x, add_special_tokens=False).ids, "<u4")

    def run(text: str) -> np.ndarray:
        if not found or not found.search(text):
            return plain(text)
        return np.concatenate([np.array([added[x]], "<u4") if i % 2 else plain(x) for i, x in enumerate(found.split(text))])

    return run


ENCODED = "part int, before long, doc_id long, ids binary"


def id_type(vocabulary: int) -> str:
    """Type of the ids below ``vocabulary`` in the table between the two passes."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def encode(docs: DataFrame, path: str, end_id: int, kind: str = "<u4") -> DataFrame:
    """``part, before, doc_id, ids``: ids (as ``kind``) of each text with ``end_id`` after them, in ascending
    ``doc_id`` order within and across parts; ``before`` counts the ids ahead in the part. Null texts are empty."""
    def run(rows):
        part, before, get = TaskContext.get().partitionId(), 0, encoder(path)
        for batch in batches(rows):
            ids, end = [get(x or "") for x in batch.column("text").to_pylist()], np.array([end_id], kind).tobytes()
            n = np.array([len(x) + 1 for x in ids], np.int64)
            ahead = before + np.cumsum(n) - n
            before += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part, np.int32)), pa.array(ahead), batch.column("doc_id"),
                 pa.array([x.astype(kind).tobytes() + end for x in ids], pa.binary())], names=["part", "before", "doc_id", "ids"])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return id_text(docs).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id").mapInArrow(run, ENCODED)


def frequency_order(encoded: DataFrame, vocabulary: int, kind: str = "<u4") -> np.ndarray:
    """All ids below ``vocabulary``, the most frequent in ``encoded`` first, ties by id. Counts cover all rows; the
    driver gets one row for each id at most, which the vocabulary bounds."""
    def count(rows):
        total = np.zeros(vocabulary, np.int64)
        for batch in rows:
            ids = batch.column("ids")
            step = max(1, (1 << 24) // max(ids.nbytes // max(len(ids), 1), 1))
            for i in range(0, len(ids), step):
                raw = b"".join(x.as_buffer() for x in ids.slice(i, step))
                total += np.bincount(np.frombuffer(raw, kind), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["id", "n"])

    seen = encoded.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(vocabulary, np.int64)
    for r in seen:
        counts[r.id] = r.n
    return np.lexsort((np.arange(vocabulary), -counts)).astype("<u4")


SEGMENT = "part int, before long, doc_ids array<long>, lens array<int>, n_tokens long, control binary, data binary"


def write_tokens(docs: DataFrame, path: str, out: str, end_id: int = 2, segment_tokens: int = 1 << 20) -> None:
    """Encode ``docs`` and write ``out``/segments and ``out``/order.

    ``segments`` holds the files: each row is a segment of whole documents in ascending doc_id order (null ids first)
    with its control bytes and, apart from them, its data bytes; ``part`` and ``before``, the part's ids ahead of the
    segment, order the segments. ``order`` holds the ids by frequency rank. Spark writes both, so any store that it
    reaches will do, and a lost task is written again. Repeated rows are written once each; an empty table gives empty
    files. The texts are dealt by ranges of ``doc_id`` first and encoded once, in order; ranks follow from all ids."""
    spark = docs.sparkSession
    vocabulary = max(tokenizer(path)[0].get_vocab_size(with_added_tokens=True), end_id + 1)
    kind = id_type(vocabulary)
    encode(docs, path, end_id, kind).write.option("compression", "zstd").parquet(f"{out}/encoded")
    encoded = spark.read.schema(ENCODED).parquet(f"{out}/encoded")
    order = frequency_order(encoded, vocabulary, kind)
    rank = np.empty(vocabulary, "<u4")
    rank[order] = np.arange(vocabulary, dtype="<u4")
    spark.createDataFrame([(order.tobytes(),)], "ids binary").write.parquet(f"{out}/order")

    def segments(rows):
        for batch in rows:  # rows of a batch follow each other in one part
            ids = batch.column("ids")
            n = (pc.binary_length(ids).to_numpy() // np.dtype(kind).itemsize).astype(np.int64)
            part = batch.column("part").to_numpy()
            start = 0
            while start < batch.num_rows:
                end, held = start, 0
                while end < batch.num_rows and part[end] == part[start] and (end == start or held + n[end] <= segment_tokens):
                    held += int(n[end])
                    end += 1
                raw = b"".join(x.as_buffer() for x in ids.slice(start, end - start))
                control, data = pack(rank[np.frombuffer(raw, kind)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(part[start])], pa.int32()), batch.column("before").slice(start, 1),
                     pa.array([batch.column("doc_id").slice(start, end - start).to_pylist()], pa.list_(pa.int64())),
                     pa.array([n[start:end].astype(np.int32)], pa.list_(pa.int32())), pa.array([held], pa.int64()),
                     pa.array([control], pa.binary()), pa.array([data], pa.binary())], names=[c.split()[0] for c in SEGMENT.split(", ")])
                start = end

    encoded.mapInArrow(segments, SEGMENT).write.option("compression", "none").parquet(f"{out}/segments")


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """From files of ``write_tokens``: ``doc_id, start, n_tokens, ids_crc32`` and, with ``ids``, ``ids`` (uint32 bytes).
    The driver adds up one number for each part, of which there are as many as shuffle partitions."""
    segments = spark.read.parquet(f"{path}/segments")
    order = np.frombuffer(spark.read.parquet(f"{path}/order").first()[0], "<u4")
    sums = {r.part: r.n for r in segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    base, at = {}, 0
    for p in sorted(sums):
        base[p] = at
        at += sums[p]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids

    def run(rows):
        for batch in rows:
            for s in batch.to_pylist():
                lens = np.array(s["lens"], np.int64)
                ends = np.cumsum(lens)
                raw = memoryview(order[unpack(s["control"], s["data"], s["n_tokens"])].astype("<u4").tobytes())
                each = [raw[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), lens.tolist())]
                cols = [s["doc_ids"], ends - lens + base[s["part"]] + s["before"], lens, [zlib.crc32(x) for x in each]]
                shape = arrow(schema)
                cols += [[bytes(x) for x in each]] * ids
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, shape.types)], schema=shape)

    return segments.mapInArrow(run, schema)


def token_files(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` as token files below spark.checkpoint.dir and read them back; without the ids themselves."""
    out = scratch_path(docs.sparkSession, "token-files")
    write_tokens(docs, path, out, end_id)
    return read_tokens(docs.sparkSession, out, ids=False)

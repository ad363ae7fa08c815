"""Blocks of documents with their distinct words, and the way from blocks to the words' owners and back.

Texts stay in their block as numbers of the block's words. What travels is one bundle for each block and bucket: the
block's words that belong to the bucket, packed. All bundles of a bucket meet, the words are answered, and a bundle of
answers in the same order goes back. Buckets grow in number with the blocks, so what meets in one is bounded.
"""

from __future__ import annotations

import ctypes
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import scratch_path

BLOCK_BYTES = 16 << 20  # text of a block, unless one document alone is longer


def give_back() -> None:
    """Return freed memory to the system: a worker's next block or group starts small, and beside the JVM it counts."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # no such call on this system
        pass


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays as compressed byte planes: small numbers leave the upper planes empty."""
    out = [np.array([len(arrays), *(x for a in arrays for x in (len(a), a.itemsize))], "<i8").tobytes()]
    out += [np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T).tobytes() for a in arrays]
    return zstandard.compress(b"".join(out), 3)


def unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    sizes = np.frombuffer(raw, "<i8", 2 * n, 8).reshape(-1, 2).tolist()
    at, out = 8 + 16 * n, []
    for (length, width), kind in zip(sizes, kinds):
        planes = np.frombuffer(raw, np.uint8, length * width, at).reshape(width, -1)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += length * width
    return out


def pack_strings(strings: list[bytes]) -> bytes:
    return pack(np.array([len(x) for x in strings], "<u4"), np.frombuffer(b"".join(strings), np.uint8))


def unpack_strings(blob: bytes) -> list[bytes]:
    lens, data = unpack(blob, "<u4", "u1")
    raw, ends = data.tobytes(), np.cumsum(lens, dtype=np.int64).tolist()
    return [raw[s:e] for s, e in zip([0, *ends], ends)]


def write_blocks(blocks: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``blocks`` (key ``block``) written below spark.checkpoint.dir as a table bucketed by ``block``: what comes back
    to the blocks later is shuffled to them, the blocks themselves stay where they are. And their number."""
    spark = blocks.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    called = f"{name}_{uuid.uuid4().hex[:12]}"
    blocks.write.option("path", scratch_path(spark, name)).option("compression", "zstd").bucketBy(parts, "block").saveAsTable(called)
    out = spark.table(called)
    return out, out.count()


def split(names: list[bytes], buckets: int) -> list[tuple[int, np.ndarray]]:
    """(bucket, numbers of the names that belong to it), the same wherever a name stands."""
    own = np.fromiter((zlib.crc32(x) for x in names), np.int64, len(names)) % buckets
    order = np.argsort(own, kind="stable")
    used, starts = np.unique(own[order], return_index=True)
    return list(zip(used.tolist(), np.split(order, starts[1:]))) if len(names) else []


BUNDLE = "bucket int, block long, names binary, counts binary"


def bundles(blocks: DataFrame, buckets: int) -> DataFrame:
    """``block, names`` (packed strings), ``counts`` (packed, or null) to bundles."""
    def run(rows):
        for batch in rows:
            for row in batch.to_pylist():
                names, counts = unpack_strings(row["names"]), None
                if row["counts"] is not None:
                    counts, = unpack(row["counts"], "<u4")
                parts = split(names, buckets)
                cols = ([b for b, _ in parts], [row["block"]] * len(parts), [pack_strings([names[i] for i in at]) for _, at in parts],
                        [None if counts is None else pack(counts[at]) for _, at in parts])
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["bucket", "block", "names", "counts"])

    return blocks.select("block", "names", "counts" if "counts" in blocks.columns else F.lit(None).cast("binary").alias("counts")) \
        .mapInArrow(run, BUNDLE)

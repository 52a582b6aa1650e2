"""Which 64-bit keys occur more than once in the corpus, answered per chunk.

Every chunk sends its distinct keys, cut by value into buckets, as one binary row per bucket; a bucket adds up the counts and answers each
chunk with one count class per key, in the chunk's key order. Keys are added up inside the chunk first, so a key that a third of all
documents hold arrives once per chunk. Bucket numbers grow with the corpus, so a bucket stays at a bounded size.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_BYTES = 4 << 20
CLASSES = 15


def bucket_count(chunks: DataFrame) -> int:
    """At least as many buckets as shuffle partitions; more for a large corpus."""
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(2 * int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_BYTES, 1)


def cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of sorted 64-bit keys begins and the last one ends."""
    limits = (np.arange(buckets + 1, dtype=object) * (1 << 64)) // buckets
    limits[-1] = (1 << 64) - 1
    out = np.searchsorted(keys, np.array(limits, np.uint64))
    out[-1] = len(keys)
    return out


def planes(keys: np.ndarray, width: int) -> bytes:
    """The upper ``width`` bytes of sorted keys as differences, byte plane by byte plane, so that the zero planes compress away."""
    top = keys >> np.uint64(64 - 8 * width)
    step = np.diff(top, prepend=np.uint64(0))
    return np.ascontiguousarray(step.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    wide = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((wide.shape[1], 8), np.uint8)
    out[:, :width] = wide.T
    return np.cumsum(out.view("<u8").ravel(), dtype=np.uint64)


def question_rows(chunk_id: int, keys: np.ndarray, counts: np.ndarray, buckets: int, width: int) -> pa.RecordBatch:
    """Rows (bucket, chunk_id, keys, counts) of one chunk's sorted distinct keys."""
    cut = cuts(keys, buckets)
    used = np.flatnonzero(np.diff(cut))
    counts = np.minimum(counts, 255).astype(np.uint8)
    return pa.RecordBatch.from_arrays([
        pa.array(used, pa.int64()), pa.array(np.full(len(used), chunk_id), pa.int64()),
        pa.array([planes(keys[cut[b]: cut[b + 1]], width) for b in used], pa.binary()),
        pa.array([counts[cut[b]: cut[b + 1]].tobytes() for b in used], pa.binary()),
    ], names=["bucket", "chunk_id", "keys", "counts"])


QUESTIONS = "bucket long, chunk_id long, keys binary, counts binary"


def answers(questions: DataFrame, width: int) -> DataFrame:
    """(chunk_id, replies): per chunk an array of (bucket, count class per key); class c stands for a count from 2**c on."""

    def run(table: pa.Table) -> pa.Table:
        blobs = [from_planes(x, width) for x in table.column("keys").to_pylist()]
        counts = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("counts").to_pylist()]).astype(np.int64)
        keys = np.concatenate(blobs)
        _, back = np.unique(keys, return_inverse=True)
        total = np.bincount(back, weights=counts)
        level = np.minimum(np.log2(np.maximum(total, 1)).astype(np.int64), CLASSES).astype(np.uint8)[back]
        ends = np.cumsum([len(b) for b in blobs])
        return pa.table({
            "chunk_id": table.column("chunk_id"), "bucket": table.column("bucket"),
            "level": pa.array([x.tobytes() for x in np.split(level, ends[:-1])], pa.binary()),
        })

    out = questions.groupBy("bucket").applyInArrow(run, "chunk_id long, bucket long, level binary")
    return out.groupBy("chunk_id").agg(F.collect_list(F.struct("bucket", "level")).alias("replies"))


def levels(replies: list[dict] | None) -> np.ndarray:
    """Count classes in the chunk's key order."""
    rows = sorted(replies or [], key=lambda r: r["bucket"])
    return np.frombuffer(b"".join(r["level"] for r in rows), np.uint8)

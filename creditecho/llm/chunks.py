"""Documents packed into chunks of about a megabyte: one row per chunk, written once, then read by every pass of an operator.

A chunk is the unit that passes exchange replies for, so no pass needs a row per word. A chunk holds whole documents; a document larger
than a chunk has one of its own.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from creditecho.llm.store import stored
from creditecho.llm.textbatch import GROUP_BYTES, groups

NULL_ID = np.int64(2**63 - 1)  # stands for a null doc_id, which is ordered last


class Chunk:
    def __init__(self, chunk_id: int, ids: np.ndarray, lengths: np.ndarray, body: bytes):
        self.chunk_id, self.ids = chunk_id, ids
        cut = np.concatenate([[0], np.cumsum(lengths)]).tolist()
        self.parts = [body[a:b] for a, b in zip(cut[:-1], cut[1:])]

    def id_array(self) -> pa.Array:
        return pa.array(self.ids, pa.int64(), mask=self.ids == NULL_ID)


def pack(docs: DataFrame, name: str) -> DataFrame:
    """Stored rows (chunk_id, n_bytes, ids, lengths, body); body is compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        first, size = TaskContext.get().partitionId() << 32, 0
        zip_ = zstandard.ZstdCompressor(level=1)

        def flush() -> pa.RecordBatch:
            nonlocal first, size
            parts = [p for _, p in held]
            row = pa.RecordBatch.from_arrays([
                pa.array([first]), pa.array([sum(map(len, parts))], pa.int64()),
                pa.array([np.array([i for i, _ in held], np.int64).tobytes()], pa.binary()),
                pa.array([np.array([len(p) for p in parts], np.int64).tobytes()], pa.binary()),
                pa.array([zip_.compress(b"".join(parts))], pa.binary()),
            ], names=["chunk_id", "n_bytes", "ids", "lengths", "body"])
            held.clear()
            first, size = first + 1, 0
            return row

        for batch, parts in groups(batches):
            ids = batch.column("doc_id").cast(pa.int64()).to_pylist()
            for i, p in zip(ids, parts):
                if held and size + len(p) > GROUP_BYTES:
                    yield flush()
                held.append((int(NULL_ID) if i is None else i, p))
                size += len(p)
        if held:
            yield flush()

    packed = docs.select("doc_id", "text").mapInArrow(run, "chunk_id long, n_bytes long, ids binary, lengths binary, body binary")
    return stored(packed, name)


def unpack(batch: pa.RecordBatch, row: int) -> Chunk:
    get = lambda c: batch.column(c)[row].as_py()
    return Chunk(
        get("chunk_id"), np.frombuffer(get("ids"), np.int64), np.frombuffer(get("lengths"), np.int64),
        zstandard.ZstdDecompressor().decompress(get("body"), max_output_size=max(1, get("n_bytes"))),
    )

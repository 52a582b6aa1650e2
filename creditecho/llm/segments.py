"""Exact search for repeated windows of a sequence (words or bytes) without comparing all documents.

Every window of ``size`` items has an anchor: its run of ``gram`` items with the least hash, the leftmost of equals. Equal windows have equal
anchors, so windows are grouped by anchor: neighbouring windows with the same anchor form a segment, and a repeated window can only lie in
two segments with the same key. Three passes over stored chunks:

1. anchors are counted (``shared_keys``); segments whose anchor occurs once cannot hold a repeated window and go no further;
2. the other segments travel to a task per key range, equal ones of a chunk as one row; there an operator decides its own way;
3. the decisions come back per chunk, as ranges of window starts.

A key that many documents share arrives once per chunk and different content; rows of content already seen are answered at once and not kept.
An anchor of count class ``HOT`` or more can have very many different surroundings, so its segments do not meet in one task: each of its windows
travels by itself, as a 128-bit digest that is also its route. Equal windows still meet, and no text of a hot anchor is kept anywhere.
"""
from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditecho.llm.chunks import Chunk, unpack
from creditecho.llm.shared_keys import QUESTIONS, answers, bucket_count, levels, question_rows

_U = np.uint64
FAR = _U(0xFFFFFFFF)
HOT = 13  # count class: 8,192 anchors at least, some shards' worth of segments


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours: block-wise running minima from both sides."""
    n = len(a) - width + 1
    if n <= 0:
        return a[:0]
    wide = np.full(-(-len(a) // width) * width, np.iinfo(a.dtype).max, a.dtype)
    wide[: len(a)] = a
    wide = wide.reshape(-1, width)
    ahead = np.minimum.accumulate(wide, axis=1).ravel()
    behind = np.minimum.accumulate(wide[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1: width - 1 + n])


class Segments:
    """``first``/``last`` window start, ``key`` and ``weight`` (anchors inside) of each segment of one chunk."""

    def __init__(self, hashes: np.ndarray, gram_ok: np.ndarray, doc: np.ndarray, size: int, gram: int):
        n = len(doc) - size + 1
        empty = np.zeros(0, np.int64)
        self.first = self.last = self.weight = empty
        self.key = empty.astype(np.uint64)
        if n <= 0:
            return
        packed = np.where(gram_ok, hashes >> _U(32), FAR) << _U(32) | np.arange(len(hashes), dtype=np.uint64)
        at = (sliding_min(packed, size - gram + 1)[:n] & FAR).astype(np.int64)
        good = doc[:n] == doc[size - 1:]
        new = good.copy()
        new[1:] &= (at[1:] != at[:-1]) | ~good[:-1]
        run = np.flatnonzero(new)
        if not len(run):
            return
        stop = np.flatnonzero(good & ~np.append(good[1:] & ~new[1:], False))
        key = hashes[at[run]]
        head = np.ones(len(run), bool)
        head[1:] = (key[1:] != key[:-1]) | (run[1:] != stop[:-1] + 1)
        lead = np.flatnonzero(head)
        self.first, self.key = run[lead], key[lead]
        self.last = stop[np.append(lead[1:], len(run)) - 1]
        self.weight = np.diff(np.append(lead, len(run)))

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        keys, back = np.unique(self.key, return_inverse=True)
        return keys, np.bincount(back, weights=self.weight).astype(np.int64)

    def live(self, level: np.ndarray, hot: int) -> tuple[np.ndarray, np.ndarray]:
        """Segments whose anchor occurs more than once in the corpus, and which of them have a hot one."""
        keys = np.unique(self.key)
        if not len(keys):
            return np.zeros(0, np.int64), np.zeros(0, bool)
        own = level[np.searchsorted(keys, self.key)]
        live = np.flatnonzero(own > 0)
        return live, own[live] >= hot


#: ``single``: the row stands for one window, and content is its digest.
ROWS = "key long, single boolean, content binary, doc_id long, start long, weight long, chunk_id long, places binary"
REPLIES = "chunk_id long, ranges binary"


def reply_batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["chunk_id", "ranges"]
    )


class View:
    """What an operator tells about a chunk: its segments, and the content of a segment."""

    def __init__(self, segments: Segments, doc: np.ndarray, first_item: np.ndarray, content: Callable[[int, int], bytes]):
        self.segments, self.doc, self.first_item, self.content = segments, doc, first_item, content


def repeated_ranges(
    chunks: DataFrame, view: Callable[[Chunk], View], solve: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    hot: int = HOT,
) -> DataFrame:
    """(chunk_id, n_bytes, ids, lengths, body, found): chunks with the ranges that ``solve`` found in them."""
    buckets = bucket_count(chunks)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = unpack(batch, row)
                keys, counts = view(chunk).segments.counted()
                yield question_rows(chunk.chunk_id, keys, counts, buckets, 8)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                level = levels(batch.column("replies")[row].as_py())
                if level.any():
                    chunk = unpack(batch, row)
                    yield _rows(chunk, view(chunk), level, hot)

    counted = answers(chunks.mapInArrow(ask, QUESTIONS), 8)
    sent = chunks.join(counted, "chunk_id").mapInArrow(send, ROWS)
    parts = max(int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets // 4)
    dealt = sent.repartition(parts, "key").sortWithinPartitions("key", "single", "content", "doc_id", "start", "chunk_id")
    ranges = dealt.mapInArrow(solve, REPLIES).groupBy("chunk_id").agg(F.collect_list("ranges").alias("found"))
    return chunks.join(ranges, "chunk_id", "left")


def _rows(chunk: Chunk, v: View, level: np.ndarray, hot: int) -> pa.RecordBatch:
    """Live segments of a chunk, or windows of hot ones; equal ones become one row whose first place is the least by (doc_id, start)."""
    seg, rows = v.segments, {}
    live, alone = seg.live(level, hot)
    n = np.where(alone, seg.last[live] - seg.first[live] + 1, 1)
    of = np.repeat(np.arange(len(live)), n)
    first = seg.first[live][of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    single = alone[of]
    last = np.where(single, first, seg.last[live][of])
    doc = v.doc[first]
    ids, start = chunk.ids[doc], first - v.first_item[doc]
    for i in np.lexsort((start, ids)).tolist():
        content, key, one = v.content(int(first[i]), int(last[i])), int(seg.key[live[of[i]]]), bool(single[i])
        if one:
            content = blake2b(content, digest_size=16).digest()
            key = int.from_bytes(content[:8], "little")
        row = rows.setdefault((key, one, content), [int(ids[i]), int(start[i]), 0, array("q")])
        row[2] += int(seg.weight[live[of[i]]])
        # a place of the same doc_id and start is the same place for the order, so it is answered like the first
        row[3].extend((int(first[i]), int(ids[i]) == row[0] and int(start[i]) == row[1]))
    items = list(rows.items())
    return pa.RecordBatch.from_arrays([
        pa.array(np.array([k for (k, _, _), _ in items], np.uint64).view(np.int64)), pa.array([one for (_, one, _), _ in items], pa.bool_()),
        pa.array([c for (_, _, c), _ in items], pa.binary()),
        pa.array([r[0] for _, r in items], pa.int64()), pa.array([r[1] for _, r in items], pa.int64()),
        pa.array([r[2] for _, r in items], pa.int64()), pa.array([chunk.chunk_id] * len(items), pa.int64()),
        pa.array([r[3].tobytes() for _, r in items], pa.binary()),
    ], names=["key", "single", "content", "doc_id", "start", "weight", "chunk_id", "places"])


def marks(found: list[bytes] | None) -> np.ndarray:
    """(first, last) window starts of a chunk, one row per range."""
    return np.frombuffer(b"".join(found or []), np.int64).reshape(-1, 2)


def cover(ranges: np.ndarray, size: int, n: int) -> np.ndarray:
    """Items covered by a window whose start lies in a range."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, ranges[:, 0], 1)
    np.add.at(step, np.minimum(ranges[:, 1] + size, n), -1)
    return np.cumsum(step[:n]) > 0

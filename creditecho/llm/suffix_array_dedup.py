"""Removes byte strings that occur more than once, with a Burrows-Wheeler transform per shard.

A byte goes if a string of ``window`` bytes that covers it also starts anywhere else, in any document. ``segments`` deals the text that can
repeat into shards, so that equal windows meet in one shard. A shard's different segments, joined by a separator, are ordered by their
first ``window`` bytes (prefix doubling; only places still tied are sorted again) and give a Burrows-Wheeler transform. From the interval
of the empty string, intervals are extended backwards, breadth first: step l reaches the intervals of strings of length l + 1 and thereby
the common prefixes of value l, in increasing order. The expansion stops at ``window``: neighbours whose common prefix is still unknown share at
least that much, so their windows are repeated. Strings that hold the separator are not extended and cannot be windows.

Segments that occur twice as they are need no order: all their windows are repeated. They stay in the shard as reference for others. A key with one
segment only is settled by its number of places. So are windows of an anchor that very many segments share, which come one by one.

Defined cases: a null text is empty; a text shorter than a window loses nothing; rows that repeat a doc_id or a whole text are places of
their own, so equal rows remove each other's bytes; very long texts have a chunk of their own; an empty table gives an empty result;
extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from creditecho.llm.chunks import Chunk, pack, unpack
from creditecho.llm.segments import HOT, Segments, View, cover, marks, repeated_ranges, reply_batch
from creditecho.llm.textbatch import window_hash

WINDOW = 400
ANCHOR = 32
SHARD_BYTES = 1 << 20


def prefix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` (small numbers) ordered by their first ``depth`` items at least; equal ones in any order."""
    n = len(text)
    wide = np.zeros(n + 8, np.uint64)
    wide[:n] = text
    first = np.zeros(n, np.uint64)
    for j in range(7):  # 9 bits an item, behind the end counts as the separator
        first = (first << np.uint64(9)) | wide[j: n + j]
    order = np.argsort(first, kind="stable")
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1

    def name(places: np.ndarray, key: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Gives sorted places the number of places before their group; returns the places still tied."""
        new = np.ones(len(places), bool)
        new[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(places)))
        rank[places] = np.repeat(base[at], size)
        return places[np.repeat(size, size) > 1]

    tied, h = name(order, first[order], np.arange(n)), 7
    while len(tied) and h < depth:
        key = rank[tied] * (n + 2) + rank[np.minimum(tied + h, n)] + 1
        by = np.argsort(key, kind="stable")
        places, key, group = tied[by], key[by], rank[tied][by]
        head = np.ones(len(places), bool)
        head[1:] = group[1:] != group[:-1]
        begin = np.flatnonzero(head)
        inside = np.arange(len(places)) - np.repeat(begin, np.diff(np.append(begin, len(places))))
        tied, h = name(places, key, group + inside), 2 * h
    return np.argsort(rank[:n], kind="stable")


def common_prefixes(text: np.ndarray, order: np.ndarray, stop: int) -> np.ndarray:
    """Common prefix of each ordered place with the one before it; -1 where it is ``stop`` or more (or holds item 0).

    Breadth-first backward extension over intervals of the transform; item 0 is never put in front.
    """
    n = len(text)
    bwt = text[order - 1]
    last_to_first = np.empty(n, np.int64)
    last_to_first[np.argsort(bwt, kind="stable")] = np.arange(n)
    out = np.full(n + 1, -1, np.int64)
    out[n] = out[0] = 0
    low, high = np.array([0]), np.array([n])
    for value in range(stop):
        size = high - low
        total = np.cumsum(size)
        if not len(total):
            break
        place = np.repeat(low - (total - size), size) + np.arange(total[-1])
        owner = np.repeat(np.arange(len(low)), size)
        real = bwt[place] != 0
        place, owner = place[real], owner[real]
        if not len(place):
            break
        to = last_to_first[place]
        by = np.argsort(to)
        to, owner, item = to[by], owner[by], bwt[place][by]
        new = np.ones(len(to), bool)
        new[1:] = (to[1:] != to[:-1] + 1) | (owner[1:] != owner[:-1]) | (item[1:] != item[:-1])
        at = np.flatnonzero(new)
        begin, end = to[at], to[np.append(at[1:], len(to)) - 1] + 1
        open_ = out[end] < 0
        low, high = begin[open_], end[open_]
        out[high] = value
    return out[:n]


def repeated_starts(contents: list[bytes], window: int) -> list[np.ndarray]:
    """Per content the places whose next ``window`` bytes also start at another place of the contents."""
    joined = np.zeros(sum(map(len, contents)) + len(contents), np.uint16)
    left = np.zeros(len(joined), np.int64)  # bytes up to the content's end
    at, begins = 0, []
    for c in contents:
        joined[at: at + len(c)] = np.frombuffer(c, np.uint8).astype(np.uint16) + 1
        left[at: at + len(c)] = np.arange(len(c), 0, -1)
        begins.append(at)
        at += len(c) + 1
    order = prefix_order(joined, window)
    prefix = common_prefixes(joined, order, window)
    whole = left[order] >= window
    pair = np.zeros(len(order) + 1, bool)
    pair[1:-1] = (prefix[1:] < 0) & whole[1:] & whole[:-1]
    hit = np.zeros(len(joined), bool)
    hit[order] = pair[1:] | pair[:-1]
    return [np.flatnonzero(hit[b: b + len(c)]) for b, c in zip(begins, contents)]


def ranges_of(starts: np.ndarray) -> np.ndarray:
    """Sorted numbers as rows (first, last) of neighbouring ones."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    cut = np.flatnonzero(np.diff(starts) != 1)
    return np.column_stack([starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)]])


def byte_view(chunk: Chunk, window: int, anchor: int) -> View:
    plain = b"\n".join([*chunk.parts, b""])
    length = np.fromiter((len(p) + 1 for p in chunk.parts), np.int64, len(chunk.parts))
    doc = np.repeat(np.arange(len(length)), length)
    doc[np.cumsum(length) - 1] = -1  # the newline between documents
    hashes = window_hash(np.frombuffer(plain, np.uint8), anchor)
    ok = (doc[: len(hashes)] == doc[anchor - 1:]) & (doc[: len(hashes)] >= 0)
    segments = Segments(hashes, ok, doc, window, anchor)
    return View(segments, doc, np.cumsum(length) - length, lambda first, last: plain[first: last + window])


def shard_solver(window: int):
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, bytes]] = []
        shard: list[tuple[bytes, tuple[int, int] | None]] = []  # content and, if it has one place, (chunk, place)
        group: list[tuple[bytes, tuple[int, int] | None, int]] = []  # of the key being read
        held, key, content = 0, None, None
        waiting: list[tuple[int, int]] = []
        weight = seen = 0

        def answer(chunk_id: int, places: list[int], wide: int) -> None:
            rows = np.array(places, np.int64)
            out.append((chunk_id, np.column_stack([rows, rows + wide]).tobytes()))

        def end_content() -> None:
            if content is not None and not key[1]:
                group.append((content, waiting[0] if seen == 1 else None, weight))

        def end_key() -> None:
            nonlocal held
            if len(group) > 1 or group and group[0][1] and group[0][2] > 1:
                for c, place, _ in group:
                    shard.append((c, place))
                    held += len(c)
            group.clear()

        def flush() -> None:
            nonlocal held
            for (_, place), found in zip(shard, repeated_starts([c for c, _ in shard], window)):
                if place and len(found):
                    out.append((place[0], (ranges_of(found) + place[1]).tobytes()))
            shard.clear()
            held = 0

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "single", "content", "weight", "chunk_id", "places")]
            for k, single, c, w, chunk_id, places in zip(*columns):
                at = [p for p, _ in np.frombuffer(places, np.int64).reshape(-1, 2).tolist()]
                wide = 0 if single else len(c) - window
                if (k, single) != key or c != content:
                    end_content()
                    if (k, single) != key:
                        end_key()
                        if held > SHARD_BYTES:
                            flush()
                    key, content, weight, seen = (k, single), c, 0, 0
                    waiting = []
                weight += w
                if seen + len(at) > 1:
                    for other, place in waiting:
                        answer(other, [place], wide)
                    waiting = []
                    answer(chunk_id, at, wide)
                else:
                    waiting = [(chunk_id, at[0])]
                seen += len(at)
            if len(out) > 2000:
                yield reply_batch(out)
                out.clear()
        end_content()
        end_key()
        if shard:
            flush()
        if out:
            yield reply_batch(out)

    return solve


def repeats_removed(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (maximal removed byte runs, first and last) and kept bytes per document."""
    chunks = pack(docs, "suffix-chunks")
    solved = repeated_ranges(chunks, lambda c: byte_view(c, window, anchor), shard_solver(window), hot)
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = unpack(batch, row)
                length = [len(p) for p in chunk.parts]
                at = (np.cumsum([n + 1 for n in length]) - 1 - length).tolist()
                gone = cover(marks(batch.column("found")[row].as_py()), window, sum(length) + len(length))
                spans, kept, removed = [], [], []
                for a, n, p in zip(at, length, chunk.parts):
                    own = gone[a: a + n]
                    removed.append(int(own.sum()))
                    spans.append([{"first": x, "last": y} for x, y in ranges_of(np.flatnonzero(own)).tolist()] if removed[-1] else [])
                    kept.append(np.frombuffer(p, np.uint8)[~own].tobytes() if removed[-1] else p)
                yield pa.RecordBatch.from_arrays([
                    chunk.id_array(), pa.array(length, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kind),
                    pa.array(kept, pa.binary()),
                ], names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return solved.mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, spans array<struct<first: long, last: long>>, kept binary")

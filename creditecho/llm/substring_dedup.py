"""Removes word runs that repeat earlier text, with suffix automata of reference shards.

A window is ``window`` consecutive words of one document; it is repeated if the same words also start earlier (smaller doc_id, or same
document and earlier start). Words covered by repeated windows go; windows are judged on the input.

``segments`` deals the text that can repeat into shards, so that equal windows meet in one shard. A shard's different segments are its reference:
a suffix automaton over word numbers, each state knowing its earliest place. The segments are then streamed through it for matching
statistics: where the match is as long as a window, the state of that length tells the window's earliest place, and windows with an
earlier place than their own form the maximal spans. An automaton of the whole corpus cannot be broadcast at any bound, so documents'
segments are routed to the shard's task instead of shards to all documents. Segments equal to one already in the shard are repeats
as a whole. Windows of an anchor that very many segments share come one by one and need no automaton: all but the earliest place of a window go.

Defined cases: a null text has no words; a text shorter than a window loses nothing; a null doc_id is ordered last; rows that repeat a doc_id
count as one place where they start alike, so neither removes the other there; very long texts have a chunk of their own; an empty
table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from creditecho.llm.chunks import Chunk, pack, unpack
from creditecho.llm.segments import HOT, Segments, View, cover, marks, repeated_ranges, reply_batch
from creditecho.llm.textbatch import Texts, grams

WINDOW = 20
ANCHOR = 6
SHARD_WORDS = 100_000


class SuffixAutomaton:
    """States with transitions, suffix links, lengths and the least rank of an end place."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.rank = [-1], [0], [2**62]

    def add(self, word: int, last: int, rank: int) -> int:
        """Appends a word behind state ``last`` (0 begins a text) and returns the state of the longer text."""
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:  # only from the start or where a text repeats another one
            q = nxt[last][word]
            if length[q] == length[last] + 1:
                self.rank[q] = min(self.rank[q], rank)
                return q
            return self._clone(last, q, word, rank)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        self.rank.append(rank)
        p = last
        while p >= 0 and word not in nxt[p]:
            nxt[p][word] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][word]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, word, 2**62)
        return cur

    def _clone(self, p: int, q: int, word: int, rank: int) -> int:
        nxt, link = self.next, self.link
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        self.length.append(self.length[p] + 1)
        link.append(link[q])
        self.rank.append(rank)
        link[q] = clone
        while p >= 0 and nxt[p].get(word) == q:
            nxt[p][word] = clone
            p = link[p]
        return clone

    def settle(self, window: int) -> list[int]:
        """Spreads ranks to shorter suffixes; returns per state the one that stands for its suffix of ``window`` words (-1: too short)."""
        order = np.argsort(self.length, kind="stable").tolist()
        for s in reversed(order[1:]):
            self.rank[self.link[s]] = min(self.rank[self.link[s]], self.rank[s])
        of = [-1] * len(order)
        for s in order[1:]:
            if self.length[s] >= window:
                of[s] = of[self.link[s]] if self.length[self.link[s]] >= window else s
        return of

    def matches(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """Matching statistics: (state, length of the longest match that ends here) per word."""
        state, size = 0, 0
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if w in self.next[state]:
                state, size = self.next[state][w], size + 1
            yield state, size


def repeated_windows(texts: list[list[int]], ends: list[np.ndarray], window: int) -> list[list[int]]:
    """Per text the window starts whose words end at a smaller rank elsewhere; ``ends`` holds the rank of each word's place."""
    automaton = SuffixAutomaton()
    for words, rank in zip(texts, ends):
        last = 0
        for w, r in zip(words, rank.tolist()):
            last = automaton.add(w, last, r)
    of = automaton.settle(window)
    out = []
    for words, rank in zip(texts, ends):
        own, hit = rank.tolist(), []
        for i, (state, size) in enumerate(automaton.matches(words)):
            if size >= window and automaton.rank[of[state]] < own[i]:
                hit.append(i - window + 1)
        out.append(hit)
    return out


def runs(starts: list[int]) -> list[tuple[int, int]]:
    """Sorted numbers as (first, last) of neighbouring ones."""
    out: list[list[int]] = []
    for s in starts:
        if out and s == out[-1][1] + 1:
            out[-1][1] = s
        else:
            out.append([s, s])
    return [tuple(x) for x in out]


def word_view(chunk: Chunk, window: int, anchor: int) -> View:
    t = Texts(chunk.parts)
    hashes = t.word_hashes()
    h, ok = grams(hashes, t.doc, anchor)
    buf = t.buf
    plain = buf.tobytes()

    def content(first: int, last: int) -> bytes:
        return b" ".join(plain[t.starts[first]: t.ends[last + window - 1]].split())

    return View(Segments(h, ok, t.doc, window, anchor), t.doc, t.first_word, content)


def shard_solver(window: int):
    """Reads segment rows sorted by key, content and place; answers per chunk."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        out: list[tuple[int, bytes]] = []
        held, key, content, first = 0, None, None, (0, 0)

        def flush() -> None:
            nonlocal held
            number: dict[bytes, int] = {}
            texts = [[number.setdefault(w, len(number)) for w in c.split(b" ")] for c, *_ in shard]
            doc = np.concatenate([np.full(len(t), s[1]) for t, s in zip(texts, shard)])
            at = np.concatenate([s[2] + np.arange(len(t)) for t, s in zip(texts, shard)])
            order = np.lexsort((at, doc))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(doc[order]) != 0) | (np.diff(at[order]) != 0)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.cumsum(new)
            ends = np.split(rank, np.cumsum([len(t) for t in texts])[:-1])
            for found, (_, _, _, rows) in zip(repeated_windows(texts, ends, window), shard):
                ranges = runs(found)
                for chunk_id, place in rows:
                    answer = [(place + a, place + b) for a, b in ranges]
                    if answer:
                        out.append((chunk_id, np.array(answer, np.int64).tobytes()))
            shard.clear()
            held = 0

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "single", "content", "doc_id", "start", "chunk_id", "places")]
            for k, single, c, d, s, chunk_id, places in zip(*columns):
                size = window if single else c.count(b" ") + 1
                wide = size - window
                if (k, single) != key or c != content:
                    if (k, single) != key and held > SHARD_WORDS:
                        flush()
                    key, content, first = (k, single), c, (d, s)
                    if not single:
                        shard.append((c, d, s, []))
                        held += size
                same = (d, s) == first
                answer = []
                for place, like_first in np.frombuffer(places, np.int64).reshape(-1, 2).tolist():
                    if same and like_first:
                        if not single:  # the earliest place of a single window stays
                            shard[-1][3].append((chunk_id, place))
                    else:
                        answer.append((place, place + wide))
                if answer:
                    out.append((chunk_id, np.array(answer, np.int64).tobytes()))
            if len(out) > 2000:
                yield reply_batch(out)
                out.clear()
        if shard:
            flush()
        if out:
            yield reply_batch(out)

    return solve


def repeats_removed(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, spans (maximal removed word runs) and kept (the other words, joined by one space) per document."""
    chunks = pack(docs, "substring-chunks")
    solved = repeated_ranges(chunks, lambda c: word_view(c, window, anchor), shard_solver(window), hot)
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = unpack(batch, row)
                t = Texts(chunk.parts)
                n = len(t.starts)
                gone = cover(marks(batch.column("found")[row].as_py()), window, n)
                keep = np.flatnonzero(~gone)
                step = np.zeros(len(t.buf) + 1, np.int8)
                step[t.starts[keep]] += 1
                step[t.ends[keep] + 1] -= 1
                plain = t.buf.copy()
                plain[t.ends] = 32
                kept = plain[np.cumsum(step[:-1], dtype=np.int8) > 0]
                size = np.bincount(t.doc[keep], weights=(t.ends - t.starts + 1)[keep], minlength=len(chunk.parts)).astype(np.int64)
                end = np.cumsum(size)
                texts = [kept[a: b - 1].tobytes() if b > a else b"" for a, b in zip((end - size).tolist(), end.tolist())]
                removed = t.per_doc_words(gone)
                spans = [
                    [{"first": a, "last": b} for a, b in runs(np.flatnonzero(gone[f: f + m]).tolist())] if r else []
                    for f, m, r in zip(t.first_word.tolist(), t.n_words.tolist(), removed.tolist())
                ]
                yield pa.RecordBatch.from_arrays([
                    chunk.id_array(), pa.array(t.n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kind),
                    pa.array(texts, pa.binary()),
                ], names=["doc_id", "n_words", "n_removed", "spans", "kept"])

    return solved.mapInArrow(finish, "doc_id long, n_words long, n_removed long, spans array<struct<first: long, last: long>>, kept binary")

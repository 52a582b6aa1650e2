"""Whole-batch text work in numpy: words, their 64-bit hashes, n-grams, for many documents in one byte buffer.

Documents are joined by a newline, so no word crosses a document. A word is a run of bytes outside ``SEPARATORS``
(space and \\x09-\\x0D), which on UTF-8 equals the pattern ``[^\\x20\\x09-\\x0D]+`` on characters.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from creditecho.llm.store import give_back

SEPARATORS = bytes([9, 10, 11, 12, 13, 32])
GROUP_BYTES = 1 << 20
SCORE_BYTES = 1 << 18  # per run of a scan that keeps many numbers per byte of text

_U = np.uint64
_IS_SEP = np.zeros(256, bool)
_IS_SEP[list(SEPARATORS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BYTE_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))


def _power(base: int, n: int) -> np.ndarray:
    name = str(base)
    have = _powers.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 20), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if len(have) <= 1 << 24:  # a single very long text does not stay in memory
            _powers[name] = have
    return have[:n]


def range_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, from one prefix sum over the buffer."""
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[buf] * _power(_BASE, len(buf)), dtype=np.uint64, out=total[1:])
    return mixed((total[ends] - total[starts]) * _power(_BASE_INVERSE, len(buf) + 1)[starts])


def window_hash(buf: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` bytes."""
    n = len(buf) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[buf] * _power(_BASE, len(buf)), dtype=np.uint64, out=total[1:])
    return mixed((total[size:] - total[:n]) * _power(_BASE_INVERSE, n))


class Texts:
    """Some documents as one buffer. ``starts``/``ends``/``doc`` describe words in order of appearance."""

    def __init__(self, parts: list[bytes], lower: bool = False):
        self.parts = parts
        self.lengths = np.fromiter((len(p) for p in parts), np.int64, len(parts))
        self.buf = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
        if lower:
            self.buf = _LOWER[self.buf]
        self.doc_end = np.cumsum(self.lengths + 1) - 1  # place of the newline behind each document
        self.doc_start = self.doc_end - self.lengths
        edge = np.diff(_IS_SEP[self.buf].view(np.int8), prepend=np.int8(1))
        self.starts = np.flatnonzero(edge == -1)
        self.ends = np.flatnonzero(edge == 1)
        self.doc = np.searchsorted(self.doc_end, self.starts, side="right")
        self.n_words = np.bincount(self.doc, minlength=len(parts)) if len(parts) else np.zeros(0, np.int64)
        self.first_word = np.cumsum(self.n_words) - self.n_words

    def word_hashes(self) -> np.ndarray:
        return range_hash(self.buf, self.starts, self.ends)

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array over each document (its newline excluded)."""
        total = np.zeros(len(self.buf) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.doc_end] - total[self.doc_start]

    def per_doc_words(self, flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.starts) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.first_word + self.n_words] - total[self.first_word]


def grams(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` neighbouring items, and whether the run stays in one document."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    out = hashes[:n].copy()
    for j in range(1, size):
        out = out * _U(0xD6E8FEB86659FD93) + hashes[j: n + j]
    return mixed(out), doc[:n] == doc[size - 1:]


def covered(marks: np.ndarray, size: int, n: int) -> np.ndarray:
    """Items covered by a run of ``size`` items that starts at a marked place."""
    step = np.zeros(n + 1, np.int32)
    step[marks] += 1
    step[np.minimum(marks + size, n)] -= 1
    return np.cumsum(step[:n]) > 0


def byte_lists(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def groups(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = GROUP_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cuts Arrow batches into runs of documents of about ``size`` bytes, at least one document each.

    Only the texts of one run are held as Python bytes; behind the last run the task's freed memory is given back.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text).cast(pa.binary())), 0).to_pylist()
        at = 0
        while at < len(lengths):
            end, held = at, 0
            while end < len(lengths) and (end == at or held + lengths[end] <= size):
                held += lengths[end] + 1
                end += 1
            part = batch.slice(at, end - at)
            yield part, byte_lists(part.column(text))
            at = end
    batch = part = None
    give_back()

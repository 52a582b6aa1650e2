"""Hashed word and character n-grams of whole texts, as bucket numbers per document."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditecho.llm.textbatch import _IS_SEP, Texts, groups

WORD_BITS = 15
CHAR_BITS = 15
_U = np.uint64


def word_buckets(t: Texts, hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket, document) of single words and of word pairs inside a document; a word followed by itself is one bucket for all words."""
    shift = _U(64 - WORD_BITS)
    out = [((hashes >> shift).astype(np.int64), t.doc)]
    if len(hashes) > 1:
        pair = hashes[:-1] * _U(0xC2B2AE3D27D4EB4F) + hashes[1:] * _U(0x165667B19E3779F9)
        pair = np.where(hashes[:-1] == hashes[1:], _U(0), pair)
        same = t.doc[:-1] == t.doc[1:]
        out.append(((pair >> shift).astype(np.int64)[same], t.doc[:-1][same]))
    return out


def char_buckets(t: Texts, sizes: tuple[int, ...], inside_words: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket, document) of byte n-grams. ``inside_words``: only the outer bytes may be separators, which mark word ends."""
    out, wide, sep = [], t.buf.astype(np.uint64), _IS_SEP[t.buf]
    doc = np.repeat(np.arange(len(t.lengths)), t.lengths + 1)
    newline = np.zeros(len(t.buf), bool)
    newline[t.doc_end] = True
    for size in sizes:
        n = len(wide) - size + 1
        if n <= 0:
            continue
        packed = np.zeros(n, np.uint64)
        for j in range(size):
            packed = (packed << _U(8)) | wide[j: n + j]
        bucket = ((packed + _U(size)) * _U(0x9E3779B97F4A7C15)) >> _U(64 - CHAR_BITS)
        ok = doc[:n] == doc[size - 1:]
        for j in range(size):
            if inside_words and 0 < j < size - 1:
                ok &= ~sep[j: n + j]
            elif j < size - 1 or not inside_words:
                ok &= ~newline[j: n + j]
        out.append((bucket.astype(np.int64)[ok], doc[:n][ok]))
    return out


class Grams:
    """Which n-grams a model reads. Words take the first buckets, characters those behind them."""

    def __init__(self, char_sizes: tuple[int, ...], inside_words: bool):
        self.char_sizes, self.inside_words = char_sizes, inside_words
        self.buckets = (1 << WORD_BITS) + (1 << CHAR_BITS)

    def fields(self, t: Texts, hashes: np.ndarray) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        chars = char_buckets(t, self.char_sizes, self.inside_words)
        return [word_buckets(t, hashes), [(b + (1 << WORD_BITS), d) for b, d in chars]]

    def means(self, t: Texts, hashes: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Per document: mean value of its word n-grams plus mean value of its character n-grams; 0 where it has none."""
        out = np.zeros(len(t.lengths))
        for field in self.fields(t, hashes):
            total, count = np.zeros(len(out)), np.zeros(len(out))
            for bucket, doc in field:
                total += np.bincount(doc, weights=value[bucket], minlength=len(out))
                count += np.bincount(doc, minlength=len(out))
            out += total / np.maximum(count, 1)
        return out

    def sparse(self, t: Texts, hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per document: its buckets and their weights; the weights of each of the two fields add up to 1."""
        n, b = len(t.lengths), self.buckets
        cells, weights = [], []
        for field in self.fields(t, hashes):
            cell = np.concatenate([d * b + x for x, d in field]) if field else np.zeros(0, np.int64)
            cell, count = np.unique(cell, return_counts=True)
            total = np.bincount(cell // b, weights=count, minlength=n)
            cells.append(cell)
            weights.append(count / total[cell // b] if len(cell) else np.zeros(0))
        cell, weight = np.concatenate(cells), np.concatenate(weights)
        order = np.argsort(cell, kind="stable")
        cell, weight = cell[order], weight[order]
        cut = np.searchsorted(cell // b, np.arange(1, n))
        return list(zip(np.split(cell % b, cut), np.split(weight, cut)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, allowed=None) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` labelled documents, the first ones by hash of doc_id.

    A doc_id with several labels takes their rounded mean. The bound limits what fits a model, nothing else. The sampled ids
    are broadcast (at most ``max_rows`` numbers), so the texts are not shuffled.
    """
    marks = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("double").alias("_y")).dropna()
    if allowed is not None:
        marks = marks.filter(allowed(F.col("_id")))
    marks = marks.groupBy("_id").agg(F.when(F.avg("_y") >= 0.5, 1).otherwise(0).alias("_y"))
    marks = marks.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    texts = docs.select("doc_id", "text")
    return texts.join(F.broadcast(marks), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "_y")


def training_rows(sample: DataFrame, grams: Grams) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(doc_id, label, buckets, weights) of a bounded sample on the driver, in order of doc_id; counting runs on the executors."""

    kind = np.uint16 if grams.buckets <= 65536 else np.uint32

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, parts in groups(batches):
            t = Texts(parts)
            rows, zip_ = grams.sparse(t, t.word_hashes()), zstandard.ZstdCompressor()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("_y").cast(pa.int32()), pa.array([len(x) for x, _ in rows], pa.int64()),
                pa.array([zip_.compress(x.astype(kind).tobytes() + w.astype(np.float32).tobytes()) for x, w in rows], pa.binary()),
            ], names=["doc_id", "y", "n", "data"])

    table = sample.mapInArrow(count, "doc_id long, y int, n long, data binary").toArrow()
    sizes = table.column("n").to_pylist()
    cut = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).tolist()
    buckets, weights = np.empty(cut[-1], kind), np.empty(cut[-1], np.float32)  # two blocks, given back as a whole
    unzip, width = zstandard.ZstdDecompressor(), np.dtype(kind).itemsize
    for a, b, data in zip(cut[:-1], cut[1:], table.column("data")):
        if b > a:
            plain = unzip.decompress(data.as_py())
            buckets[a:b] = np.frombuffer(plain, kind, b - a)
            weights[a:b] = np.frombuffer(plain, np.float32, b - a, (b - a) * width)
    keys, marks = table.column("doc_id").to_pylist(), table.column("y").to_pylist()
    del table
    pa.default_memory_pool().release_unused()
    rows = [(k, y, buckets[a:b], weights[a:b]) for k, y, a, b in zip(keys, marks, cut[:-1], cut[1:])]
    rows.sort(key=lambda r: (r[0], len(r[2]), r[2].tobytes()))
    return rows

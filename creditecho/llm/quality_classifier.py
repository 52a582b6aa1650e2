"""Supervised subword embeddings: a document is the mean of the learned vectors of its hashed words, word pairs and character
n-grams; a softmax layer on top gives the class probabilities. Trained by numpy stochastic gradient descent on the driver from at most
``max_rows`` labelled documents (a documented bound on what fits the model). Vectors and layer are linear, so scoring folds them
into one value per bucket and class difference; the softmax of two classes is the logistic function of that difference.

Defined cases: a null or empty text has no n-grams and gets the score of the bias; labels with null values are ignored, several labels of
one doc_id take their rounded mean; without labelled rows of both classes the score is the share of label 1 (0.5 without any); a null
doc_id counts as not held out; repeated rows are scored each on its own; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditecho.llm.hashed_grams import Grams, labelled_sample, training_rows
from creditecho.llm.textbatch import Texts, groups

GRAMS = Grams(char_sizes=(3, 5), inside_words=True)
MAX_ROWS = 3000
DIMENSIONS = 8
EPOCHS = 12
RATE = 2.0
POSITIVE_AT = 0.7


class Embeddings:
    """``vectors`` (bucket x dimension), ``layer`` (dimension x class) and ``bias`` (class)."""

    def __init__(self, vectors: np.ndarray, layer: np.ndarray, bias: np.ndarray):
        self.vectors, self.layer, self.bias = vectors, layer, bias

    def folded(self) -> tuple[np.ndarray, float]:
        side = self.layer[:, 1] - self.layer[:, 0]
        return (self.vectors @ side).astype(np.float32), float(self.bias[1] - self.bias[0])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fit(rows: list, buckets: int, dimensions: int = DIMENSIONS, epochs: int = EPOCHS, rate: float = RATE) -> Embeddings:
    rng = np.random.default_rng(11)
    vectors = rng.uniform(-1 / dimensions, 1 / dimensions, (buckets, dimensions))
    layer, bias = rng.uniform(-0.5, 0.5, (dimensions, 2)), np.zeros(2)
    total, step = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            _, y, x, v = rows[i]
            now = rate * (1 - step / total)
            hidden = v @ vectors[x]
            error = -softmax(hidden @ layer + bias)
            error[y] += 1
            back = layer @ error
            layer += 0.1 * now * np.outer(hidden, error)
            bias += 0.05 * now * error
            vectors[x] += now * np.outer(v, back)
            step += 1
    return Embeddings(vectors, layer, bias)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", allowed=None, max_rows: int = MAX_ROWS) -> Embeddings:
    rows = training_rows(labelled_sample(docs, labels, label, max_rows, allowed), GRAMS)
    classes = [y for _, y, _, _ in rows]
    if len(set(classes)) < 2:
        share = min(0.999, max(0.001, float(np.mean(classes)))) if classes else 0.5
        bias = np.array([0.0, np.log(share / (1 - share))])
        return Embeddings(np.zeros((GRAMS.buckets, 1)), np.zeros((1, 2)), bias)
    return fit(rows, GRAMS.buckets)


def is_held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score (probability of label 1) and predicted for every document; held-out labels train nothing."""
    value, bias = train(docs, labels, "quality", lambda key: ~is_held_out(key), max_rows).folded()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, parts in groups(batches):
            t = Texts(parts)
            z = GRAMS.means(t, t.word_hashes(), value) + bias
            p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(p)], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double")
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= POSITIVE_AT, 1).otherwise(0).cast("int").alias("predicted"),
    )

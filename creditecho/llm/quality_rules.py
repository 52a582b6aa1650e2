"""Quality rules: fixed rules on counts, and a calibrated logistic regression on hashed word and character n-grams.

The regression is fitted on the driver from at most ``max_rows`` labelled documents (a documented bound on what fits the model), two
thirds for the weights and one third for the calibration (a logistic curve from score to probability). Every document is scored on
its whole text in Arrow batches.

Defined cases: a null or empty text has no words, so the rules reject it; a document without labels is scored like any other; with no
labelled rows, or labels of one class only, the regression keeps what the rules keep; repeated rows are scored each on its own; an empty
table gives an empty result; extra columns of ``docs`` are ignored by ``quality_report`` and passed on by ``kept_documents``.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from creditecho.llm.hashed_grams import Grams, labelled_sample, training_rows
from creditecho.llm.textbatch import SCORE_BYTES, Texts, covered, grams, groups, range_hash

GRAMS = Grams(char_sizes=(3, 4), inside_words=False)
MAX_ROWS = 3000
KEEP_AT = 0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
EPOCHS = 12
RATE = 8.0
DECAY = 1e-6

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def base_counts(t: Texts, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """The counts behind the fixed rules, one value per document."""
    n = len(t.lengths)
    is_word = np.zeros(len(t.buf) + 1, np.int8)
    is_word[t.starts] += 1
    is_word[t.ends] -= 1
    in_word = np.cumsum(is_word[:-1], dtype=np.int8) > 0
    chars = t.per_doc(in_word & ((t.buf & 0xC0) != 0x80))

    newline = np.flatnonzero(t.buf == 10)
    line_start = np.concatenate([[0], newline[:-1] + 1]) if len(newline) else newline
    line_doc = np.searchsorted(t.doc_end, line_start, side="right")
    has_word = np.searchsorted(t.starts, newline) > np.searchsorted(t.starts, line_start)
    line_start, line_end, line_doc = line_start[has_word], newline[has_word], line_doc[has_word]
    dup_lines = np.bincount(line_doc, minlength=n) - _distinct(range_hash(t.buf, line_start, line_end), line_doc, n)

    h, same = grams(hashes, t.doc, REPEAT_WINDOW)
    place = np.flatnonzero(same)
    h, doc = h[place], t.doc[place]
    order = np.lexsort((h, doc))
    equal = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twice = np.zeros(len(h), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    repeated = t.per_doc_words(covered(place[twice], REPEAT_WINDOW, len(hashes)))
    return {
        "n_words": t.n_words, "word_chars": chars, "n_symbols": t.per_doc(_SYMBOL[t.buf]), "n_dup_lines": dup_lines,
        "n_repeat_words": repeated,
    }


def _distinct(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return np.bincount(doc[new], minlength=n)


class Model:
    """Weights per bucket and the calibration: P(good) = 1 / (1 + exp(-(a * score + b)))."""

    def __init__(self, weights: np.ndarray, bias: float, a: float, b: float):
        self.weights, self.bias, self.a, self.b = weights, bias, a, b

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * (score + self.bias) + self.b, -60, 60)))


def _sigmoid(x: float) -> float:
    return 1 / (1 + np.exp(-min(60.0, max(-60.0, x))))


def fit_weights(rows: list, buckets: int, epochs: int = EPOCHS, rate: float = RATE) -> tuple[np.ndarray, float]:
    """Logistic regression by stochastic gradient descent with a falling rate; rows in a fixed shuffled order."""
    w, bias, order, step = np.zeros(buckets), 0.0, np.random.default_rng(7), 0
    total = max(1, epochs * len(rows))
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            _, y, x, v = rows[i]
            now = rate * (1 - step / total)
            error = y - _sigmoid(bias + float(w[x] @ v))
            w[x] += now * (error * v - DECAY * w[x])
            bias += 0.05 * now * error
            step += 1
    return w, bias


def fit_curve(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the calibration, by Newton steps on smoothed targets (so that a perfect split stays finite)."""
    pos, neg = y.sum(), len(y) - y.sum()
    if not pos or not neg:
        return 1.0, 0.0
    goal = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * score + b, -60, 60)))
        d, v = p - goal, np.maximum(p * (1 - p), 1e-9)
        h = np.array([[v @ (score * score) + 1e-6, v @ score], [v @ score, v.sum() + 1e-6]])
        move = np.linalg.solve(h, [d @ score, d.sum()])
        a, b = a - move[0], b - move[1]
        if abs(move).max() < 1e-9:
            break
    return float(a), float(b)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model | None:
    """None where the labels show fewer than two classes."""
    rows = training_rows(labelled_sample(docs, labels, "quality", max_rows), GRAMS)
    if len({y for _, y, _, _ in rows}) < 2:
        return None
    fit, rest = [r for i, r in enumerate(rows) if i % 3], rows[::3]
    if len({y for _, y, _, _ in fit}) < 2 or len({y for _, y, _, _ in rest}) < 2:
        fit = rest = rows
    w, bias = fit_weights(fit, GRAMS.buckets)
    score = np.array([bias + float(w[x] @ v) for _, _, x, v in rest])
    a, b = fit_curve(score, np.array([y for _, y, _, _ in rest]))
    return Model(w.astype(np.float32), bias, a, b)


def scorer(model: Model | None, keep_at: float):
    """A function from texts to rule counts and verdict columns."""

    def run(parts: list[bytes]) -> dict[str, np.ndarray]:
        t = Texts(parts)
        hashes = t.word_hashes()
        out = base_counts(t, hashes)
        failed = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
        good = np.ones(len(parts)) if model is None else model.probability(GRAMS.means(t, hashes, model.weights))
        return out | {"base_failed": failed, "p_good": good, "kept": ~failed & (good >= keep_at)}

    return run


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_report(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, keep_at: float = KEEP_AT) -> DataFrame:
    """doc_id, rule counts, base_failed, p_good (calibrated probability of label 1) and kept for every document."""
    run = scorer(train(docs, labels, max_rows), keep_at)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, parts in groups(batches, size=SCORE_BYTES):
            out = run(parts)
            columns = [pa.array(out[c].astype(np.int64)) for c in COUNTS]
            columns += [pa.array(out["base_failed"]), pa.array(out["p_good"].astype(np.float64)), pa.array(out["kept"])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *columns], names=["doc_id", *COUNTS, "base_failed", "p_good", "kept"]
            )

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, p_good double, kept boolean"
    return docs.select("doc_id", "text").mapInArrow(score, schema)


def kept_documents(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, keep_at: float = KEEP_AT) -> DataFrame:
    """The documents that rules and model keep, with all their columns, filtered in the batches they arrive in."""
    run = scorer(train(docs, labels, max_rows), keep_at)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, parts in groups(batches, size=SCORE_BYTES):
            yield batch.filter(pa.array(run(parts)["kept"]))

    return docs.mapInArrow(keep, docs.schema)

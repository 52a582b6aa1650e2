"""Grid search over whole grids: all folds are prepared once into two stored tables, and candidates share their passes over them.

Logistic regression: every pass adds up, for all candidates and folds together, loss, gradient and curvature at the candidates' present weights
(one small matrix per task, added up per group of tasks); the driver takes a Newton step for each, with soft thresholds for the l1 penalty, and halves a step that
did not lower the objective. All fits end within some ten passes, whatever their number.

Neighbours: the list of the largest k is found once per fold and metric; a smaller k reads its first rows.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditecho.operators import knn
from creditecho.operators.metrics import auc_ks
from creditecho.session import stored

MAX_PASSES = 60
TOLERANCE = 1e-7
GROUPS = 64
MAX_WIDTH = 500  # the curvature of a candidate is a square matrix of this side at most


def stacks(folded: DataFrame, prepare, target: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(fold, label, w, x) of the training rows and (fold, row, label, x) of the held rows, all folds below each other.

    ``prepare(train)`` gives (preprocessor, balanced rows, weight column or None) and is fitted inside each fold.
    """
    train = held = None
    for fold in sorted(r[0] for r in folded.select("fold").distinct().collect()):
        pre, rows, weight = prepare(folded.filter(F.col("fold") != fold).drop("fold"))
        w = F.col(weight) if weight else F.lit(1.0)
        inside = rows.select(F.lit(fold).alias("fold"), F.col("label").cast("int").alias("label"), w.cast("double").alias("w"), vector_to_array("features").alias("x"))
        outside = folded.filter(F.col("fold") == fold).drop("fold").withColumn("label", F.col(target).cast("int"))
        outside = pre.transform(outside, [key, "label"]).select(F.lit(fold).alias("fold"), F.col(key).alias("row"), "label", vector_to_array("features").alias("x"))
        train = inside if train is None else train.unionByName(inside)
        held = outside if held is None else held.unionByName(outside)
    return stored(train, "grid-train"), stored(held, "grid-held")


def _matrix(batch: pa.RecordBatch, rows: np.ndarray) -> np.ndarray:
    """Features with a leading 1; the folds of a table may differ in width, the rows given do not."""
    part = batch.column("x").take(pa.array(rows))
    flat = np.asarray(part.flatten(), float).reshape(len(rows), -1)
    return np.hstack([np.ones((len(rows), 1)), flat])


def sums_at(train: DataFrame, weights: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
    """Per fold (loss per candidate, gradient, curvature, total weight); ``weights[fold]`` is (candidates, width + 1)."""

    def run(batches):
        from pyspark import TaskContext

        total: dict[int, np.ndarray] = {}
        for batch in batches:
            folds = np.asarray(batch.column("fold"))
            y, w = np.asarray(batch.column("label"), float), np.asarray(batch.column("w"), float)
            for fold in np.unique(folds):
                rows = np.flatnonzero(folds == fold)
                x, b = _matrix(batch, rows), weights[int(fold)]
                m = x @ b.T
                p = 1 / (1 + np.exp(-np.clip(m, -500, 500)))
                own = w[rows][:, None]
                loss = (own * (np.logaddexp(0, m) - y[rows][:, None] * m)).sum(axis=0)
                gradient = (own * (p - y[rows][:, None])).T @ x
                curve = own * p * (1 - p)
                second = np.stack([(x * curve[:, [c]]).T @ x for c in range(len(b))])
                flat = np.concatenate([loss, gradient.ravel(), second.ravel(), [own.sum()]])
                total[int(fold)] = total.get(int(fold), 0) + flat
        group = TaskContext.get().partitionId() % GROUPS
        yield pa.RecordBatch.from_arrays(
            [pa.array([group] * len(total), pa.int32()), pa.array(list(total), pa.int32()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))],
            names=["grp", "fold", "s"],
        )

    def add(table):
        s = np.asarray(table.column("s").combine_chunks().flatten(), float).reshape(table.num_rows, -1).sum(axis=0)
        return pa.table({"fold": table.column("fold").slice(0, 1), "s": pa.array([s.tolist()], pa.list_(pa.float64()))})

    parts = train.mapInArrow(run, "grp int, fold int, s array<double>").groupBy("grp", "fold").applyInArrow(add, "fold int, s array<double>")
    out: dict[int, np.ndarray] = {}
    for r in parts.collect():  # at most GROUPS rows per fold
        out[r.fold] = out.get(r.fold, 0) + np.array(r.s)
    told = {}
    for fold, flat in out.items():
        c, d = weights[fold].shape
        told[fold] = (flat[:c], flat[c: c + c * d].reshape(c, d), flat[c + c * d: -1].reshape(c, d, d), flat[-1])
    return told


def newton_step(b: np.ndarray, gradient: np.ndarray, second: np.ndarray, ridge: float, lasso: float) -> np.ndarray:
    """Minimum of the quadratic model plus penalty; the first weight, the intercept, has none."""
    h = second + 1e-10 * np.eye(len(b))
    if lasso == 0:
        penalty = np.full(len(b), ridge)
        penalty[0] = 0
        return b - np.linalg.solve(h + np.diag(penalty), gradient + penalty * b)
    out, slope = b.copy(), gradient.copy()  # slope of the model at ``out``
    for _ in range(2000):
        most = 0.0
        for j in range(len(b)):
            target = out[j] - slope[j] / h[j, j]
            new = target if j == 0 else np.sign(target) * max(abs(target) - lasso / h[j, j], 0.0)
            if new != out[j]:
                slope += h[:, j] * (new - out[j])
                most = max(most, abs(new - out[j]))
                out[j] = new
        if most < 1e-10:
            break
    return out


def fit_logistic_grid(train: DataFrame, candidates: list[dict]) -> dict[int, np.ndarray]:
    """Weights (intercept first) of every candidate on every fold: ``out[fold][candidate]``."""
    shape = train.groupBy("fold").agg(F.max(F.size("x")).alias("d"), F.count("*").alias("n")).collect()
    if any(r.d > MAX_WIDTH for r in shape):
        raise ValueError(f"more than {MAX_WIDTH} features")
    n = {r.fold: r.n for r in shape}
    now = {r.fold: np.zeros((len(candidates), r.d + 1)) for r in shape}
    best = {fold: b.copy() for fold, b in now.items()}
    value = {fold: np.full(len(candidates), np.inf) for fold in now}
    strength = lambda c: 1.0 / candidates[c].get("C", 1.0)
    for _ in range(MAX_PASSES):
        moved = 0.0
        for fold, (loss, gradient, second, total) in sums_at(train, now).items():
            # The penalty belongs to the mean loss with 1 / (C n), so it weighs total / n in the summed loss.
            scale = total / n[fold]
            for c, candidate in enumerate(candidates):
                l1 = candidate.get("penalty") == "l1"
                ridge, lasso = (0.0, strength(c) * scale) if l1 else (strength(c) * scale, 0.0)
                b = now[fold][c]
                reached = loss[c] + lasso * np.abs(b[1:]).sum() + ridge / 2 * (b[1:] ** 2).sum()
                if reached > value[fold][c] * (1 + 1e-12):
                    step = (best[fold][c] + b) / 2
                    if np.abs(step - best[fold][c]).max() < TOLERANCE:
                        step = best[fold][c]
                else:
                    value[fold][c], best[fold][c] = reached, b.copy()
                    step = newton_step(b, gradient[c], second[c], ridge, lasso)
                moved = max(moved, float(np.abs(step - b).max()))
                now[fold][c] = step
        if moved < TOLERANCE:
            break
    return best


def logistic_scores(held: DataFrame, weights: dict[int, np.ndarray]) -> DataFrame:
    """(candidate, fold, label, probability) of the held rows under every candidate."""

    def run(batches):
        for batch in batches:
            folds, label = np.asarray(batch.column("fold")), np.asarray(batch.column("label"))
            for fold in np.unique(folds):
                rows, b = np.flatnonzero(folds == fold), weights[int(fold)]
                p = 1 / (1 + np.exp(-np.clip(_matrix(batch, rows) @ b.T, -500, 500)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(np.arange(len(b), dtype=np.int32), len(rows))), pa.array(np.full(p.size, fold, np.int32)),
                    pa.array(np.tile(label[rows], len(b)), pa.int32()), pa.array(p.T.ravel()),
                ], names=["candidate", "fold", "label", "probability"])

    return held.mapInArrow(run, "candidate int, fold int, label int, probability double")


def knn_scores(train: DataFrame, held: DataFrame, candidates: list[dict]) -> DataFrame:
    """The same for neighbour candidates: one list per fold and metric, of the largest k."""
    metric = lambda c: "euclidean" if c["metric"] == "minkowski" else c["metric"]
    numbered = stored(train.select("fold", "label", F.col("x").alias("vector"), F.monotonically_increasing_id().alias("doc_id")), "grid-points")
    asked = stored(held.select("fold", "label", F.col("x").alias("vector"), F.monotonically_increasing_id().alias("query_id")), "grid-asked")
    out = None
    for fold in sorted(r[0] for r in held.select("fold").distinct().collect()):
        points, queries = numbered.filter(F.col("fold") == fold), asked.filter(F.col("fold") == fold)
        for name in dict.fromkeys(metric(c) for c in candidates):
            mine = [(i, c["n_neighbors"]) for i, c in enumerate(candidates) if metric(c) == name]
            near = knn.nearest(queries.select("query_id", "vector"), points.select("doc_id", "vector"), max(k for _, k in mine), name)
            voted = near.join(points.select("doc_id", F.col("label").alias("vote")), "doc_id")
            rates = voted.groupBy("query_id").agg(*[F.avg(F.when(F.col("rank") <= k, F.col("vote"))).alias(f"c{i}") for i, k in mine])
            told = rates.join(queries.select("query_id", "label"), "query_id").select("label", F.inline(F.array(*[
                F.struct(F.lit(i).alias("candidate"), F.lit(fold).alias("fold"), F.col(f"c{i}").alias("probability")) for i, _ in mine
            ])))
            out = told if out is None else out.unionByName(told)
    return out


def fold_scores(scores: DataFrame) -> list[tuple[int, int, float | None]]:
    """(candidate, fold, ROC-AUC), one row per fit."""
    return [(r.candidate, r.fold, r.roc_auc) for r in auc_ks(stored(scores, "grid-scores"), ["candidate", "fold"]).collect()]

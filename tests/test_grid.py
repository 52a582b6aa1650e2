"""Stacked fits against single fits of the same candidates, and the shared neighbour list against single classifiers."""
import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from creditecho.operators import grid as G
from creditecho.operators import models as L
from creditecho.operators.metrics import auc_ks

GRID = {"C": [0.01, 1.0], "penalty": ["l1", "l2"]}


@pytest.fixture(scope="module")
def folded(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((900, 3)) * [1, 5, 0.2]
    y = (rng.random(900) < 1 / (1 + np.exp(-(1.5 * x[:, 0] - 0.2 * x[:, 1] - 1.5)))).astype(int)
    rows = [(i, int(y[i]), *map(float, x[i]), i % 3) for i in range(900)]
    return spark.createDataFrame(rows, "id long, default_flag int, a double, b double, c double, fold int").repartition(4)


def single(folded, name, params, fold, balance):
    inside, outside = folded.filter(F.col("fold") != fold).drop("fold"), folded.filter(F.col("fold") == fold).drop("fold")
    model = L.train_model(name, inside, params, balance=balance, config={k: [] for k in L.FEATURE_KINDS})
    return model, auc_ks(model.predict(outside)).first()["roc_auc"]


@pytest.mark.parametrize("balance", ["weights", "none"])
def test_logistic_grid_equals_single_fits(folded, balance):
    config = {k: [] for k in L.FEATURE_KINDS}
    candidates = L.param_grid(GRID)
    train, held = G.stacks(folded, lambda t: L._prepared("logistic_regression", t, "default_flag", "id", balance, config), "default_flag", "id")
    weights = G.fit_logistic_grid(train, candidates)
    scores = {(i, fold): auc for i, fold, auc in G.fold_scores(G.logistic_scores(held, weights))}
    assert len(scores) == 12
    for i, fold in ((0, 0), (1, 1), (2, 2), (3, 0)):
        model, auc = single(folded, "logistic_regression", candidates[i], fold, balance)
        want = [model.model.intercept, *model.model.coefficients.toArray()]
        assert weights[fold][i] == pytest.approx(want, abs=2e-3)
        assert scores[i, fold] == pytest.approx(auc, abs=2e-3)
    rows, best = L.grid_search("logistic_regression", folded, GRID, balance=balance, config=config)
    assert len(rows) == 4 and all(r["folds"] == 3 for r in rows)
    assert best["mean_auc"] == pytest.approx(max(np.mean([scores[i, f] for f in range(3)]) for i in range(4)))


def test_neighbour_grid_equals_single_classifiers(folded):
    config = {k: [] for k in L.FEATURE_KINDS}
    grid = {"n_neighbors": [3, 7], "metric": ["euclidean", "manhattan", "minkowski"]}
    rows, _ = L.grid_search("knn", folded, grid, balance="none", config=config)
    got = {(r["params"]["n_neighbors"], r["params"]["metric"]): r["mean_auc"] for r in rows}
    for k, metric in ((3, "manhattan"), (7, "euclidean")):
        want = np.mean([single(folded, "knn", {"n_neighbors": k, "metric": metric}, f, "none")[1] for f in range(3)])
        assert got[k, metric] == pytest.approx(want, abs=1e-9)
    assert got[3, "euclidean"] == got[3, "minkowski"]

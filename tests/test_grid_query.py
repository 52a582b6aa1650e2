"""The query's own part of the grid search; its fits take minutes and are not run here."""
from types import SimpleNamespace

from creditecho.catalog import models
from creditecho.config import PARAM_GRIDS
from creditecho.operators.models import param_grid


def test_grid_search_asks_for_every_candidate_and_refits_the_best(spark, monkeypatch):
    table, refitted = spark.range(1), []

    def search(name, folded, grid, balance):
        rows = [{"model": name, "params": c, "mean_auc": 0.5 + i / 100, "folds": 5} for i, c in enumerate(param_grid(grid))]
        return rows, rows[3]

    def train(name, rows, params, balance):
        refitted.append((name, rows, params))
        return SimpleNamespace(predict=lambda test: spark.createDataFrame([("m", 0, 0.1), ("m", 1, 0.9)], "model string, label int, probability double"))

    monkeypatch.setattr(models, "credit_parts", lambda *_: (table, table))
    monkeypatch.setattr(models.S, "stratified_folds", lambda df: df)
    monkeypatch.setattr(models.L, "grid_search", search)
    monkeypatch.setattr(models.L, "train_model", train)
    rows = models.R.runs["grid_search"](spark, "").collect()
    every = param_grid(PARAM_GRIDS["logistic_regression"])
    assert {r.params for r in rows} == {str(c) for c in every} and len(rows) == 6
    assert refitted == [("logistic_regression", table, every[3])]
    assert [(r.params, r.refit_test_auc) for r in rows if r.refit_test_auc is not None] == [(str(every[3]), 1.0)]
    assert [r.params for r in rows if r.is_best] == [str(every[3])]

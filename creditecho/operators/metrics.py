"""Exact classification metrics over prediction tables, grouped by any keys (model, fold).

A prediction row holds ``label`` (0/1), ``prediction`` (0/1) and ``probability``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditecho.functions.numeric import share
from creditecho.functions.text import title_case
from creditecho.operators.totals import running_totals

CLS = ("accuracy", "precision", "recall", "f1_score")


def score_counts(pred: DataFrame, by: list[str] = ("model",)) -> DataFrame:
    """Rows of either class at every distinct score."""
    return pred.groupBy(*by, "probability").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )


def roc_points(pred: DataFrame, by: list[str] = ("model",)) -> DataFrame:
    """True and false positive rates at every distinct score, from the highest threshold down."""
    return _rates(score_counts(pred, by), list(by))


def _rates(per_score: DataFrame, by: list[str]) -> DataFrame:
    placed = running_totals(per_score, by, "probability", ["pos", "neg"], descending=True)
    return placed.withColumns({
        "tpr": share(F.col("pos_before") + F.col("pos"), F.col("pos_total")),
        "fpr": share(F.col("neg_before") + F.col("neg"), F.col("neg_total")),
    })


def auc_ks(pred: DataFrame, by: list[str] = ("model",)) -> DataFrame:
    """ROC-AUC with tied scores averaged, Gini and the KS statistic."""
    return auc_ks_of_counts(score_counts(pred, by), by)


def auc_ks_of_counts(per_score: DataFrame, by: list[str] = ("model",)) -> DataFrame:
    """The same from ``score_counts``."""
    points = _rates(per_score, list(by))
    won = F.col("neg").cast("double") * (F.col("pos_before") + F.col("pos") / 2)
    area = points.groupBy(*by).agg(
        F.sum(won).alias("_won"),
        F.max("pos_total").alias("_p"), F.max("neg_total").alias("_n"),
        F.max(F.col("tpr") - F.col("fpr")).alias("_ks"),
    )
    auc = F.try_divide(F.col("_won"), F.col("_p").cast("double") * F.col("_n"))
    return area.select(
        *by, auc.alias("roc_auc"), (2 * (auc - 0.5)).alias("gini"), F.greatest(F.col("_ks"), F.lit(0.0)).alias("ks_statistic")
    )


def _counts(pred: DataFrame, by) -> DataFrame:
    y, p = F.col("label"), F.col("prediction")
    return pred.groupBy(*by).agg(
        F.count("*").alias("_n"),
        F.count_if((y == 1) & (p == 1)).alias("_tp"), F.count_if((y == 0) & (p == 1)).alias("_fp"),
        F.count_if((y == 1) & (p == 0)).alias("_fn"), F.count_if((y == 0) & (p == 0)).alias("_tn"),
    )


def _or_zero(a, b):
    return F.coalesce(share(a, b), F.lit(0.0))


def cls_metrics(pred: DataFrame, by: list[str] = ("model",)) -> DataFrame:
    """Accuracy, precision, recall and F1; an undefined value is 0."""
    tp, fp, fn = F.col("_tp"), F.col("_fp"), F.col("_fn")
    return _counts(pred, by).select(
        *by,
        _or_zero(tp + F.col("_tn"), F.col("_n")).alias("accuracy"),
        _or_zero(tp, tp + fp).alias("precision"),
        _or_zero(tp, tp + fn).alias("recall"),
        _or_zero(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def confusion(pred: DataFrame, by: list[str] = ("model",)) -> DataFrame:
    """All four cells per group, zero when empty."""
    cells = F.array(*[
        F.struct(F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(c).alias("n"))
        for y, p, c in ((0, 0, "_tn"), (0, 1, "_fp"), (1, 0, "_fn"), (1, 1, "_tp"))
    ])
    return _counts(pred, by).select(*by, F.inline(cells))


def class_report(pred: DataFrame, by: list[str] = ("model",)) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages."""
    tp, fp, fn, tn, n = (F.col(c) for c in ("_tp", "_fp", "_fn", "_tn", "_n"))

    def line(name, hit, false_hit, miss):
        return {
            "name": name, "p": _or_zero(hit, hit + false_hit), "r": _or_zero(hit, hit + miss),
            "f": _or_zero(2 * hit, 2 * hit + false_hit + miss), "s": hit + miss,
        }

    zero, one = line("0", tn, fn, fp), line("1", tp, fp, fn)
    macro = {"name": "macro avg", "s": n, **{k: (zero[k] + one[k]) / 2 for k in "prf"}}
    weighted = {
        "name": "weighted avg", "s": n,
        **{k: _or_zero(zero[k] * zero["s"] + one[k] * one["s"], n) for k in "prf"},
    }
    rows = [
        F.struct(
            F.lit(x["name"]).alias("class"), x["p"].alias("precision"), x["r"].alias("recall"),
            x["f"].alias("f1_score"), x["s"].cast("long").alias("support"),
        ) for x in (zero, one, macro, weighted)
    ]
    return _counts(pred, by).select(*by, F.inline(F.array(*rows)))


def evaluate_all(pred: DataFrame, by: list[str] = ("model",)) -> DataFrame:
    """Seven metrics per group in one table."""
    return auc_ks(pred, by).join(cls_metrics(pred, by), list(by))


def compare_models(results: DataFrame) -> DataFrame:
    """Readable names, best ROC-AUC first."""
    return results.select(
        title_case(F.col("model")).alias("model"), "roc_auc", "f1_score", "accuracy", "precision", "recall"
    ).orderBy(F.col("roc_auc").desc(), "model")


def best_model(results: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """The model with the highest metric; the first name on ties."""
    top = results.filter(F.col(metric) == results.agg(F.max(metric)).scalar())
    return top.agg(F.min("model").alias("best_model"), F.max(metric).alias(metric))


def fold_scores(pred: DataFrame) -> DataFrame:
    """Long table (model, fold, metric, score) from out-of-fold predictions."""
    wide = evaluate_all(pred, ["model", "fold"]).drop("gini", "ks_statistic")
    return wide.unpivot(["model", "fold"], ["roc_auc", *CLS], "metric", "score")


def cv_summary(scores: DataFrame) -> DataFrame:
    """Mean, population deviation, minimum and maximum per model and metric."""
    return scores.groupBy("model", "metric").agg(
        F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"),
        F.min("score").alias("min"), F.max("score").alias("max"),
    ).withColumn("metric", F.upper(F.replace(F.col("metric"), F.lit("_"), F.lit(" "))))

"""Sentiment metrics from one contingency table, against plain pandas."""
import random

import pandas as pd
import pytest

from creditecho.operators import sentiment as S

SCHEMA = "query_id int, side string, score int, sentiment_label string, sentiment_score double"


def made(seed, n):
    pick = random.Random(seed)
    rows = []
    for _ in range(n):
        s = pick.choice([None, -1.0, -0.2, 0.1, 0.2, round(pick.uniform(-1, 1), 3)])
        label = None if s is None else "negative" if s < 0 else "positive" if s > 0.15 else "neutral"
        rows.append((pick.choice([1, 1, 1, 2, 3, None]), pick.choice(["a", None]), pick.choice([None, 1, 2, 3, 4, 5]), label, s))
    return rows + [(7, "a", 3, None, None), (8, "a", 3, "positive", 0.3), (9, "a", 2, "neutral", 0.1), (9, "a", 2, "neutral", 0.1), (10, "a", None, "neutral", 0.7)]


def wanted(group):
    s, pairs = group.sentiment_score, group.dropna(subset=["score", "sentiment_score"])
    x, y = pairs.score.astype(float), pairs.sentiment_score
    spread = len(pairs) > 1 and x.nunique() > 1 and y.nunique() > 1
    labels = group.sentiment_label.dropna()
    low, high = pairs[pairs.score <= 2].sentiment_score, pairs[pairs.score >= 3].sentiment_score
    return {
        "count": len(group), "sentiment_mean": s.mean(), "sentiment_std": s.std(), "sentiment_median": s.median(),
        **{f"class_ratio_{k}": (labels == k).mean() if len(labels) else None for k in S.LABELS},
        "corr_pearson_score_vs_sentiment": x.corr(y) if spread else None,
        "corr_spearman_score_vs_sentiment": x.rank().corr(y.rank()) if spread else None,
        "rate_negative_for_score_le_2": (low <= -0.2).mean() if len(low) else None,
        "rate_positive_for_score_ge_3": (high >= 0.2).mean() if len(high) else None,
    }


def test_summary_equals_pandas_with_null_groups(spark):
    rows = made(4, 3000)
    got = {(r.query_id, r.side): r.asDict() for r in S.sentiment_summary(spark.createDataFrame(rows, SCHEMA), ["query_id", "side"]).collect()}
    groups = {}
    for r in rows:
        groups.setdefault(r[:2], []).append(r[2:])
    assert set(got) == set(groups)
    for key, items in groups.items():
        want = wanted(pd.DataFrame(items, columns=["score", "sentiment_label", "sentiment_score"]).astype({"score": float, "sentiment_score": float}))
        for name, value in want.items():
            mine = got[key][name]
            if value is None or pd.isna(value):
                assert mine is None, (key, name, mine)
            else:
                assert mine == pytest.approx(value, abs=1e-9), (key, name)


def test_rates_equal_the_summary(spark):
    df = spark.createDataFrame(made(5, 400), SCHEMA)
    rates = {r.side: r.asDict() for r in S.sentiment_rates(df, ["side"], True).collect()}
    whole = {r.side: r.asDict() for r in S.sentiment_summary(df, ["side"], True).collect()}
    assert rates == {k: {c: v[c] for c in rates[k]} for k, v in whole.items()}


def test_empty_results(spark):
    assert S.sentiment_summary(spark.createDataFrame([], SCHEMA), ["query_id"]).collect() == []


def test_rows_are_scanned_once(spark, tmp_path):
    """The metrics read the written counts, never the results again."""
    spark.createDataFrame(made(6, 50), SCHEMA).write.parquet(str(tmp_path / "results"))
    out = S.sentiment_summary(spark.read.parquet(str(tmp_path / "results")), ["query_id"])
    assert all("sentiment-counts" in f for f in out.inputFiles())

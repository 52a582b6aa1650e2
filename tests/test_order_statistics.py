import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditecho.operators import describe as D
from creditecho.operators import metrics as M
from creditecho.operators import sentiment as S
from creditecho.operators import splits as P
from creditecho.operators import totals as O


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.just(7.0), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=200))
def test_quantiles_equal_linear_interpolation(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = O.exact_quantiles(df, ["x"], [0.2, 0.5, 0.75]).first()["q"]
    assert got == pytest.approx(list(np.quantile(values, [0.2, 0.5, 0.75])), rel=1e-9, abs=1e-9)


def test_ranks_with_a_hot_score_equal_row_number(spark):
    random.seed(3)
    rows = [(i, i % 2, 5.0 if i % 3 else random.random() * 10) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g int, s double")
    want = F.row_number().over(W.partitionBy("g").orderBy(F.desc("s"), "id"))
    both = O.ranked(df, ["g"], "s", "id").withColumn("want", want)
    assert both.filter("rank <> want").count() == 0 and both.count() == 3000
    assert O.top_ranked(df, ["g"], "s", "id", 5).count() == 10


def test_average_ranks(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1), (2.0, 1), (3.0, 1)], "v double, one int")
    got = {r.v: r.r for r in O.average_ranks(df, [], "v", "one", "r").collect()}
    assert got == {1.0: 1.0, 2.0: 2.5, 3.0: 4.0}


def test_histogram_keeps_the_maximum_in_the_last_bin(spark):
    df = spark.createDataFrame([(0.0, 0), (19.0, 1), (18.9, 1), (None, 0)], "x double, default_flag int")
    got = {(r.bin, r.default_flag): r.n for r in D.histogram_by_target(df, ["x"]).collect()}
    assert got == {(1, 0): 1, (19, 1): 2}


def test_repeated_targets_are_listed_once(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 1), (4.0, 1)], "x double, default_flag int")
    pairs = D.correlation_matrix(df).collect()
    assert len(pairs) == 4 and len({(r.a, r.b) for r in pairs}) == 4


def test_auc_is_symmetric_and_counts_ties(spark):
    rows = [("m", 1, 0.9), ("m", 0, 0.9), ("m", 1, 0.4), ("m", 0, 0.1)]
    df = spark.createDataFrame(rows, "model string, label int, probability double")
    one = M.auc_ks(df).first()
    flipped = M.auc_ks(df.withColumn("probability", 1 - F.col("probability"))).first()
    assert one.roc_auc == pytest.approx(0.625) and flipped.roc_auc == pytest.approx(0.375)
    assert one.gini == pytest.approx(0.25) and one.ks_statistic == pytest.approx(0.5)


def test_undefined_metrics_are_zero(spark):
    df = spark.createDataFrame([("m", 1, 0), ("m", 0, 0)], "model string, label int, prediction int")
    row = M.cls_metrics(df).first()
    assert (row.accuracy, row.precision, row.recall, row.f1_score) == (0.5, 0.0, 0.0, 0.0)
    assert {(r.label, r.prediction): r.n for r in M.confusion(df).collect()} == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_splits_and_folds_are_complete_and_stratified(spark):
    df = spark.range(1003).withColumn("default_flag", (F.col("id") % 10 == 0).cast("int"))
    test = P.stratified_split(df)
    counts = {(r.default_flag, r.is_test): r["count"] for r in test.groupBy("default_flag", "is_test").count().collect()}
    assert counts == {(0, True): 180, (0, False): 722, (1, True): 20, (1, False): 81}
    sizes = P.stratified_folds(df).groupBy("default_flag", "fold").count().collect()
    assert {r.fold for r in sizes} == set(range(5)) and sum(r["count"] for r in sizes) == 1003
    for y in (0, 1):
        n = [r["count"] for r in sizes if r.default_flag == y]
        assert max(n) - min(n) <= 1
    places = P.stratified_positions(df).filter("default_flag = 1").select("position").collect()
    assert sorted(r[0] for r in places) == list(range(1, 102))


def test_sentiment_rates_leave_nulls_out_by_default(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "negative", -0.5), (1, 1.0, "positive", 0.5), (1, 1.0, None, None)],
        "query_id int, score double, sentiment_label string, sentiment_score double",
    )
    row = S.sentiment_summary(df).first()
    assert row.rate_negative_for_score_le_2 == 0.5 and row.class_ratio_negative == 0.5
    assert row.corr_pearson_score_vs_sentiment is None and row.corr_spearman_score_vs_sentiment is None
    row = S.sentiment_summary(df, null_as_neutral=True).first()
    assert row.rate_negative_for_score_le_2 == pytest.approx(1 / 3)


def test_label_values(spark):
    sets = {
        "stars": ["1 star", "2 stars", "3 stars", "4 stars", "5 stars"], "two": ["negative", "positive"],
        "three": ["LABEL_0", "LABEL_1", "LABEL_2"], "four": ["LABEL_0", "LABEL_1", "LABEL_2", "LABEL_3"], "plain": ["no", "yes"],
    }
    rows = [(n, i, v) for n, vs in sets.items() for i, v in enumerate(vs)]
    out = S.label_values(spark.createDataFrame(rows, "label_set string, class_id int, label string")).collect()
    got = {n: [r.value for r in sorted(out, key=lambda r: r.class_id) if r.label_set == n] for n in sets}
    assert got["stars"] == [-1.0, -0.5, 0.0, 0.5, 1.0] and got["two"] == [-1.0, 1.0] and got["three"] == [-1.0, 0.0, 1.0]
    assert got["four"] == pytest.approx([-1, -1 / 3, 1 / 3, 1]) and got["plain"] == [-1.0, 1.0]


def test_ranks_shuffle_the_rows_once(spark, capsys):
    df = spark.range(4000).selectExpr("id", "id % 3 AS g", "double(id * 7919 % 1000) AS s")
    both = O.ranked(df, ["g"], "s", "id")
    both.explain("formatted")
    plan = capsys.readouterr().out.split("== Initial Plan ==")[0].split("(1) ")[0]
    assert plan.count("Exchange hashpartitioning") + plan.count("- Exchange") == 1 and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    want = {(r.g, r.id): r.want for r in df.selectExpr("g", "id", "row_number() OVER (PARTITION BY g ORDER BY s DESC, id) AS want").collect()}
    assert {(r.g, r.id): r["rank"] for r in both.collect()} == want

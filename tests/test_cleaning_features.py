import datetime as dt

import pytest
from pyspark.sql import functions as F

from creditecho.operators import cleaning as C
from creditecho.operators import features as X
from creditecho.sources import readers

LOAN = (
    "id long, member_id long, loan_amnt double, funded_amnt double, funded_amnt_inv double, total_pymnt double, "
    "total_pymnt_inv double, last_pymnt_amnt double, emp_length string, emp_title string, delinq_2yrs long, default_flag int"
)


def test_caps_follow_their_order_and_ignore_null(spark):
    df = spark.createDataFrame([(1, 1, 10.0, 12.0, 11.0, 5.0, None, 9.0, "x", None, None, 0)], LOAN)
    row = C.clamp_business(df).first()
    assert (row.loan_amnt, row.funded_amnt, row.funded_amnt_inv) == (10.0, 10.0, 10.0)
    assert (row.total_pymnt_inv, row.last_pymnt_amnt) == (None, 5.0)
    assert tuple(C.clamp_violations(df).first()) == (1, 1, 0, 1)


def test_clean_loans_converts_fills_and_drops(spark):
    rows = [
        (1, 1, 10.0, 1.0, 1.0, 1.0, 1.0, 1.0, " 10+ years ", None, None, 0),
        (2, 2, 20.0, 1.0, 1.0, 1.0, 1.0, 1.0, "n/a", "a", 3, 1),
        (3, 3, None, 1.0, 1.0, 1.0, 1.0, 1.0, None, "b", 0, 0),
        (4, 4, 40.0, 1.0, 1.0, 1.0, 1.0, 1.0, "< 1 year", "b", 0, 0),
    ]
    out = C.clean_loans(spark.createDataFrame(rows, LOAN))
    assert out.removed == ["id", "member_id"] and "id" not in out.data.columns
    got = {r.loan_amnt: r for r in out.data.collect()}
    assert got[10.0].emp_length == 10.0 and got[10.0].emp_title == "Unknown" and got[10.0].delinq_2yrs == 0
    assert [r.emp_length for r in out.data.collect() if r.delinq_2yrs == 3] == [5.0]
    assert sorted(got) == [10.0, 20.0, 40.0]  # the missing amount took the median 20


def test_latest_row_per_id(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    df = spark.createDataFrame([(1, t1), (1, t2), (1, None), (2, None)], "id long, timestamp timestamp")
    assert {r.id: r.timestamp for r in C.latest_per_id(df).collect()} == {1: t2, 2: None}
    assert {r.id: r.timestamp for r in C.latest_per_id(df, null_wins=True).collect()} == {1: None, 2: None}


def test_clean_reviews_drops_bad_rows_and_keeps_null_titles(spark):
    rows = [
        ("1", "5", None, "good text", "2024-01-02 00:00:00"), ("2", "9", "t", "good text", None),
        ("x", "5", "t", "good text", None), ("3", "4", "t", None, None), ("4", "4", "t", "abc", None),
        ("5", "1", "t", "late text", "not a date"),
    ]
    df = spark.createDataFrame(rows, "id string, score string, title string, feedback string, timestamp string")
    got = [(r.id, r.title) for r in C.clean_reviews(df).collect()]
    assert got == [(1, None), (5, "t")]


def test_review_columns_are_found_by_any_case(spark):
    df = spark.createDataFrame([(1, 2.0, "a", "b", None)], "ID long, Score double, TITLE string, feedback string, Timestamp timestamp")
    assert readers.pick_review_columns(df).columns == ["id", "score", "title", "feedback", "timestamp"]
    with pytest.raises(ValueError, match="title"):
        readers.pick_review_columns(df.drop("TITLE"))
    with pytest.raises(ValueError, match="feedback"):
        readers.require_columns(df.select("ID"))
    with pytest.raises(ValueError, match="spreadsheet"):
        readers.read_by_suffix(spark, "/tmp/x.xlsx")


FULL = (
    "loan_amnt double, installment double, annual_inc double, delinq_2yrs long, open_acc long, total_acc long, tot_coll_amt double, "
    "tot_cur_bal double, total_rev_hi_lim double, emp_length int, term int, emp_title string"
)


def test_zero_limits_in_ratios_and_indicators(spark):
    df = spark.createDataFrame([
        (1.0, 1.0, -5.0, 0, 1, 2, 0.0, 5.0, 0.0, 1, 36, "abc"), (2000.0, 1.0, 10.0, 2, 0, 0, 1.0, 0.0, 0.0, None, 60, None),
    ], FULL)
    a, b = X.engineer_features(df).orderBy("loan_amnt").collect()
    assert (a.balance_to_limit, a.high_utilization, a.low_utilization) == (None, 1, 0)
    assert (b.balance_to_limit, b.high_utilization, b.low_utilization) == (None, 0, 0)
    assert (a.income_log, a.income_sqrt) == (None, None)
    assert (b.is_loan_amnt_rounded, b.long_employment, b.emp_title_length) == (1, 0, None)
    assert len([c for c in a.asDict()]) == 12 + 98


def test_features_with_missing_inputs_are_skipped_and_own_stats_are_used(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 6)], "annual_inc double")
    assert X.skipped_features(df, ["lti", "income_log"]) == ["lti"]
    other = spark.createDataFrame([(100.0,), (200.0,)], "annual_inc double")
    stats = X.fit_stats(other, ["annual_inc"])
    assert [r.high_income for r in X.engineer_features(df, ["high_income"], stats).collect()] == [0] * 5
    extra = X.engineer_features(df, ["twice"], extra={"twice": lambda: F.col("annual_inc") * 2})
    assert [r.twice for r in extra.collect()] == [2.0, 4.0, 6.0, 8.0, 10.0]
    kept, missing = X.select_features(df, ["annual_inc", "lti"])
    assert kept.columns == ["annual_inc"] and missing == ["lti"]

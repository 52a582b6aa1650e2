"""A cross-section of registered queries against DuckDB; tests/check.py runs all of them."""
import pytest
from check import DATA, difference, duck

import __spark_entry__ as entry

NAMES = [
    "clean_data", "num_by_target", "cat_by_target", "hist_by_target", "feat_balance_to_limit", "feat_inc_group_low", "split_stratified",
    "encode_target", "evaluate_all", "clean_reviews", "tok_lemma", "top_terms", "sentiment_agg", "bm25_topk", "knn_exact", "search_hybrid",
    "eval_queries", "ml_knn",
]


@pytest.fixture(scope="module")
def con():
    return duck("0.001")


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_duckdb(spark, con, name):
    df = entry.queries()[name](spark, f"{DATA}/sf0.001")
    assert difference(df, con, entry.oracle_sql()[name]) is None


def test_registry_is_consistent():
    runs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(runs) and len([n for n in runs if n.startswith("feat_")]) == 98


def test_flagship_query_runs(spark):
    assert entry.entry(spark).count() > 0

"""Range numbers of many ranges: right at limits and for NULL, and compiled instead of a lambda for every row."""
from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from creditecho.operators import totals


def test_many_ranges_are_compiled_and_right(spark, monkeypatch):
    monkeypatch.setattr(totals, "range_count", lambda session: 200)
    limits = [float(x) for x in range(0, 398, 2)]
    values = [None, -1.0, 0.0, 0.5, 2.0, 133.0, 396.0, 397.5, 1e9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = totals.with_range(df, F.col("v"), F.array(*[F.lit(x) for x in limits]), "r")
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
    want = {v: 0 if v is None else int(np.searchsorted(limits, v, "right")) for v in values}
    assert {r["v"]: r["r"] for r in found.collect()} == want


def test_ranks_of_hot_scores_in_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(totals, "range_count", lambda session: 200)
    rows = [(i % 3, float(i % 7 if i % 2 else 5), i) for i in range(3000)]
    found = totals.ranked(spark.createDataFrame(rows, "g int, s double, t long"), ["g"], "s", "t").collect()
    want = {}
    for g in range(3):
        for at, (_, s, t) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2])), 1):
            want[t] = at
    assert {r["t"]: r["rank"] for r in found} == want


def test_tokens_are_compiled(spark):
    from creditecho.functions.text import tokens

    found = spark.createDataFrame([(" A b--c ",), ("",), (None,), ("x",)], "t string").select(tokens(F.col("t")).alias("w"))
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [r["w"] for r in found.collect()] == [["a", "b", "c"], [], [], ["x"]]

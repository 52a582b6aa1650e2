"""Exact order statistics without a single-task sort.

Ranks, running totals and quantiles over a whole table are global orders. Each one is computed in two
levels: rows go into value ranges whose limits come from an approximate sketch (limits only decide
balance, never results), totals per range give offsets, and the exact order is taken inside a range.
"""
from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditecho.operators.joins import is_small
from creditecho.session import stored


def range_count(spark: SparkSession) -> int:
    return max(16, min(4096, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def range_limits(df: DataFrame, value: Column, ranges: int) -> Column:
    """Sorted sketch quantiles of a value as one scalar subquery."""
    levels = [i / ranges for i in range(1, ranges)]
    sketch = F.percentile_approx("_v", levels, 10000).alias("_limits")
    limits = df.select(value.alias("_v")).agg(sketch)
    return limits.select(F.array_distinct("_limits")).scalar()


def _with_count_up_to(df: DataFrame, limits: Column, v: Column, ranges: int, name: str) -> DataFrame:
    """Adds how many sorted limits are <= v (0 for NULL): plain comparisons for few ranges, halving steps for many.

    A step is a projection of its own, so that all of them are compiled; a lambda over the steps would be interpreted for every row.
    """
    if ranges <= 64:
        tests = [F.when(F.get(limits, F.lit(i)) <= v, F.lit(1)).otherwise(F.lit(0)) for i in range(ranges - 1)]
        return df.withColumn(name, reduce(add, tests))
    steps, step = [], 1
    while step < ranges:
        steps.insert(0, step)
        step *= 2
    out, at = df.withColumn(name, F.lit(0)), F.col(name)
    for x in steps:
        out = out.withColumn(name, F.when(F.get(limits, at + (x - 1)) <= v, at + x).otherwise(at))
    return out


def with_range(df: DataFrame, value: Column, limits: Column, name: str, at_limit: str | None = None) -> DataFrame:
    """Adds the range number of a value; with ``at_limit`` a value equal to a limit gets its own range."""
    ranges = range_count(df.sparkSession)
    out = df.withColumn("_limits", limits)
    out = _with_count_up_to(out, F.col("_limits"), value, ranges, name)
    if at_limit:
        equal = F.coalesce(F.get(F.col("_limits"), F.col(name) - 1) == value, F.lit(False))
        out = out.withColumn(at_limit, equal)
        out = out.withColumn(name, 2 * F.col(name) - F.col(at_limit).cast("int"))
    return out.drop("_limits")


def running_totals(df: DataFrame, by: list[str], order: str, sums: list[str], descending: bool = False) -> DataFrame:
    """Adds ``<s>_before`` (total of smaller keys) and ``<s>_total`` per group.

    ``df`` holds one row per (group, order key); aggregate first, so a hot value is one row.
    """
    key = -F.col(order) if descending else F.col(order)
    keyed = df.withColumn("_key", key)
    limits = range_limits(keyed, F.col("_key"), range_count(df.sparkSession))
    ranged = with_range(keyed, F.col("_key"), limits, "_range")
    part = by + ["_range"]
    per_range = ranged.groupBy(*part).agg(*[F.sum(s).alias(f"_r_{s}") for s in sums])
    w = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    earlier = w.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_range.select(
        *part,
        *[F.coalesce(F.sum(f"_r_{s}").over(earlier), F.lit(0)).alias(f"_o_{s}") for s in sums],
        *[F.sum(f"_r_{s}").over(w).alias(f"{s}_total") for s in sums],
    )
    within = W.partitionBy(*part).orderBy("_key").rowsBetween(W.unboundedPreceding, -1)
    joined = null_safe_join(ranged, offsets, part)
    before = {
        f"{s}_before": F.col(f"_o_{s}") + F.coalesce(F.sum(s).over(within), F.lit(0)) for s in sums
    }
    return joined.withColumns(before).drop("_key", "_range", *[f"_o_{s}" for s in sums])


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Joins on keys that may be NULL; the keys of the right side are dropped."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_k_{k}")
    condition = None
    for k in keys:
        test = left[k].eqNullSafe(renamed[f"_k_{k}"])
        condition = test if condition is None else condition & test
    return left.join(renamed, condition, how).drop(*[f"_k_{k}" for k in keys])


def unpivoted(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Long form (by..., feature, value) with values as doubles."""
    cast = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    return cast.unpivot(list(by), list(columns), "feature", "value")


def exact_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], by: list[str] = (), few_groups: bool = True
) -> DataFrame:
    """Linear-interpolated quantiles: one row per (by..., feature) with an array ``q``.

    Only the value ranges that hold a wanted position are shuffled and ordered. ``few_groups`` states
    that ``by`` has few distinct values (a class, a fold), so the wanted ranges can be broadcast.
    """
    by = list(by)
    group = by + ["feature"]
    long = unpivoted(df, columns, by).filter(F.col("value").isNotNull())
    limits = range_limits(long, F.col("value"), range_count(df.sparkSession))
    ranged = with_range(long, F.col("value"), limits, "_range", at_limit="_hot").drop("_hot")

    positions = [F.lit(float(p)) * (F.col("_total") - 1) for p in probs]

    def hits(first: Column, last: Column) -> Column:
        test = F.lit(False)
        for p in positions:
            test = test | F.floor(p).between(first, last) | F.ceil(p).between(first, last)
        return test

    w = W.partitionBy(*group)
    per_range = ranged.groupBy(*group, "_range").agg(F.count("*").alias("_n"))
    per_range = per_range.withColumns({
        "_total": F.sum("_n").over(w),
        "_before": F.coalesce(
            F.sum("_n").over(w.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ),
    })
    wanted = per_range.filter(hits(F.col("_before"), F.col("_before") + F.col("_n") - 1)).drop("_n")
    if few_groups:
        wanted = F.broadcast(wanted)
    rows = null_safe_join(ranged, wanted, group + ["_range"])
    counts = rows.groupBy(*group, "_range", "_total", "_before", "value").agg(F.count("*").alias("_n"))
    inside = W.partitionBy(*group, "_range").orderBy("value").rowsBetween(W.unboundedPreceding, -1)
    first = F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    placed = counts.withColumn("_first", first).withColumn("_last", F.col("_first") + F.col("_n") - 1)
    picks = []
    for i, p in enumerate(positions):
        at_low = F.floor(p).between(F.col("_first"), F.col("_last"))
        at_high = F.ceil(p).between(F.col("_first"), F.col("_last"))
        picks += [
            F.max(F.when(at_low, F.col("value"))).alias(f"_lo{i}"),
            F.max(F.when(at_high, F.col("value"))).alias(f"_hi{i}"),
            F.max(p - F.floor(p)).alias(f"_f{i}"),
        ]
    picked = placed.groupBy(*group).agg(*picks)
    values = [
        F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}") for i in range(len(probs))
    ]
    return picked.select(*group, F.array(*values).alias("q"))


def quantile_struct(df: DataFrame, columns: list[str], probs: list[float], names: list[str]) -> DataFrame:
    """One row with one struct column per feature, ready to be stored or used as a scalar."""
    long = exact_quantiles(df, columns, probs)
    structs = []
    for c in columns:
        q = F.max(F.when(F.col("feature") == c, F.col("q")))
        structs.append(F.struct(*[F.get(q, F.lit(i)).alias(n) for i, n in enumerate(names)]).alias(c))
    return long.agg(*structs)


def average_ranks(df: DataFrame, by: list[str], value: str, weight: str, name: str) -> DataFrame:
    """One row per (by..., value) with its tie-averaged rank among ``weight`` copies."""
    distinct = df.groupBy(*by, value).agg(F.sum(weight).alias("n"))
    placed = running_totals(distinct, by, value, ["n"])
    return placed.select(
        *by, value, (F.col("n_before") + (F.col("n") + 1) / 2).alias(name), F.col("n_total").alias(f"{name}_n")
    )


def ranked(df: DataFrame, by: list[str], score: str, tie: str, name: str = "rank") -> DataFrame:
    """Exact row number by (score desc, tie asc) for groups of any size.

    Rows equal to a sketch limit (a hot score) are split further by ranges of the tie key. Rows are written once with their ranges, shuffled
    once for their order inside a range, and get the offset of the range by a join that is a broadcast where the ranges were counted to be few.
    """
    ranges = range_count(df.sparkSession)
    keyed = df.withColumn("_key", -F.col(score).cast("double"))
    keyed = with_range(
        keyed, F.col("_key"), range_limits(keyed, F.col("_key"), ranges), "_r1", at_limit="_hot"
    )
    tie_limits = range_limits(df, F.col(tie).cast("double"), ranges)
    of_hot = F.when(F.col("_hot"), F.col(tie).cast("double"))  # only rows of a hot score are dealt by their tie key
    keyed = _with_count_up_to(keyed.withColumn("_limits", tie_limits), F.col("_limits"), of_hot, ranges, "_r2")
    keyed = stored(keyed.drop("_hot", "_limits"), "ranked-rows")
    part = by + ["_r1", "_r2"]
    per_range = keyed.groupBy(*part).agg(F.count("*").alias("_n"))
    w = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    earlier = w.orderBy("_r1", "_r2").rowsBetween(W.unboundedPreceding, -1)
    offsets = stored(per_range.select(*part, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_o")), "ranked-offsets")
    inside = F.row_number().over(W.partitionBy(*part).orderBy("_key", tie))
    placed = keyed.withColumn("_inside", inside)
    joined = null_safe_join(placed, F.broadcast(offsets) if is_small(offsets) else offsets, part)
    return joined.withColumn(name, (F.col("_o") + F.col("_inside")).cast("long")).drop("_key", "_r1", "_r2", "_o", "_inside")


def top_ranked(df: DataFrame, by: list[str], score: str, tie: str, k: int, name: str = "rank") -> DataFrame:
    """First k rows per group; ``k <= 0`` ranks every row.

    A bounded k is a ``row_number() <= k`` filter, which Spark cuts in every task before the shuffle.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if k <= 0 or k > limit:
        out = ranked(df, by, score, tie, name)
        return out.filter(F.col(name) <= k) if k > 0 else out
    w = W.partitionBy(*by).orderBy(F.col(score).desc(), F.col(tie))
    return df.withColumn(name, F.row_number().over(w).cast("long")).filter(F.col(name) <= k)

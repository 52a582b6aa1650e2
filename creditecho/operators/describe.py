"""Class-conditional statistics, correlations, outliers and histograms of the loan table."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditecho.functions.numeric import safe_corr, share
from creditecho.operators.cleaning import numeric_columns
from creditecho.operators.totals import exact_quantiles, unpivoted

BINS = 19


def _rows(columns: list[Column]) -> Column:
    """Turns a list of struct aggregates into rows."""
    return F.inline(F.array(*columns))


def _features(df: DataFrame, target: str, features) -> list[str]:
    chosen = features if features is not None else numeric_columns(df)
    return list(dict.fromkeys(c for c in chosen if c in df.columns and c != target))


def dataset_overview(df: DataFrame, target: str = "default_flag") -> DataFrame:
    y = F.col(target)
    return df.agg(
        F.count("*").alias("total_records"),
        F.lit(len(df.columns) - 1).alias("total_features"),
        F.sum(y).alias("default_count"),
        F.count_if(y == 0).alias("non_default_count"),
        (F.avg(y) * 100).alias("default_rate"),
        ((1 - F.avg(y)) * 100).alias("non_default_rate"),
    )


def target_counts(df: DataFrame, target: str = "default_flag") -> DataFrame:
    """Class counts with percentages; one scan, the total comes from the counts."""
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("_total"))
    return counts.withColumn("percentage", 100 * share(F.col("n"), total.scalar()))


def numeric_by_target(df: DataFrame, target: str = "default_flag", features=None) -> DataFrame:
    """Mean, median and sample deviation per class with the standardised difference of means."""
    names = _features(df, target, features)
    y = F.col(target)
    stats = []
    for c in names:
        x0, x1 = F.when(y == 0, F.col(c).cast("double")), F.when(y == 1, F.col(c).cast("double"))
        stats.append(F.struct(
            F.lit(c).alias("feature"),
            F.avg(x0).alias("non_default_mean"), F.avg(x1).alias("default_mean"),
            F.stddev_samp(x0).alias("non_default_std"), F.stddev_samp(x1).alias("default_std"),
        ))
    moments = df.agg(F.array(*stats).alias("_s")).select(F.inline("_s"))
    medians = exact_quantiles(df.filter(y.isin(0, 1)), names, [0.5], [target])
    wide = medians.groupBy("feature").agg(
        F.max(F.when(y == 0, F.get("q", F.lit(0)))).alias("non_default_median"),
        F.max(F.when(y == 1, F.get("q", F.lit(0)))).alias("default_median"),
    )
    gap = F.col("default_mean") - F.col("non_default_mean")
    effect = F.when(F.col("non_default_std") > 0, F.try_divide(gap, F.col("non_default_std"))).otherwise(F.lit(0.0))
    return (
        moments.join(wide, "feature", "left").withColumn("effect_size", effect)
        .orderBy(F.abs("effect_size").desc_nulls_last(), "feature")
    )


def categorical_by_target(df: DataFrame, feature: str, target: str = "default_flag") -> DataFrame:
    """Class counts per category with an ``All`` row and the default rate in percent."""
    known = df.filter(F.col(feature).isNotNull())
    out = known.rollup(feature).agg(
        F.grouping(feature).alias("_all"),
        F.count_if(F.col(target) == 0).alias("n_non_default"),
        F.count_if(F.col(target) == 1).alias("n_default"),
        F.count("*").alias("n_all"),
    )
    return out.select(
        F.when(F.col("_all") == 1, "All").otherwise(F.col(feature).cast("string")).alias("category"),
        "n_non_default", "n_default", "n_all",
        F.round(100 * share(F.col("n_default"), F.col("n_all")), 2).alias("default_rate"),
    )


def correlation_matrix(df: DataFrame, features=None, target: str | None = "default_flag") -> DataFrame:
    """Every ordered pair (a, b, corr) over complete pairs, from one scan: a task adds up one matrix of co-moments per batch, with masks
    for missing values, and sends a row per pair once; these are merged per pair, so the order of rows does not matter beyond rounding."""
    names = _features(df, target or "", features) + ([target] if target in df.columns else [])
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]

    def moments(batches):
        total = None
        for batch in batches:
            x = np.column_stack([np.asarray(c.cast("double").to_numpy(zero_copy_only=False), float) for c in batch.columns])
            total = merged(total, co_moments(x))
        if total is not None:
            rows = [(names[i], names[j], *(float(m[i, j]) for m in total)) for i, j in pairs]
            yield pa.RecordBatch.from_pydict(dict(zip(MOMENTS, zip(*rows))))

    def merge(table):
        total = None
        columns = [np.asarray(table.column(c)) for c in MOMENTS[2:]]
        for part in zip(*columns):
            total = merged(total, part)
        n, _, _, xx, yy, xy = total
        corr = float(xy / np.sqrt(xx * yy)) if n >= 2 and xx / n > 1e-24 and yy / n > 1e-24 else None
        return pa.table({"a": table.column("a").slice(0, 1), "b": table.column("b").slice(0, 1), "corr": pa.array([corr], pa.float64())})

    fields = ", ".join(f"{c} {'string' if c in 'ab' else 'double'}" for c in MOMENTS)
    parts = df.select(*names).mapInArrow(moments, fields)
    half = parts.groupBy("a", "b").applyInArrow(merge, "a string, b string, corr double")
    sides = F.array(
        F.struct(F.col("a").alias("a"), F.col("b").alias("b")),
        F.when(F.col("a") != F.col("b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))),
    )
    both = half.withColumn("_p", F.explode(F.filter(sides, lambda p: p.isNotNull())))
    return both.select(F.col("_p.a").alias("a"), F.col("_p.b").alias("b"), "corr")


MOMENTS = ("a", "b", "n", "mean_x", "mean_y", "xx", "yy", "xy")


def co_moments(x: np.ndarray) -> tuple[np.ndarray, ...]:
    """(n, mean_x, mean_y, xx, yy, xy) as matrices over column pairs; each pair uses the rows where both are present."""
    here = ~np.isnan(x)
    mask = here.astype(float)
    pivot = np.where(here.any(axis=0), np.nanmean(np.where(here.any(axis=0), x, 0), axis=0), 0)
    d = np.where(here, x - pivot, 0)
    n = mask.T @ mask
    safe = np.maximum(n, 1)
    sx, sxx = d.T @ mask, (d * d).T @ mask
    mx, my = sx / safe, sx.T / safe
    return n, mx + pivot[:, None], my + pivot[None, :], sxx - n * mx * mx, sxx.T - n * my * my, d.T @ d - n * mx * my


def merged(a, b):
    """Co-moments of two sets of rows together."""
    if a is None:
        return b
    n = a[0] + b[0]
    dx, dy, w = b[1] - a[1], b[2] - a[2], a[0] * b[0] / np.maximum(n, 1)
    share = b[0] / np.maximum(n, 1)
    return n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + dx * dx * w, a[4] + b[4] + dy * dy * w, a[5] + b[5] + dx * dy * w


def correlation_with_target(df: DataFrame, features=None, target: str = "default_flag") -> DataFrame:
    names = _features(df, target, features)
    y = F.col(target).cast("double")
    structs = [
        F.struct(F.lit(c).alias("feature"), safe_corr(F.col(c).cast("double"), y).alias("corr")) for c in names
    ]
    rows = df.agg(F.array(*structs).alias("_s")).select(F.inline("_s"))
    return rows.orderBy(F.abs("corr").desc_nulls_last(), "feature")


def iqr_outliers(df: DataFrame, feature: str, key: str = "id", target: str = "default_flag") -> DataFrame:
    """Rows outside 1.5 interquartile ranges of their own class."""
    q = exact_quantiles(df, [feature], [0.25, 0.75], [target])
    q1, q3 = F.get("q", F.lit(0)), F.get("q", F.lit(1))
    bounds = q.select(
        F.col(target).alias("_class"),
        (q1 - 1.5 * (q3 - q1)).alias("lower_bound"), (q3 + 1.5 * (q3 - q1)).alias("upper_bound"),
    )
    joined = df.select(key, target, feature).join(F.broadcast(bounds), F.col(target) == F.col("_class"))
    x = F.col(feature)
    return joined.filter((x < F.col("lower_bound")) | (x > F.col("upper_bound"))).drop("_class")


def histogram_by_target(df: DataFrame, features, target: str = "default_flag", bins: int = BINS) -> DataFrame:
    """Counts per class in equal bins over the joint range; the last bin is closed."""
    names = list(features)
    long = unpivoted(df, names, [target]).filter(F.col("value").isNotNull())
    limits = df.agg(F.array(*[
        F.struct(
            F.lit(c).alias("_feature"),
            F.min(F.col(c).cast("double")).alias("_lo"), F.max(F.col(c).cast("double")).alias("_hi"),
        ) for c in names
    ]).alias("_s")).select(F.inline("_s"))
    joined = long.join(F.broadcast(limits), F.col("feature") == F.col("_feature"))
    bucket = F.width_bucket(F.col("value"), F.col("_lo"), F.col("_hi"), F.lit(bins))
    return (
        joined.withColumn("bin", F.least(bucket, F.lit(bins)))
        .groupBy("feature", "bin", target).agg(F.count("*").alias("n"))
    )


def distribution_by_target(
    df: DataFrame, features, target: str = "default_flag", probs=(0.05, 0.25, 0.5, 0.75, 0.95)
) -> DataFrame:
    """Mean and a grid of quantiles per class and feature."""
    names = list(features)
    grid = exact_quantiles(df, names, list(probs), [target])
    means = unpivoted(df, names, [target]).groupBy(target, "feature").agg(F.avg("value").alias("mean"))
    columns = [F.get("q", F.lit(i)).alias(f"p{round(p * 100):02d}") for i, p in enumerate(probs)]
    return means.join(grid, [target, "feature"]).select(target, "feature", "mean", *columns)


def eda_summary(df: DataFrame, numeric, categorical, target: str = "default_flag") -> dict[str, DataFrame]:
    return {
        "overview": dataset_overview(df, target),
        "numerical": numeric_by_target(df, target, numeric),
        **{f"categorical_{c}": categorical_by_target(df, c, target) for c in categorical},
        "correlation": correlation_matrix(df, numeric, target),
    }


def eda_summary_frame(df: DataFrame, numeric, categorical, target: str = "default_flag") -> DataFrame:
    """The summary as one long table (section, item, value)."""
    parts = eda_summary(df, numeric, categorical, target)
    flat = [
        parts["numerical"].select(F.lit("effect_size").alias("section"), F.col("feature").alias("item"), F.col("effect_size").alias("value")),
        parts["correlation"].select(F.lit("correlation"), F.concat_ws("~", "a", "b"), "corr"),
    ]
    overview = parts["overview"].select(*[F.col(c).cast("double") for c in parts["overview"].columns])
    flat.append(overview.unpivot([], overview.columns, "item", "value").select(F.lit("overview"), "item", "value"))
    for c in categorical:
        flat.append(parts[f"categorical_{c}"].select(F.lit(c), "category", "default_rate"))
    out = flat[0]
    for part in flat[1:]:
        out = out.union(part)
    return out

"""Imputers, scaler and encoders. Each ``fit_*`` reads the training part once; the result is a small table."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditecho.functions.numeric import share
from creditecho.operators.joins import lookup_join
from creditecho.operators.totals import exact_quantiles

MAX_CATEGORIES = 10_000
TARGET_MIN_ROWS = 20.0
TARGET_WIDTH = 10.0


def fit_numeric(train: DataFrame, columns: list[str]) -> dict[str, dict[str, float]]:
    """Median, and mean and population deviation after median filling, per column."""
    medians = {r["feature"]: r["q"][0] for r in exact_quantiles(train, columns, [0.5]).collect()}
    stats = []
    for c in columns:
        x = F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c)).cast("double"))
        stats.append(F.struct(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std")).alias(c))
    row = train.agg(*stats).first()
    return {
        c: {"median": medians.get(c), "mean": row[c]["mean"], "std": row[c]["std"] or 1.0} for c in columns
    }


def impute(column: str, value) -> Column:
    return F.coalesce(F.col(column), F.lit(value))


def mode_table(train: DataFrame, column: str) -> DataFrame:
    """Most frequent known value; the smallest one on ties."""
    counts = train.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    best = counts.agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(column).alias("v"))).alias("_b"))
    return best.select(F.col("_b.v").alias(column))


def impute_mode(df: DataFrame, train: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), mode_table(train, column).scalar()))


def impute_median(df: DataFrame, train: DataFrame, columns: list[str]) -> DataFrame:
    from creditecho.operators.cleaning import fill_median, fit_medians

    return fill_median(df, columns, fit_medians(train, columns))


def scale_standard(df: DataFrame, train: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / population deviation of the training part; a zero deviation counts as 1."""
    moments = train.agg(*[
        F.struct(F.avg(F.col(c).cast("double")).alias("m"), F.stddev_pop(F.col(c).cast("double")).alias("s")).alias(c)
        for c in columns
    ])
    out = df.withColumn("_m", moments.select(F.struct(*columns)).scalar())
    scaled = {}
    for c in columns:
        s = F.when(F.col("_m")[c]["s"] == 0, F.lit(1.0)).otherwise(F.col("_m")[c]["s"])
        scaled[c] = F.try_divide(F.col(c) - F.col("_m")[c]["m"], s)
    return out.withColumns(scaled).drop("_m")


def sorted_categories(train: DataFrame, column: str, limit: int = MAX_CATEGORIES) -> list:
    """Distinct known values in order; refuses a column too wide for a category encoder."""
    rows = train.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} categories; use the target encoder")
    return [r[0] for r in rows]


def encode_ordinal(column: str, categories: list) -> Column:
    """Position among the sorted categories; -1 for unseen or missing values."""
    if not categories:
        return F.lit(-1.0)
    pairs = [F.lit(x) for i, c in enumerate(categories) for x in (c, float(i))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(column)), F.lit(-1.0))


def encode_onehot(column: str, categories: list) -> dict[str, Column]:
    """One 0/1 column per category after the first; unseen values are all zero."""
    return {
        f"{column}_{c}": F.coalesce(F.col(column) == F.lit(c), F.lit(False)).cast("double") for c in categories[1:]
    }


def fit_target(train: DataFrame, column: str, target: str) -> DataFrame:
    """Smoothed class mean per category, with the prior in the same rows.

    weight = 1 / (1 + exp(-(n - 20) / 10)); value = weight * mean + (1 - weight) * prior.
    """
    prior = train.agg(F.avg(F.col(target).cast("double"))).scalar()
    per = train.groupBy(column).agg(F.count("*").alias("_n"), F.sum(F.col(target).cast("long")).alias("_s"))
    weight = 1 / (1 + F.exp(-(F.col("_n") - TARGET_MIN_ROWS) / TARGET_WIDTH))
    mean = share(F.col("_s"), F.col("_n"))
    value = weight * mean + (1 - weight) * prior
    return per.select(F.col(column).alias("_category"), value.alias("_encoded"))


def encode_target(df: DataFrame, train: DataFrame, column: str, target: str, name: str | None = None) -> DataFrame:
    """Adds the encoded column; unseen categories get the prior."""
    table = fit_target(train, column, target)
    prior = train.agg(F.avg(F.col(target).cast("double"))).scalar()
    joined = lookup_join(df, table, F.col(column) == F.col("_category"))
    encoded = F.coalesce(F.col("_encoded"), prior)
    return joined.withColumn(name or column, encoded).drop("_category", *([] if name == "_encoded" else ["_encoded"]))


def class_weights(df: DataFrame, target: str = "default_flag", name: str = "weight") -> DataFrame:
    """Adds n / (2 * class rows) to each row."""
    y = F.col(target)
    counts = df.agg(F.struct(F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1")).alias("c")).scalar()
    out = df.withColumn("_c", counts)
    n0, n1 = F.col("_c.n0"), F.col("_c.n1")
    own = F.when(y == 1, n1).otherwise(n0)
    return out.withColumn(name, F.try_divide((n0 + n1).cast("double"), (2 * own).cast("double"))).drop("_c")


def class_weight_table(df: DataFrame, target: str = "default_flag") -> DataFrame:
    y = F.col(target)
    counts = df.agg(F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1"))
    total = F.col("n0") + F.col("n1")
    return counts.select(
        "n0", "n1",
        share(total, 2 * F.col("n0")).alias("weight_0"), share(total, 2 * F.col("n1")).alias("weight_1"),
        share(F.col("n0"), F.col("n1")).alias("positive_weight"),
    )

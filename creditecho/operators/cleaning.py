"""Cleaning of loans and reviews, fills, clamps and data-quality reports."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditecho.config import DROP_GROUPS, EMPLOYMENT_YEARS, CreditOptions
from creditecho.functions.numeric import share, to_number, to_utc_timestamp
from creditecho.functions.text import clean_text
from creditecho.operators.totals import quantile_struct

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")

# Fixed values: (capped column, ceiling column), applied in this order.
BUSINESS_CAPS = (
    ("funded_amnt", "loan_amnt"),
    ("funded_amnt_inv", "funded_amnt"),
    ("total_pymnt_inv", "total_pymnt"),
    ("last_pymnt_amnt", "total_pymnt"),
)


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC_TYPES or t.startswith("decimal")]


def categorical_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t == "string"]


def drop_columns(df: DataFrame, columns) -> tuple[DataFrame, list[str]]:
    present = [c for c in columns if c in df.columns]
    return df.drop(*present), present


def employment_years(label: Column) -> Column:
    """Years for a known label, NULL for anything else."""
    pairs = [F.lit(x) for item in EMPLOYMENT_YEARS.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), F.trim(label))


def clamp_business(df: DataFrame) -> DataFrame:
    """Caps four amounts; a NULL on either side leaves the value as it is."""
    for column, ceiling in BUSINESS_CAPS:
        if column in df.columns and ceiling in df.columns:
            over = F.col(column) > F.col(ceiling)
            df = df.withColumn(column, F.when(over, F.col(ceiling)).otherwise(F.col(column)))
    return df


def clamp_violations(df: DataFrame) -> DataFrame:
    """One row with the number of rows each cap changes, in the order of application."""
    counts, out = [], df
    for column, ceiling in BUSINESS_CAPS:
        out = out.withColumn(f"_v_{column}", F.col(column) > F.col(ceiling))
        out = out.withColumn(column, F.when(F.col(f"_v_{column}"), F.col(ceiling)).otherwise(F.col(column)))
        counts.append(F.count_if(F.col(f"_v_{column}")).alias(f"{column}_over_{ceiling}"))
    return out.agg(*counts)


def fill_constants(df: DataFrame, options: CreditOptions = CreditOptions()) -> DataFrame:
    values = {c: "Unknown" for c in options.fill_unknown if c in df.columns}
    values |= {c: 0 for c in options.fill_zero if c in df.columns}
    return df.na.fill(values)


def fit_medians(df: DataFrame, columns=None) -> DataFrame:
    """One-row table of exact medians."""
    return quantile_struct(df, list(columns or numeric_columns(df)), [0.5], ["median"])


def fill_median(df: DataFrame, columns=None, medians: DataFrame | None = None) -> DataFrame:
    """Fills NULLs by the fitted medians (fitted on ``df`` itself when none are given)."""
    columns = list(columns or numeric_columns(df))
    medians = medians if medians is not None else fit_medians(df, columns)
    packed = medians.select(F.struct(*columns)).scalar()
    filled = {
        c: F.coalesce(F.col(c).cast("double"), F.col("_medians")[c]["median"]) for c in columns
    }
    return df.withColumn("_medians", packed).withColumns(filled).drop("_medians")


@dataclass
class CleanLoans:
    data: DataFrame
    removed: list[str]


def clean_loans(df: DataFrame, options: CreditOptions = CreditOptions(), keep: tuple = ()) -> CleanLoans:
    """Drop listed columns, convert employment length, cap amounts, fill missing values.

    The target stays in the frame. ``keep`` retains key columns that later joins need.
    """
    listed = [c for g in options.drop_groups for c in DROP_GROUPS[g] if c not in keep]
    out, removed = drop_columns(df, listed)
    if "emp_length" in out.columns:
        out = out.withColumn("emp_length", employment_years(F.col("emp_length")))
    out = fill_constants(clamp_business(out), options)
    filled = [c for c in numeric_columns(out) if c != options.target and c not in keep]
    return CleanLoans(fill_median(out, filled), removed)


def missing_summary(df: DataFrame) -> DataFrame:
    """Columns with missing values: count, percentage and type, largest first."""
    nulls = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    long = nulls.unpivot(["_rows"], df.columns, "column_name", "missing_count")
    return (
        long.filter(F.col("missing_count") > 0)
        .select(
            "column_name",
            "missing_count",
            (100 * share(F.col("missing_count"), F.col("_rows"))).alias("missing_percentage"),
            types[F.col("column_name")].alias("data_type"),
        )
        .orderBy(F.col("missing_percentage").desc(), "column_name")
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of full-row repeats."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def quality_report(df: DataFrame) -> DataFrame:
    """Shape, repeated rows, missing cells, and the column lists by type."""
    cells = sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_n")).withColumn("_m", cells * F.col("_n"))
    width = len(df.columns)
    totals = copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.lit(width).alias("n_columns"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum("_m"), F.lit(0)).alias("missing_values"),
    )
    return totals.select(
        "*",
        (100 * share(F.col("missing_values"), F.col("n_rows") * width)).alias("missing_percentage"),
        F.lit(",".join(numeric_columns(df))).alias("numeric_columns"),
        F.lit(",".join(categorical_columns(df))).alias("categorical_columns"),
    )


# ---------------------------------------------------------------- reviews

REVIEW_COLUMNS = ("id", "score", "title", "feedback", "timestamp")


def coerce_reviews(df: DataFrame) -> DataFrame:
    """Numbers and timestamps from raw values; unreadable ones become NULL."""
    return df.withColumns({
        "id": to_number(F.col("id")).cast("long"),
        "score": to_number(F.col("score")),
        "timestamp": to_utc_timestamp(F.col("timestamp")),
    })


def drop_bad_reviews(df: DataFrame) -> DataFrame:
    return df.filter(
        F.col("id").isNotNull() & F.col("score").between(1, 5) & (F.length("feedback") >= 5)
    )


def latest_per_id(df: DataFrame, key: str = "id", when: str = "timestamp", null_wins: bool = False) -> DataFrame:
    """One row per key, the latest; full ties are settled by the remaining columns.

    A hot key is cut before the shuffle: each task keeps only its own best row per key.
    """
    stamp = F.col(when)
    order = [stamp.desc_nulls_first() if null_wins else stamp.desc_nulls_last()]
    order += [F.col(c).asc_nulls_last() for c in df.columns if c not in (key, when)]
    place = F.row_number().over(W.partitionBy(key).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def clean_reviews(df: DataFrame, null_wins: bool = False, sort: bool = True) -> DataFrame:
    """Typed, cleaned, filtered, one row per id, in time order with undated rows last."""
    typed = coerce_reviews(df).withColumns({
        "title": clean_text(F.col("title")), "feedback": clean_text(F.col("feedback")),
    })
    out = latest_per_id(drop_bad_reviews(typed), null_wins=null_wins)
    return out.orderBy(F.col("timestamp").asc_nulls_last(), "id") if sort else out


def non_empty_feedback(df: DataFrame, column: str = "feedback") -> DataFrame:
    return df.filter(F.length(F.trim(F.col(column))) > 0)


def attach_sentiment(reviews: DataFrame, stored: DataFrame) -> DataFrame:
    """Left join of stored sentiment by id; repeated stored ids cannot multiply reviews."""
    best = W.partitionBy("id").orderBy(F.col("sentiment_score").desc_nulls_last(), "sentiment_label")
    single = (
        stored.select("id", "sentiment_label", "sentiment_score")
        .withColumn("_n", F.row_number().over(best)).filter(F.col("_n") == 1).drop("_n")
    )
    return reviews.drop("sentiment_label", "sentiment_score").join(single, "id", "left")

"""Readers with explicit contracts."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditecho.operators.cleaning import REVIEW_COLUMNS

LOAN_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("id", "member_id")]
    + [T.StructField(c, T.DoubleType()) for c in ("loan_amnt", "funded_amnt", "funded_amnt_inv", "installment")]
    + [T.StructField("term", T.IntegerType()), T.StructField("annual_inc", T.DoubleType())]
    + [T.StructField(c, T.StringType()) for c in ("emp_length", "emp_title")]
    + [T.StructField(c, T.LongType()) for c in ("delinq_2yrs", "open_acc", "total_acc")]
    + [
        T.StructField(c, T.DoubleType())
        for c in ("tot_coll_amt", "tot_cur_bal", "total_rev_hi_lim", "total_pymnt", "total_pymnt_inv", "last_pymnt_amnt")
    ]
    + [T.StructField("default_flag", T.IntegerType())]
)


def read_loans(spark: SparkSession, path: str) -> DataFrame:
    """Loans from CSV (header) or Parquet under the fixed schema."""
    if path.lower().endswith(".csv"):
        return spark.read.schema(LOAN_SCHEMA).option("header", True).csv(path)
    return spark.read.schema(LOAN_SCHEMA).parquet(path)


def read_by_suffix(spark: SparkSession, path: str) -> DataFrame:
    """Parquet or CSV by file name; spreadsheets have to be exported first."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "parquet":
        return spark.read.parquet(path)
    if suffix == "csv":
        return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if suffix in ("xlsx", "xls"):
        raise ValueError(f"spreadsheet input is not supported, export it as CSV or Parquet: {path}")
    raise ValueError(f"unsupported file type: {path}")


def find_column(df: DataFrame, name: str) -> str | None:
    """The column of that name: exact first, then ignoring case."""
    if name in df.columns:
        return name
    return {c.lower(): c for c in df.columns}.get(name.lower())


def pick_review_columns(df: DataFrame, wanted=REVIEW_COLUMNS) -> DataFrame:
    """The five review columns under lower-case names; names all missing ones in the error."""
    found = {w: find_column(df, w) for w in wanted}
    missing = [w for w, c in found.items() if c is None]
    if missing:
        raise ValueError(f"missing required columns: {missing}; found: {df.columns}")
    return df.select(*[F.col(f"`{c}`").alias(w) for w, c in found.items()])


def require_columns(df: DataFrame, required=REVIEW_COLUMNS) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"input lacks columns: {missing}")
    return df


def read_queries(spark: SparkSession, path: str | None = None, text: str | None = None) -> DataFrame:
    """Queries from a one-per-line file and a comma list; trimmed, blanks dropped."""
    parts = []
    if text:
        parts.append(spark.sql("SELECT explode(split(:t, ',')) AS query", {"t": text}))
    if path:
        parts.append(spark.read.text(path).select(F.col("value").alias("query")))
    if not parts:
        raise ValueError("no queries given")
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.select(F.trim("query").alias("query")).filter(F.col("query") != "")

"""Writers and the folder used for intermediate tables."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditecho.functions.text import slug
from creditecho.session import shared_folder


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def write_clean(df: DataFrame, folder: str) -> None:
    """Cleaned reviews as Parquet and as CSV with a header."""
    df.write.mode("overwrite").parquet(f"{folder}/parquet")
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/csv")


def first_rows(df: DataFrame, by: list[str], order: str, n: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy(*by).orderBy(order))
    return df.withColumn("_n", place).filter(F.col("_n") <= n).drop("_n")


def write_results(df: DataFrame, folder: str, n: int = 5) -> None:
    """First n result rows of each query as CSV, one folder per query name."""
    top = first_rows(df, ["query_id"], "rank", n).withColumn("query_slug", slug(F.col("query")))
    top.write.mode("overwrite").partitionBy("query_slug").option("header", True).option("escape", '"').csv(folder)


def write_table_csv(df: DataFrame, folder: str) -> None:
    """A small report table as one CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(folder)


def write_reports(test: DataFrame, cv: DataFrame, comparison: DataFrame, folder: str) -> None:
    write_table_csv(test, f"{folder}/model_test_results")
    write_table_csv(cv, f"{folder}/model_cv_results")
    write_table_csv(comparison, f"{folder}/model_comparison_summary")

"""Intermediate tables in the folder that the driver and all executors share."""
from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a local master without that setting gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-store-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes a frame as Parquet into the shared folder and reads it back: lineage ends here, columns can be pruned."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """In a task: returns freed memory to the system. Python workers serve many tasks, and what one of them freed would stay with the worker."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim is not None:
        trim(0)

"""Session settings and the checkpoint folder."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SPREAD_ROWS = 50_000


def build_session(app: str = "creditecho", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Timestamps are read and compared in UTC everywhere."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a local master without that setting gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="creditecho-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes a frame as Parquet into the shared folder and reads it back: lineage ends here, columns are pruned and filters pushed down."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared folder.

    A result that arrived in fewer partitions than cores is spread over them, since it is stored to be read several times.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    out = df.checkpoint()
    cores = context.defaultParallelism
    if out.rdd.getNumPartitions() < cores and out.count() > SPREAD_ROWS:
        out = out.repartition(cores).checkpoint()
    return out


def drop_checkpoints(*frames: DataFrame) -> None:
    """Deletes the files of checkpointed frames that nothing reads any more, as their rows were stored again."""
    for df in frames:
        context = df.sparkSession.sparkContext
        named = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if named.isDefined():
            path = context._jvm.org.apache.hadoop.fs.Path(named.get())
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

"""Every opN_ query in a session whose Python workers cannot import the package: functions travel by value, broadcasts are plain data."""
import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]

SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", sys.argv[3]).getOrCreate())

def importable(batches):
    import pyarrow as pa
    try:
        import creditecho
        found = True
    except ImportError:
        found = False
    yield pa.RecordBatch.from_pydict({"found": [found]})

assert spark.range(1).mapInArrow(importable, "found boolean").first()[0] is False
sys.path.insert(0, sys.argv[1])
import __spark_entry__
for name, run in __spark_entry__.queries().items():
    if name.startswith("op"):
        out = run(spark, sys.argv[2])
        print("ROWS", name, out.count(), flush=True)
"""


def test_workers_without_the_package(tmp_path):
    tables = {"documents": 60, "labels": 60, "pages": 40, "embeddings": 200}
    import duckdb

    source = "/root/testdata/sf0.001"
    for name, n in tables.items():
        duckdb.sql(f"COPY (SELECT * FROM '{source}/{name}.parquet' LIMIT {n}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    (tmp_path / "cwd").mkdir()
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(REPO), str(tmp_path), f"file://{tmp_path}/shared"], cwd=tmp_path / "cwd", env=env, capture_output=True, text=True, timeout=900,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ROWS op") == 13

"""Class balancing by synthetic minority rows."""
from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditecho.config import SEED
from creditecho.operators.knn import nearest
from creditecho.operators.splits import stratified_positions
from creditecho.session import stored


def synthetic_rows(df: DataFrame, k: int = 5, seed: int = SEED, key: str = "id", label: str = "label") -> DataFrame:
    """(features, label): points between a minority row and one of its k nearest minority rows.

    Copies are spread evenly over the minority rows until both classes have the same size. The neighbour
    and the place between the two points come from hashes, so a repeated run gives the same rows.
    """
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return df.select("features", label).filter("false")
    small = min(counts, key=lambda c: (counts[c], c))
    n_small, need = counts[small], max(counts.values()) - counts[small]
    k = min(k, n_small - 1)
    if k < 1 or need < 1:
        return df.select("features", label).filter("false")
    rows = stored(df.filter(F.col(label) == small).select(
        F.col(key).cast("long").alias("doc_id"), vector_to_array("features").alias("vector"), F.lit(0).alias("_c")
    ), "minority")
    near = nearest(rows.withColumnRenamed("doc_id", "query_id"), rows, k, "euclidean", exclude_self=True)
    placed = stratified_positions(rows, "doc_id", "_c", seed)
    copies = F.lit(need // n_small) + (F.col("position") <= need % n_small).cast("int")
    # a row meets its neighbours and their places once, before it is copied
    ends = near.select("query_id", "rank", "doc_id").join(rows.select("doc_id", F.col("vector").alias("_to")), "doc_id")
    pairs = placed.withColumn("_copies", copies).filter("_copies > 0").select(
        F.col("doc_id").alias("query_id"), F.col("vector").alias("_from"), "_copies"
    ).join(ends.select("query_id", "rank", "_to"), "query_id")
    spread = pairs.select("query_id", "rank", "_from", "_to", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy"))
    pick = F.pmod(F.xxhash64("query_id", "_copy", F.lit(seed)), F.lit(k)) + 1
    step = F.pmod(F.xxhash64("_copy", "query_id", F.lit(seed + 1)), F.lit(1_000_000)) / 1_000_000
    chosen = spread.filter(F.col("rank") == pick).withColumn("_step", step)
    # the step travels inside the zipped arrays, as lambdas read columns of the same row
    point = F.zip_with("_from", "_to", lambda a, b: a + F.col("_step") * (b - a))
    return chosen.select(array_to_vector(point).alias("features"), F.lit(small).cast(dict(df.dtypes)[label]).alias(label))


def smote(df: DataFrame, k: int = 5, seed: int = SEED, key: str = "id", label: str = "label") -> DataFrame:
    """Original rows and synthetic minority rows."""
    return df.select("features", label).unionByName(synthetic_rows(df, k, seed, key, label))

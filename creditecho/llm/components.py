"""Connected components of a link table, by alternating large-star and small-star rounds on DataFrames."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditecho.llm.store import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (a > b). Large star: every greater neighbour of a node goes to the node's least one; small star: every smaller one does."""
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        out = both.join(least, F.col("a") == F.col("n")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        near = links.join(least, F.col("a") == F.col("n"))
        out = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return out.filter("a != b").distinct()


def _is_settled(links: DataFrame) -> bool:
    """Every left node has one link and is no right node, so each component is a star around its least node."""
    left = links.select(F.col("a").alias("n"), F.lit(1).alias("l"), F.lit(0).alias("r"))
    right = links.select(F.col("b").alias("n"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    roles = left.unionByName(right).groupBy("n").agg(F.sum("l").alias("l"), F.max("r").alias("r"))
    return roles.filter("l > 1 or (l = 1 and r = 1)").limit(1).count() == 0


def components(links: DataFrame) -> DataFrame:
    """(a, b): every linked node with the least node of its component, the least one itself left out."""
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    now = stored(ordered, "links")
    while not _is_settled(now):
        now = stored(_star(_star(now, True), False), "links")
    return now

"""Seeded stratified splits and folds by hash order.

A row's place is the order of md5(key:seed) inside its class. Only the few cut keys at the wanted places
are searched for; every row is then compared with them, so the table itself is never shuffled.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditecho.config import FOLDS, SEED, TEST_SHARE


def hash_key(key: str, seed: int | str) -> Column:
    text = F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))
    return F.concat(F.md5(text), F.lit("|"), F.col(key).cast("string"))


def _keyed(df: DataFrame, key: str, target: str, seed) -> DataFrame:
    out = df.withColumn("_h", hash_key(key, seed))
    return out.withColumn("_bucket", F.substring("_h", 1, 4))


def _bucket_offsets(keyed: DataFrame, target: str) -> DataFrame:
    counts = keyed.groupBy(target, "_bucket").agg(F.count("*").alias("_n"))
    w = W.partitionBy(target)
    earlier = w.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    return counts.select(
        target, "_bucket", "_n",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.sum("_n").over(w).alias("_total"),
    )


def stratified_positions(df: DataFrame, key: str = "id", target: str = "default_flag", seed=SEED) -> DataFrame:
    """Adds ``position`` (1-based, per class in hash order) and ``class_rows``."""
    keyed = _keyed(df, key, target, seed)
    offsets = _bucket_offsets(keyed, target).drop("_n")
    joined = keyed.join(offsets, [target, "_bucket"])
    inside = F.row_number().over(W.partitionBy(target, "_bucket").orderBy("_h"))
    return joined.withColumn("position", F.col("_before") + inside).withColumnRenamed("_total", "class_rows").drop(
        "_h", "_bucket", "_before"
    )


def _parts_before(df: DataFrame, key: str, target: str, seed, places: list[Column], name: str) -> DataFrame:
    """Adds how many cut keys lie before a row; cut i is the row at place i of its class."""
    keyed = _keyed(df, key, target, seed)
    wanted = F.array(*[F.struct(F.lit(i).alias("_i"), p.cast("long").alias("_place")) for i, p in enumerate(places)])
    offsets = _bucket_offsets(keyed, target).withColumn("_cut", F.explode(wanted)).select(
        target, "_bucket", "_n", "_before", "_cut.*"
    )
    holding = offsets.filter(
        (F.col("_place") > F.col("_before")) & (F.col("_place") <= F.col("_before") + F.col("_n"))
    )
    candidates = keyed.select(target, "_bucket", "_h").join(F.broadcast(holding), [target, "_bucket"])
    inside = F.row_number().over(W.partitionBy(target, "_bucket", "_i").orderBy("_h"))
    cuts = candidates.withColumn("_rn", inside).filter(F.col("_rn") == F.col("_place") - F.col("_before"))
    per_class = cuts.groupBy(F.col(target).alias("_class")).agg(F.collect_list("_h").alias("_cuts"))
    out = keyed.join(F.broadcast(per_class), F.col(target) == F.col("_class"), "left")
    before = F.size(F.filter(F.coalesce(F.col("_cuts"), F.array().cast("array<string>")), lambda c: c < F.col("_h")))
    return out.withColumn(name, before).drop("_h", "_bucket", "_class", "_cuts")


def stratified_split(
    df: DataFrame, key: str = "id", target: str = "default_flag", test_share: float = TEST_SHARE, seed=SEED
) -> DataFrame:
    """Adds ``is_test``: the first round(share * n) rows of each class in hash order."""
    place = F.round(F.col("_total") * test_share)
    out = _parts_before(df, key, target, seed, [place], "_part")
    return out.withColumn("is_test", F.col("_part") == 0).drop("_part")


def stratified_folds(
    df: DataFrame, key: str = "id", target: str = "default_flag", folds: int = FOLDS, seed="42-folds"
) -> DataFrame:
    """Adds ``fold`` 0..folds-1: equal consecutive parts of each class in hash order."""
    places = [F.ceil(F.col("_total") * i / folds) for i in range(1, folds)]
    return _parts_before(df, key, target, seed, places, "fold")

"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Each source gets a target number of words; each of its documents is expected ``target / source size`` times. The expected
copies are summed in a fixed order within the source, one random offset is added, and a document is taken once for each
integer that its part of the sum crosses. Sizes rise over one half of the order and fall over the other, so neighbours are alike
and a source's words come close to its target wherever the offset lies.

No source is ordered in one task: documents are dealt into blocks by size class and md5 range, blocks are counted, and only the
counts are summed over the source.

Nulls: a null text has size 0; a null source is a source of its own, last in order; a null doc_id is ordered as an empty key.
Documents of size 0 are never taken. Rows that repeat are drawn each on its own. An empty table gives an empty mix.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditecho.llm.store import stored

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = 20240229
BLOCK_ROWS = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def offset_of(seed: int) -> float:
    """The one random offset in [0, 1): a 32-bit mix of the seed, the same on every run."""
    return ((seed * 2654435761 + 374761393) % 2**32) / 2**32


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from one row per source.

    Targets are ``least(most * size, level * weight)`` with the level at which they add up to all sizes. Sources in order of
    ``most * size / weight`` reach their limit one after the other, so the level follows from running sums over the sources.
    The table has one row per source name, which one task orders.
    """
    every = W.partitionBy(F.lit(0))
    nth = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (nth % len(weights)).cast("int"))
    rows = sizes.withColumn("_w", weight.cast("long")).withColumn("_cap", F.lit(most) * F.col("source_size"))
    by_limit = every.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("source").asc_nulls_last())
    earlier = by_limit.rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumns({
        "_full": F.coalesce(F.sum("_cap").over(earlier), F.lit(0)),
        "_left": F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(earlier), F.lit(0)),
        "_all": F.sum("source_size").over(every),
    })
    level = (F.col("_all") - F.col("_full")).cast("double") / F.col("_left")
    fits = level * F.col("_w") <= F.col("_cap")
    level = F.min(F.when(fits, F.struct(F.col("_full"), level.alias("level")))).over(every)["level"]
    rows = rows.withColumn("_level", level)
    share = F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_w"))
    return rows.select("source", "source_size", share.alias("target"))


def _hex(text: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(text, start, digits), 16, 10).cast("long")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def copies(
    docs: DataFrame, key: str = "doc_id", size: str = "size", source: str = "source", weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES, seed: int = SEED,
) -> DataFrame:
    """Adds source_size, target and copies (how often the mix takes the row) to rows with a key, a size and a source.

    Only these three columns are kept: (key, source, size, source_size, target, copies).
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    length = F.length(F.bin(F.col(size)))
    step = F.when(
        F.col(size) > 0, length * 8 + F.call_function("shiftright", F.col(size), F.greatest(length - 4, F.lit(0)).cast("int")) % 8
    )
    rising = _hex(F.col("_md5"), 1, 1) % 2 == 0
    base = docs.select(F.col(key), F.col(source).alias("source"), F.col(size).alias("size"), digest.alias("_md5"))
    base = base.withColumn("_class", F.when(F.col("size") > 0, F.when(rising, step).otherwise(100_000 - step)).cast("long"))
    base = base.withColumn("_place", _hex(F.col("_md5"), 2, 12))
    base = stored(base.drop("_md5"), "mix-sizes")

    share = targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    share = share.withColumnRenamed("source", "_s")
    filled = base.filter("size > 0")
    classes = filled.groupBy("source", "_class").agg(F.count("*").alias("_n"))
    classes = classes.select(
        F.col("source").alias("_s"), F.col("_class").alias("_c"), F.ceil(F.col("_n") / BLOCK_ROWS).alias("_parts")
    )
    cut = filled.join(classes, _same(filled["source"], F.col("_s")) & (filled["_class"] == F.col("_c"))).drop("_s", "_c")
    block = F.floor(F.col("_place").cast("double") / 2.0**48 * F.col("_parts")).cast("long")
    cut = cut.withColumn("_block", block)

    counts = cut.groupBy("source", "_class", "_block").agg(F.count("*").alias("_n"))
    before = W.partitionBy("source").orderBy("_class", "_block").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(
        F.col("source").alias("_s"), F.col("_class").alias("_c"), F.col("_block").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    inside = W.partitionBy("source", "_class", "_block").orderBy("_place", F.col(key).asc_nulls_first(), "size")
    ranked = cut.withColumn("_row", F.row_number().over(inside))
    ranked = ranked.join(
        counts, _same(ranked["source"], F.col("_s")) & (ranked["_class"] == F.col("_c")) & (ranked["_block"] == F.col("_b"))
    ).drop("_s", "_c", "_b")
    ranked = ranked.select(key, "source", "size", (F.col("_before") + F.col("_row")).alias("_rank"))
    empty = base.filter("size = 0").select(key, "source", "size", F.lit(None).cast("long").alias("_rank"))
    rows = ranked.unionByName(empty)

    rows = rows.join(share, _same(rows["source"], F.col("_s"))).drop("_s")
    rate = F.try_divide(F.col("target"), F.col("source_size").cast("double"))
    u = F.lit(offset_of(seed))
    crossed = F.floor(F.col("_rank") * rate + u) - F.floor((F.col("_rank") - 1) * rate + u)
    taken = F.when(F.col("_rank").isNotNull(), crossed).otherwise(F.lit(0)).cast("long")
    return rows.select(key, "source", "size", "source_size", "target", taken.alias("copies"))


def mix_plan(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies, taken) for documents with a text and a source."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    out = copies(sized, **options)
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``.

    Rows that share a doc_id are told apart by their size; equal rows share their copies evenly, the first ones by row order.
    """
    plan = mix_plan(docs, **options).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("copies"), F.count("*").alias("same"))
    plan = plan.filter("copies > 0").select(
        F.col("doc_id").alias("p_id"), F.col("source").alias("p_source"), F.col("size").alias("p_size"), "copies", "same"
    )
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), F.col("source").alias("from"), word_count(F.col("text")).alias("size")
    )
    joined = rows.join(plan, _same(rows["id"], plan["p_id"]) & _same(rows["from"], plan["p_source"]) & (rows["size"] == plan["p_size"]))
    single = joined.filter("same = 1").withColumn("times", F.col("copies"))
    nth = F.row_number().over(W.partitionBy("id", "from", "size").orderBy(F.xxhash64("row.text"))) - 1
    share = F.floor((F.col("copies") + F.col("same") - 1 - nth) / F.col("same")).cast("long")
    several = joined.filter("same > 1").withColumn("times", share)
    out = single.unionByName(several).filter("times > 0")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("row.*")

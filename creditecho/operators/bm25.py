"""Words of documents and sums that do not depend on the order of rows. The index itself is in ``index_store``."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditecho.functions.text import tokens
from creditecho.operators.joins import lookup_join

SCALE = 1e10


def fixed_sum(x: Column) -> Column:
    """Sum of doubles in whole steps of 1e-10, independent of row order; for sums with a known bound (per document)."""
    return F.sum(F.round(x * F.lit(SCALE)).cast("long")) / F.lit(SCALE)


def wide_sum(x: Column) -> Column:
    """The same for sums over any number of rows: decimals hold totals up to 1e28."""
    return F.sum(x.cast("decimal(28,10)")).cast("double")


def tokenized(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, words): one row per document."""
    return docs.select(F.col(key).alias("doc_id"), tokens(F.col(text)).alias("words"))


def lemmatized(docs: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Replaces each word by its dictionary lemma (``token``, ``lemma``); unknown words stay."""
    flat = docs.select("doc_id", F.posexplode_outer("words").alias("_at", "_word"))
    joined = lookup_join(flat, lemmas, F.col("_word") == F.col("token"))
    word = F.coalesce("lemma", "_word")
    pairs = F.array_sort(F.collect_list(F.when(F.col("_at").isNotNull(), F.struct("_at", word.alias("_w")))))
    return joined.groupBy("doc_id").agg(F.transform(pairs, lambda p: p["_w"]).alias("words"))

"""Reciprocal rank fusion, similarity filter, limits and reranking of result lists."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditecho.config import RRF_K
from creditecho.operators.bm25 import fixed_sum
from creditecho.operators.totals import ranked
from creditecho.session import stored


def ranked_lists(**lists: DataFrame) -> DataFrame:
    """Long table (query_id, retriever, doc_id, rank) from ranked lists by retriever name."""
    out = None
    for name, frame in lists.items():
        part = frame.select("query_id", F.lit(name).alias("retriever"), "doc_id", "rank")
        out = part if out is None else out.unionByName(part)
    return out


def rrf_scores(lists: DataFrame, k: int = RRF_K) -> DataFrame:
    """(query_id, doc_id, rrf): sum of 1 / (k + rank) over the lists; one grouping, no outer join."""
    return lists.groupBy("query_id", "doc_id").agg(fixed_sum(1.0 / (F.lit(k) + F.col("rank"))).alias("rrf"))


def fuse(words: DataFrame, near: DataFrame, k: int = RRF_K) -> DataFrame:
    """(query_id, doc_id, rrf, bm25, sim, similarity) of a word list and a vector list in one grouping; a score that a list lacks is NULL."""
    none = F.lit(None).cast("double")
    both = words.select("query_id", "doc_id", "rank", "bm25", none.alias("sim")).unionByName(
        near.select("query_id", "doc_id", "rank", none.alias("bm25"), (-F.col("distance")).alias("sim"))
    )
    out = both.groupBy("query_id", "doc_id").agg(
        fixed_sum(1.0 / (F.lit(k) + F.col("rank"))).alias("rrf"), F.max("bm25").alias("bm25"), F.max("sim").alias("sim"),
    )
    return out.withColumn("similarity", F.coalesce("sim", F.lit(0.0)))


def with_rank(df: DataFrame, score: str, bounded: bool) -> DataFrame:
    """Adds ``rank`` by descending score per query; ``bounded`` states that lists were cut to a fixed length."""
    if not bounded:
        return ranked(stored(df, "fused"), ["query_id"], score, "doc_id")
    order = W.partitionBy("query_id").orderBy(F.col(score).desc(), "doc_id")
    return df.withColumn("rank", F.row_number().over(order).cast("long"))


def rrf(lists: DataFrame, k: int = RRF_K, bounded: bool = True) -> DataFrame:
    """Fused ranks. ``bounded`` states that the input lists were cut to a fixed length."""
    return with_rank(rrf_scores(lists, k), "rrf", bounded)


def with_similarity(fused: DataFrame, vector_hits: DataFrame) -> DataFrame:
    """Adds ``sim`` (NULL without a vector hit) and the reported ``similarity`` (0 then)."""
    sims = vector_hits.select("query_id", "doc_id", (-F.col("distance")).alias("sim"))
    return fused.join(sims, ["query_id", "doc_id"], "left").withColumn(
        "similarity", F.coalesce(F.col("sim"), F.lit(0.0))
    )


def min_sim_filter(fused: DataFrame, min_sim: float, max_bm25_only: int = 0) -> DataFrame:
    """Vector hits at or above the limit, plus the rows that only the word search found: all of them, or the first ``max_bm25_only`` if above 0.

    A limited second part is a ``row_number() <= n`` filter, cut inside every task before its shuffle.
    """
    if min_sim <= 0:
        return fused
    if max_bm25_only <= 0:
        return fused.filter((F.col("sim") >= min_sim) | F.col("sim").isNull())
    near = fused.filter(F.col("sim") >= min_sim)
    order = W.partitionBy("query_id").orderBy("rank")
    only = fused.filter(F.col("sim").isNull()).withColumn("_n", F.row_number().over(order))
    return near.unionByName(only.filter(F.col("_n") <= max_bm25_only).drop("_n"))


def limit_per_query(df: DataFrame, n: int, order: str = "rank") -> DataFrame:
    """First n rows of each query in rank order; ``n <= 0`` keeps all."""
    if n <= 0:
        return df
    place = F.row_number().over(W.partitionBy("query_id").orderBy(order))
    return df.withColumn("_n", place).filter(F.col("_n") <= n).drop("_n")


def rerank(df: DataFrame, scorer: Callable[[], Column] | Column, bounded: bool = True) -> DataFrame:
    """New ranks by a score column, for example a user model applied through ``mapInPandas``."""
    scored = df.drop("rank").withColumn("rerank_score", scorer() if callable(scorer) else scorer)
    return with_rank(scored, "rerank_score", bounded)


def blended_score(word_score: str = "bm25", sim: str = "similarity", weight: float = 0.5) -> Column:
    """Built-in scorer: squashed BM25 and cosine similarity."""
    words = F.coalesce(F.col(word_score), F.lit(0.0))
    return F.round(F.lit(weight) * words / (words + 10) + F.lit(1 - weight) * F.col(sim), 9)

"""The two searches and their evaluation for a whole table of queries in one job."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditecho.config import SearchOptions
from creditecho.operators import fusion, index_store, knn
from creditecho.operators.index_store import StoredIndex
from creditecho.operators.sentiment import cap_sentiment, sentiment_class, sentiment_summary
from creditecho.operators.totals import ranked
from creditecho.session import stored
from creditecho.sources.sinks import work_folder

REVIEW = ("id", "score", "title", "feedback", "timestamp", "sentiment_label", "sentiment_score")


def fetch_reviews(hits: DataFrame, reviews: DataFrame, columns=REVIEW) -> DataFrame:
    """Review rows of the hits by document key; ranks travel with the rows."""
    rows = reviews if "doc_id" in reviews.columns else reviews.withColumnRenamed("id", "doc_id")
    return hits.join(rows.select("doc_id", *[c for c in columns if c != "id" and c in rows.columns]), "doc_id")


def opened(source: DataFrame | StoredIndex, vectors: DataFrame | None = None, lemmas: DataFrame | None = None) -> StoredIndex:
    """A stored index as it is; a review table is indexed first, in a folder of its own."""
    if isinstance(source, StoredIndex):
        return source
    return index_store.build(source, work_folder(source.sparkSession, "index"), vectors=vectors, lemmas=lemmas)


def word_list(source: DataFrame | StoredIndex, queries: DataFrame, options: SearchOptions = SearchOptions()) -> DataFrame:
    """Ranked word hits of every query, written once because later steps read them repeatedly."""
    return stored(opened(source).top_documents(queries, options.k_lex), "word-list")


def search_baseline(
    source: DataFrame | StoredIndex, queries: DataFrame, options: SearchOptions = SearchOptions(), fallback: bool = False,
    words: DataFrame | None = None,
) -> DataFrame:
    """Word search: positive BM25 hits in rank order, optionally substring matches when there is none."""
    index = opened(source)
    words = words if words is not None else word_list(index, queries, options)
    hits = fusion.limit_per_query(words.select("query_id", "doc_id", "bm25", "rank"), options.limit)
    if fallback:
        hits = fusion.limit_per_query(index.with_fallback(hits, queries), options.limit)
    return with_sentiment(fetch_reviews(hits, index.reviews), options)


def with_sentiment(found: DataFrame, options: SearchOptions) -> DataFrame:
    """Sentiment of the first ``options.sentiment_limit`` results of a query; 0 keeps it for all."""
    return cap_sentiment(found, options.sentiment_limit) if options.sentiment_limit > 0 else found


def vector_list(queries: DataFrame, vectors: DataFrame, k: int, min_sim: float | None = None) -> DataFrame:
    """Ranked nearest documents; with ``k <= 0`` every one at or above ``min_sim``."""
    q = queries.select("query_id", F.col("embedding").alias("vector"))
    c = vectors.select("doc_id", F.col("embedding").alias("vector"))
    if k > 0:
        return knn.nearest(q, c, k)
    found = stored(knn.similar(q, c, min_sim).withColumn("_near", -F.col("distance")), "near")
    return ranked(found, ["query_id"], "_near", "doc_id").drop("_near")


def with_vectors(queries: DataFrame, encoder) -> DataFrame:
    """Queries with an ``embedding``: as given, or made by an encoder (``encode(df, column)``) from their text."""
    if "embedding" in queries.columns:
        return queries
    if encoder is None:
        raise ValueError("queries need a column embedding or an encoder")
    return stored(encoder.encode(queries, "query"), "query-vectors")


def fused_hits(
    source: DataFrame | StoredIndex, queries: DataFrame, vectors: DataFrame | None = None, options: SearchOptions = SearchOptions(),
    scorer: Column | None = None, words: DataFrame | None = None, encoder=None,
) -> DataFrame:
    """(query_id, doc_id, rank, rrf, bm25, sim, similarity) after fusion, filter and limit. Without ``vectors`` those of the index are used."""
    bounded = options.k_lex > 0 and options.k_vec > 0
    index = opened(source, vectors)
    vectors = vectors if vectors is not None else index.vectors()
    words = words if words is not None else word_list(index, queries, options)
    limit = options.min_sim if options.min_sim > 0 else None
    near = vector_list(with_vectors(queries, encoder), vectors, options.k_vec, limit)
    fused = fusion.fuse(words, near, options.rrf_k)
    if options.k_vec <= 0 and limit is not None:
        # the full vector list would hold these documents, below the limit
        known = vectors.select("doc_id", F.lit(True).alias("_known"))
        fused = fused.join(known, "doc_id", "left")
        ranked_ = fusion.with_rank(fused, "rrf", bounded)
        fused = ranked_.filter("sim IS NOT NULL OR _known IS NULL").drop("_known")
    else:
        fused = fusion.with_rank(fused, "rrf", bounded)
    if scorer is not None:
        fused = fusion.rerank(fused, scorer, bounded)
    kept = fusion.min_sim_filter(fused, options.min_sim, options.max_bm25_only)
    return fusion.limit_per_query(kept, options.limit)


def search_hybrid(
    source: DataFrame | StoredIndex, queries: DataFrame, vectors: DataFrame | None = None, options: SearchOptions = SearchOptions(),
    scorer: Column | None = None, words: DataFrame | None = None, encoder=None,
) -> DataFrame:
    """Word and vector search fused by reciprocal ranks, with review rows attached."""
    index = opened(source, vectors)
    return with_sentiment(fetch_reviews(fused_hits(index, queries, vectors, options, scorer, words, encoder), index.reviews), options)


def summarize(results: DataFrame, by: list[str] = ("query_id",)) -> DataFrame:
    """Sentiment metrics per result set; the results are read once."""
    return sentiment_summary(results, list(by))


def evaluate_queries(
    source: DataFrame | StoredIndex, queries: DataFrame, vectors: DataFrame | None = None, options: SearchOptions = SearchOptions(),
) -> DataFrame:
    """Sentiment metrics of both searches: one row per query and side.

    The two result lists are written once to the shared folder, since the metrics read them repeatedly.
    """
    index = opened(source, vectors)
    words = word_list(index, queries, options)
    keep = ["query_id", "side", "score", "sentiment_label", "sentiment_score"]
    plain = search_baseline(index, queries, options, fallback=True, words=words).withColumn("side", F.lit("baseline"))
    mixed = search_hybrid(index, queries, vectors, options, words=words).withColumn("side", F.lit("rag"))
    results = stored(plain.select(keep).unionByName(mixed.select(keep)), "results")
    cls = sentiment_class(F.col("sentiment_score"), null_as_neutral=True)
    rates = results.groupBy("query_id", "side").agg(
        F.avg((cls == "negative").cast("double")).alias("negative_rate"),
        F.avg((cls == "positive").cast("double")).alias("positive_rate"),
    )
    return sentiment_summary(results, ["query_id", "side"]).join(rates, ["query_id", "side"])

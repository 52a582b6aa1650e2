"""Search queries: index, word and vector search, fusion, evaluation."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from creditecho.catalog.registry import Registry, rounded
from creditecho.catalog.reviews import words_sql
from creditecho.catalog.views import REVIEWS
from creditecho.config import SearchOptions
from creditecho.functions.text import slug
from creditecho.operators import fusion, index_store, knn
from creditecho.operators import insights as I
from creditecho.operators import sentiment as S
from creditecho.operators.joins import lookup_join
from creditecho.plans import search as P
from creditecho.session import stored
from creditecho.sources import sinks
from creditecho.sources.tables import doc_vectors, reviews, search_queries

R = Registry()
K = 50
OPTIONS = SearchOptions(k_lex=K, k_vec=K, min_sim=0.5, max_bm25_only=20, limit=30)

_DOCS = f"""{REVIEWS}, dt AS (SELECT id AS doc_id, {words_sql('feedback')} AS words FROM reviews),
cs AS (SELECT count(*) AS n_docs, avg(len(words)) AS avgdl FROM dt),
post AS (SELECT doc_id, dl, term, count(*) AS tf FROM (SELECT doc_id, len(words) AS dl, unnest(words) AS term FROM dt) GROUP BY ALL),
raw AS (SELECT term, df, ln(n_docs-df+0.5::DOUBLE)-ln(df+0.5::DOUBLE) AS r FROM (SELECT term, count(*) AS df FROM post GROUP BY term), cs),
idf AS (SELECT term, df, CASE WHEN r < 0 THEN 0.25::DOUBLE*(SELECT avg(r) FROM raw) ELSE r END AS idf FROM raw)"""
_WORDS = f"""{_DOCS}, qt AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT item_id AS query_id, unnest({words_sql('text')}) AS term FROM benchmark) GROUP BY ALL),
sc AS (SELECT query_id, doc_id, CAST(sum(CAST(round(qtf*idf*tf*2.5::DOUBLE/(tf+1.5::DOUBLE*(0.25::DOUBLE+0.75::DOUBLE*dl/avgdl))*1e10) AS BIGINT)) AS DOUBLE)/1e10 AS bm25
  FROM qt JOIN idf ON qt.term=idf.term JOIN post ON post.term=qt.term, cs GROUP BY query_id, doc_id),
lr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY bm25 DESC, doc_id) AS rank FROM sc WHERE bm25 > 0)"""
_NORM = "(sqrt(list_inner_product({v}::DOUBLE[],{v}::DOUBLE[]))+1e-12)"
_VECTORS = f"""vs AS (SELECT q.vec_id AS query_id, d.vec_id AS doc_id,
  round(list_inner_product(q.embedding::DOUBLE[], d.embedding::DOUBLE[])/({_NORM.format(v='q.embedding')}*{_NORM.format(v='d.embedding')}),9) AS sim
  FROM embeddings q JOIN benchmark ON item_id=q.vec_id, embeddings d),
vr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, doc_id) AS rank FROM vs)"""


def fused_sql(k: int, min_sim: float, cap: int, limit: int) -> str:
    """CTE ``kept``: fused, filtered and limited hits."""
    cut = f"WHERE rank <= {k}" if k > 0 else ""
    vector = f"(SELECT * FROM vr {cut})"
    return f"""ll AS (SELECT * FROM lr {cut}), vl AS {vector},
fu AS (SELECT query_id, doc_id, CAST(sum(CAST(round(1.0::DOUBLE/(60+rank)*1e10) AS BIGINT)) AS DOUBLE)/1e10 AS rrf
  FROM (SELECT query_id, doc_id, rank FROM ll UNION ALL SELECT query_id, doc_id, rank FROM vl) GROUP BY ALL),
fr AS (SELECT fu.*, row_number() OVER (PARTITION BY fu.query_id ORDER BY rrf DESC, fu.doc_id) AS rank, sim, coalesce(sim, 0) AS similarity, bm25
  FROM fu LEFT JOIN vl ON fu.query_id=vl.query_id AND fu.doc_id=vl.doc_id LEFT JOIN ll ON fu.query_id=ll.query_id AND fu.doc_id=ll.doc_id),
ks AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY query_id, sim IS NULL ORDER BY rank) AS n FROM fr) WHERE (sim >= {min_sim}) OR (sim IS NULL AND n <= {cap})),
kept AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS n FROM ks) {f'WHERE n <= {limit}' if limit else ''})"""


_FUSED = f"{_WORDS}, {_VECTORS}, {fused_sql(K, 0.5, 20, 30)}"


_opened: dict[tuple[str, str], str] = {}


def index_of(spark, sf):
    """The stored index of the reviews in ``sf``: built once per application, then only opened."""
    name = (spark.sparkContext.applicationId, str(sf))
    if name not in _opened:
        folder = sinks.work_folder(spark, "index")
        index_store.build(reviews(spark, sf), folder, vectors=doc_vectors(spark, sf), config={"embedding_dim": "64"})
        _opened[name] = folder
    return index_store.StoredIndex(spark, _opened[name])


def query_texts(spark, sf):
    return search_queries(spark, sf).select("query_id", "query")


def vector_sides(spark, sf):
    queries = search_queries(spark, sf).select("query_id", F.col("embedding").alias("vector"))
    return queries, doc_vectors(spark, sf).select("doc_id", F.col("embedding").alias("vector"))


# ------------------------------------------------------------------- index
@R.add("bm25_index", f"WITH {_DOCS} SELECT term, doc_id, tf, dl FROM post")
def _(spark, sf):
    return index_of(spark, sf).postings().select("term", "doc_id", "tf", "dl")


@R.add("bm25_idf", f"WITH {_DOCS} SELECT term, df, round(idf,6) AS idf FROM idf")
def _(spark, sf):
    return rounded(index_of(spark, sf).terms)


@R.add("bm25_score", f"WITH {_WORDS} SELECT query_id, doc_id, round(bm25,6) AS bm25 FROM sc")
def _(spark, sf):
    return rounded(index_of(spark, sf).scores(query_texts(spark, sf)))


@R.add("join_terms", f"WITH {_WORDS} SELECT query_id, count(*) AS matches, sum(qtf*tf) AS weight FROM qt JOIN post ON qt.term=post.term GROUP BY query_id")
def _(spark, sf):
    index = index_of(spark, sf)
    joined = lookup_join(index.postings(), index.query_terms(query_texts(spark, sf)), "term", "inner")
    return joined.groupBy("query_id").agg(F.count("*").alias("matches"), F.sum(F.col("qtf") * F.col("tf")).alias("weight"))


@R.add("bm25_topk", f"WITH {_WORDS} SELECT query_id, doc_id, rank, round(bm25,6) AS bm25 FROM lr WHERE rank <= 20")
def _(spark, sf):
    return rounded(index_of(spark, sf).top_documents(query_texts(spark, sf), 20))


@R.add("rank_list", f"WITH {_WORDS} SELECT query_id, doc_id, rank FROM lr")
def _(spark, sf):
    return index_of(spark, sf).top_documents(query_texts(spark, sf), 0).select("query_id", "doc_id", "rank")


@R.add("score_positive", f"WITH {_WORDS} SELECT query_id, count(*) AS n FROM sc WHERE bm25 > 0 GROUP BY query_id")
def _(spark, sf):
    scores = index_of(spark, sf).scores(query_texts(spark, sf)).filter(F.col("bm25") > 0)
    return scores.groupBy("query_id").agg(F.count("*").alias("n"))


@R.add("sink_index", f"""WITH {_DOCS} SELECT (SELECT count(*) FROM post) AS postings, (SELECT count(*) FROM idf) AS terms, (SELECT count(*) FROM reviews) AS reviews,
  (SELECT count(*) FROM embeddings) AS vectors, n_docs, round(avgdl,6) AS avgdl FROM cs""")
def _(spark, sf):
    folder = sinks.work_folder(spark, "index")
    index = index_store.build(reviews(spark, sf), folder, vectors=doc_vectors(spark, sf))
    count = lambda df, name: df.agg(F.count("*").alias(name)).select(name).scalar()
    tables = {"postings": index.postings(), "terms": index.terms, "reviews": index.reviews, "vectors": index.vectors()}
    return rounded(index.corpus.select(*[count(t, n).alias(n) for n, t in tables.items()], "n_docs", "avgdl"))


@R.add("src_index", f"WITH {_WORDS} SELECT query_id, doc_id, rank, round(bm25,6) AS bm25 FROM lr WHERE rank <= 10")
def _(spark, sf):
    folder = sinks.work_folder(spark, "index")
    index_store.build(reviews(spark, sf), folder)
    return rounded(index_store.StoredIndex(spark, folder).top_documents(query_texts(spark, sf), 10))


# ---------------------------------------------------------------- fallback
_CASES = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"  # engines differ in the upper case of other letters
_TEXTS = " UNION ".join(f"SELECT DISTINCT translate({x}, '{_CASES[0]}', '{_CASES[1]}') AS query FROM {t}" for x, t in (
    ("text", "benchmark"), ("substring(html, 1, 9)", "pages"), ("title", "reviews")))


def fallback_texts(spark, sf):
    """Whole benchmark passages, beginnings of pages and titles, in another case than the reviews."""
    from creditecho.sources.tables import table

    sides = ((table(spark, sf, "benchmark"), "text"), (table(spark, sf, "pages").select(F.substring("html", 1, 9).alias("html")), "html"), (reviews(spark, sf), "title"))
    texts = reduce(lambda a, b: a.union(b), (t.select(F.translate(c, *_CASES).alias("query")) for t, c in sides)).distinct()
    return texts.withColumn("query_id", F.xxhash64("query"))


@R.add("substring_fallback", f"""WITH {REVIEWS}, q AS ({_TEXTS})
SELECT query, id AS doc_id FROM q, reviews WHERE contains(lower(feedback), lower(query)) OR contains(lower(title), lower(query))""")
def _(spark, sf):
    queries = fallback_texts(spark, sf)
    return index_of(spark, sf).substring_matches(queries).join(queries, "query_id").select("query", "doc_id")


# ----------------------------------------------------------------- vectors
@R.add("knn_exact", f"WITH {_VECTORS} SELECT query_id, doc_id, rank, round(sim,6) AS sim FROM vr WHERE rank <= 10")
def _(spark, sf):
    near = knn.nearest(*vector_sides(spark, sf), 10)
    return rounded(near.select("query_id", "doc_id", "rank", (-F.col("distance")).alias("sim")))


@R.add("vec_topk", f"WITH {_VECTORS} SELECT query_id, doc_id, rank, round(sim,6) AS sim FROM vr")
def _(spark, sf):
    near = P.vector_list(search_queries(spark, sf), doc_vectors(spark, sf), 0)
    return rounded(near.select("query_id", "doc_id", "rank", (-F.col("distance")).alias("sim")))


@R.add("join_knn", f"WITH {_VECTORS} SELECT query_id, doc_id, round(sim,6) AS sim FROM vs WHERE sim >= 0.5")
def _(spark, sf):
    found = knn.similar(*vector_sides(spark, sf), 0.5)
    return rounded(found.select("query_id", "doc_id", (-F.col("distance")).alias("sim")))


_SELF = f"""s AS (SELECT a.vec_id AS query_id, b.vec_id AS doc_id, round(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])/({_NORM.format(v='a.embedding')}*{_NORM.format(v='b.embedding')}),9) AS sim
  FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id)"""


@R.add("knn_cells", f"WITH {_SELF} SELECT query_id, round(max(sim),6) AS best FROM s GROUP BY query_id")
def _(spark, sf):
    _, c = vector_sides(spark, sf)
    q = c.withColumnRenamed("doc_id", "query_id")
    near = knn.nearest(q, c, 1, exclude_self=True, scan_queries=0, pivots=32)
    return rounded(near.select("query_id", (-F.col("distance")).alias("best")))


@R.add("knn_approx")
def _(spark, sf):
    return knn.nearest(*vector_sides(spark, sf), 10, pivots=32, probes=26).select("query_id", "doc_id", "rank", "distance")


@R.add("embed_docs")
def _(spark, sf):
    from creditecho.operators.encoder import fit_encoder

    docs = reviews(spark, sf)
    return fit_encoder(docs, "feedback").encode(docs, "feedback").select("id", F.size("embedding").alias("dim"))


@R.add("embed_query")
def _(spark, sf):
    from creditecho.operators.encoder import fit_encoder

    model = fit_encoder(reviews(spark, sf), "feedback")
    return model.encode(query_texts(spark, sf), "query").select("query_id", F.size("embedding").alias("dim"))


# ------------------------------------------------------------------ fusion
def lists(spark, sf):
    """Both ranked lists, written once: fusion, similarities and reranking read them repeatedly."""
    words = P.word_list(index_of(spark, sf), query_texts(spark, sf), OPTIONS)
    near = P.vector_list(search_queries(spark, sf), doc_vectors(spark, sf), K)
    return words, stored(near, "vector-list")


_LISTS = f"{_WORDS}, {_VECTORS}, {fused_sql(K, 0.5, 20, 0)}"


@R.add("rrf", f"WITH {_LISTS} SELECT query_id, doc_id, rank, round(rrf,6) AS rrf FROM fr")
def _(spark, sf):
    words, near = lists(spark, sf)
    return rounded(fusion.rrf(fusion.ranked_lists(bm25=words, vectors=near)))


@R.add("join_fuse", f"WITH {_LISTS} SELECT query_id, doc_id, round(rrf,6) AS rrf FROM fu")
def _(spark, sf):
    words, near = lists(spark, sf)
    return rounded(fusion.rrf_scores(fusion.ranked_lists(bm25=words, vectors=near)))


@R.add("join_sim", f"WITH {_LISTS} SELECT query_id, doc_id, rank, round(similarity,6) AS similarity FROM fr")
def _(spark, sf):
    words, near = lists(spark, sf)
    fused = fusion.with_similarity(fusion.rrf(fusion.ranked_lists(bm25=words, vectors=near)), near)
    return rounded(fused.select("query_id", "doc_id", "rank", "similarity"))


@R.add("min_sim_filter", f"WITH {_LISTS} SELECT query_id, doc_id, rank FROM ks")
def _(spark, sf):
    words, near = lists(spark, sf)
    fused = fusion.with_similarity(fusion.rrf(fusion.ranked_lists(bm25=words, vectors=near)), near)
    return fusion.min_sim_filter(fused, 0.5, 20).select("query_id", "doc_id", "rank")


@R.add("limit_after_filter", f"WITH {_FUSED} SELECT query_id, doc_id, rank, round(similarity,6) AS similarity FROM kept")
def _(spark, sf):
    hits = P.fused_hits(index_of(spark, sf), search_queries(spark, sf), options=OPTIONS)
    return rounded(hits.select("query_id", "doc_id", "rank", "similarity"))


@R.add("rerank", f"""WITH {_LISTS}, b AS (SELECT query_id, doc_id, round(0.5::DOUBLE*coalesce(bm25,0)/(coalesce(bm25,0)+10)+0.5::DOUBLE*similarity,9) AS s FROM fr)
SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) AS rank, round(s,6) AS rerank_score FROM b""")
def _(spark, sf):
    words, near = lists(spark, sf)
    fused = fusion.with_similarity(fusion.rrf(fusion.ranked_lists(bm25=words, vectors=near)), near)
    fused = fused.join(words.select("query_id", "doc_id", "bm25"), ["query_id", "doc_id"], "left")
    return rounded(fusion.rerank(fused, fusion.blended_score).select("query_id", "doc_id", "rank", "rerank_score"))


@R.add("join_query_docs", f"WITH {_WORDS} SELECT lr.query_id, doc_id, md5(text) AS query_md5, md5(feedback) AS text_md5 FROM lr JOIN benchmark ON item_id=query_id JOIN reviews ON id=doc_id WHERE rank <= 10")
def _(spark, sf):
    hits = index_of(spark, sf).top_documents(query_texts(spark, sf), 10).select("query_id", "doc_id")
    pairs = P.fetch_reviews(hits, index_of(spark, sf).reviews, ("id", "feedback")).join(query_texts(spark, sf), "query_id")
    return pairs.select("query_id", "doc_id", F.md5("query").alias("query_md5"), F.md5("feedback").alias("text_md5"))


@R.add("join_meta", f"WITH {_WORDS} SELECT query_id, doc_id, rank, score, title, sentiment_label FROM lr JOIN reviews ON id=doc_id WHERE rank <= 10")
def _(spark, sf):
    hits = index_of(spark, sf).top_documents(query_texts(spark, sf), 10)
    return P.fetch_reviews(hits, index_of(spark, sf).reviews).select("query_id", "doc_id", "rank", "score", "title", "sentiment_label")


@R.add("sentiment_cap", f"""WITH {_WORDS} SELECT query_id, doc_id, rank, CASE WHEN rank <= 5 THEN sentiment_label END AS sentiment_label,
  CASE WHEN rank <= 5 THEN sentiment_score END AS sentiment_score FROM lr JOIN reviews ON id=doc_id WHERE rank <= 20""")
def _(spark, sf):
    hits = index_of(spark, sf).top_documents(query_texts(spark, sf), 20)
    found = S.cap_sentiment(P.fetch_reviews(hits, index_of(spark, sf).reviews), 5)
    return found.select("query_id", "doc_id", "rank", "sentiment_label", "sentiment_score")


# ---------------------------------------------------------------- searches
def metrics_sql(source: str, by: str) -> str:
    """CTE ``met``: all sentiment metrics per group of ``source``."""
    parts = ", ".join(by.split(","))
    on = " AND ".join(f"b.{c.strip()}=p.{c.strip()}" for c in by.split(","))
    ratios = ", ".join(
        f"CASE WHEN count(sentiment_label) > 0 THEN count(*) FILTER (WHERE sentiment_label='{k}')::DOUBLE/count(sentiment_label) END AS class_ratio_{k}"
        for k in S.LABELS
    )
    safe = "CASE WHEN stddev_pop({x}) > 1e-12 AND stddev_pop({y}) > 1e-12 THEN corr({x},{y}) END"
    return f"""mc AS (SELECT *, CASE WHEN sentiment_score <= -0.2 THEN 'negative' WHEN sentiment_score >= 0.2 THEN 'positive' WHEN sentiment_score IS NOT NULL THEN 'neutral' END AS k FROM {source}),
mb AS (SELECT {parts}, count(*) AS count, CAST(sum(CAST(round(sentiment_score*1e10) AS BIGINT)) AS DOUBLE)/1e10/nullif(count(sentiment_score),0) AS sentiment_mean, quantile_cont(sentiment_score,0.5) AS sentiment_median, stddev_samp(sentiment_score) AS sentiment_std, {ratios},
  avg(CASE WHEN k='negative' THEN 1.0::DOUBLE ELSE 0 END) FILTER (WHERE score <= 2 AND k IS NOT NULL) AS rate_negative_for_score_le_2,
  avg(CASE WHEN k='positive' THEN 1.0::DOUBLE ELSE 0 END) FILTER (WHERE score >= 3 AND k IS NOT NULL) AS rate_positive_for_score_ge_3,
  avg(CASE WHEN k='negative' THEN 1.0::DOUBLE ELSE 0 END) AS negative_rate, avg(CASE WHEN k='positive' THEN 1.0::DOUBLE ELSE 0 END) AS positive_rate FROM mc GROUP BY {parts}),
mr AS (SELECT {parts}, (score-3)/2 AS x, sentiment_score AS y, rank() OVER (PARTITION BY {parts} ORDER BY score) + (count(*) OVER (PARTITION BY {parts}, score)-1)/2.0::DOUBLE AS rx,
  rank() OVER (PARTITION BY {parts} ORDER BY sentiment_score) + (count(*) OVER (PARTITION BY {parts}, sentiment_score)-1)/2.0::DOUBLE AS ry FROM mc WHERE sentiment_score IS NOT NULL AND score IS NOT NULL),
mp AS (SELECT {parts}, {safe.format(x='x', y='y')} AS corr_pearson_score_vs_sentiment, {safe.format(x='rx', y='ry')} AS corr_spearman_score_vs_sentiment FROM mr GROUP BY {parts}),
met AS (SELECT b.*, p.corr_pearson_score_vs_sentiment, p.corr_spearman_score_vs_sentiment FROM mb b LEFT JOIN mp p ON {on})"""


METRICS = [
    "sentiment_mean", "sentiment_median", "sentiment_std", "class_ratio_negative", "class_ratio_positive", "class_ratio_neutral",
    "corr_pearson_score_vs_sentiment", "corr_spearman_score_vs_sentiment", "rate_negative_for_score_le_2", "rate_positive_for_score_ge_3",
]
_SHOW = "count, " + ", ".join(f"round({m},6) AS {m}" for m in METRICS)
_BASE = f"{_WORDS}, res AS (SELECT query_id, doc_id, rank, score, title, sentiment_label, sentiment_score FROM lr JOIN reviews ON id=doc_id)"


@R.add("sentiment_agg", f"WITH {REVIEWS}, {metrics_sql('reviews', 'title')} SELECT title, {_SHOW} FROM met")
def _(spark, sf):
    return rounded(S.sentiment_summary(reviews(spark, sf), ["title"]))


@R.add("search_baseline", f"WITH {_BASE}, {metrics_sql('res', 'query_id')} SELECT query_id, {_SHOW} FROM met")
def _(spark, sf):
    found = P.search_baseline(index_of(spark, sf), query_texts(spark, sf))
    return rounded(P.summarize(found))


@R.add("search_baseline_fb", f"""WITH {_DOCS},
q AS ({_TEXTS}),
hit AS (SELECT DISTINCT query, doc_id FROM (SELECT query, unnest({words_sql('query')}) AS t FROM q) JOIN post ON term = t),
res AS (SELECT query, id AS doc_id FROM q, reviews WHERE query NOT IN (SELECT query FROM hit) AND (contains(lower(feedback), lower(query)) OR contains(lower(title), lower(query)))
  UNION ALL SELECT query, doc_id FROM hit)
SELECT query, doc_id, score, title FROM res JOIN reviews ON id=doc_id""")
def _(spark, sf):
    queries = fallback_texts(spark, sf)
    found = P.search_baseline(index_of(spark, sf), queries, fallback=True)
    return found.join(queries, "query_id").select("query", "doc_id", "score", "title")


_ALL = f"{_WORDS}, {_VECTORS}, {fused_sql(0, 0.5, 1000, 0)}"


@R.add("search_hybrid", f"""WITH {_ALL} SELECT query_id, doc_id, round(similarity,6) AS similarity, round(rrf,6) AS rrf, score, title, timestamp, sentiment_label, sentiment_score
FROM kept JOIN reviews ON id=doc_id""")
def _(spark, sf):
    found = P.search_hybrid(index_of(spark, sf), search_queries(spark, sf))
    return rounded(found.select(
        "query_id", "doc_id", "similarity", "rrf", "score", "title", "timestamp", "sentiment_label", "sentiment_score"
    ))


@R.add("sink_results", f"""WITH {_FUSED}, n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS n FROM kept)
SELECT substring(regexp_replace(text,'[^\\p{{L}}\\p{{N}}_]+','_','g'),1,40) AS query_slug, n.query_id, doc_id, rank, score, title FROM n JOIN benchmark ON item_id=query_id JOIN reviews ON id=doc_id WHERE n <= 5""")
def _(spark, sf):
    folder = sinks.work_folder(spark, "results")
    found = P.search_hybrid(index_of(spark, sf), search_queries(spark, sf), options=OPTIONS)
    named = found.join(query_texts(spark, sf), "query_id").select("query_id", "query", "doc_id", "rank", "score", "title")
    sinks.write_results(named, folder)
    back = spark.read.schema("query_id long, query string, doc_id long, rank long, score double, title string").option(
        "header", True).option("escape", '"').option("multiLine", True).csv(folder)
    return back.select(slug(F.col("query")).alias("query_slug"), "query_id", "doc_id", "rank", "score", "title")


# -------------------------------------------------------------- evaluation
_BOTH = f"""{_FUSED}, pair AS (
  SELECT query_id, 'baseline' AS side, score, sentiment_label, sentiment_score FROM lr JOIN reviews ON id=doc_id WHERE rank <= 30
  UNION ALL SELECT query_id, 'rag', score, sentiment_label, sentiment_score FROM kept JOIN reviews ON id=doc_id), {metrics_sql('pair', 'query_id,side')}"""


def both_sides(spark, sf):
    return P.evaluate_queries(index_of(spark, sf), search_queries(spark, sf), options=OPTIONS)


@R.add("eval_queries", f"WITH {_BOTH} SELECT query_id, side, {_SHOW}, round(negative_rate,6) AS negative_rate, round(positive_rate,6) AS positive_rate FROM met")
def _(spark, sf):
    return rounded(both_sides(spark, sf))


_SIDES = {"coverage": "count", "positive_ratio": "coalesce(class_ratio_positive,0)", "negative_ratio": "coalesce(class_ratio_negative,0)",
          "neutral_ratio": "coalesce(class_ratio_neutral,0)", "mean_sentiment": "sentiment_mean"}


@R.add("compare_sides", f"""WITH {_BOTH}, w AS (SELECT query_id, {", ".join(f"max({x}) FILTER (WHERE side='{s}') AS {s}_{n}" for n, x in _SIDES.items() for s in ("baseline", "rag"))} FROM met GROUP BY query_id)
SELECT query_id, {", ".join(f"round({s}_{n},6) AS {s}_{n}" for n in _SIDES for s in ("baseline", "rag"))}, {", ".join(f"round(rag_{n}-baseline_{n},6) AS {n}_difference" for n in _SIDES)} FROM w""")
def _(spark, sf):
    return rounded(I.compare_sides(both_sides(spark, sf)))


@R.add("insight_bands", f"""WITH {_BOTH} SELECT query_id, CASE WHEN negative_rate >= 0.6 THEN 'high' WHEN negative_rate >= 0.4 THEN 'medium' ELSE 'low' END AS dissatisfaction,
  CASE WHEN positive_rate >= 0.6 THEN 'dominant' WHEN positive_rate <= 0.3 THEN 'low' END AS positivity,
  CASE WHEN abs(corr_pearson_score_vs_sentiment) >= 0.5 THEN 'high' ELSE 'medium/low' END AS correlation,
  round(abs(corr_pearson_score_vs_sentiment)*100,4) AS correlation_percent FROM met WHERE side='rag'""")
def _(spark, sf):
    rag = both_sides(spark, sf).filter("side = 'rag'")
    out = I.insight_bands(rag).select("query_id", "dissatisfaction", "positivity", "correlation", "correlation_percent")
    return rounded(out, 4)


_FLAT = ", ".join(f"""max({m}) FILTER (WHERE side='{s}') AS "{s}.{m}\"""" for s in ("baseline", "rag") for m in ["count", *METRICS])
_FLAT_OUT = ", ".join(f"""round("{s}.{m}",6) AS "{s}.{m}\"""" for s in ("baseline", "rag") for m in ["count", *METRICS])


@R.add("metrics_flat", f"WITH {_BOTH}, w AS (SELECT query_id, {_FLAT} FROM met GROUP BY query_id) SELECT query_id, {_FLAT_OUT} FROM w")
def _(spark, sf):
    wide = I.flat_metrics(both_sides(spark, sf), ["count", *METRICS])
    return wide.select("query_id", *[
        (F.round(F.col(f"`{c}`"), 6) + 0.0 if t == "double" else F.col(f"`{c}`")).alias(c) for c, t in wide.dtypes if c != "query_id"
    ])


@R.add("sink_metrics", f"""WITH {_BOTH} SELECT round(100*avg(rate_negative_for_score_le_2),6) AS negative_percent, round(100*avg(rate_positive_for_score_ge_3),6) AS positive_percent,
  count(*) AS n_queries FROM met WHERE side='rag'""")
def _(spark, sf):
    folder = sinks.work_folder(spark, "metrics")
    sinks.write_table_csv(both_sides(spark, sf).filter("side = 'rag'"), folder)
    back = spark.read.option("header", True).option("inferSchema", True).csv(folder)
    return rounded(back.agg(
        (100 * F.avg("rate_negative_for_score_le_2")).alias("negative_percent"),
        (100 * F.avg("rate_positive_for_score_ge_3")).alias("positive_percent"), F.count("*").alias("n_queries"),
    ))

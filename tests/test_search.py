import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from creditecho.config import SearchOptions
from creditecho.operators import encoder, fusion, knn
from creditecho.operators import sentiment as S
from creditecho.plans import search as P


@pytest.fixture(scope="module")
def reviews(spark):
    texts = ["red apple red", "green apple", "blue sky", "apple pie and apple tart", "sky sky sky", "green tea leaf", "grey cat"]
    rows = [(i, float(1 + i % 5), f"title {i}", t, None, "positive" if i % 2 else "negative", 0.5 if i % 2 else -0.5) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "id long, score double, title string, feedback string, timestamp timestamp, sentiment_label string, sentiment_score double"
    )


def brute_bm25(texts, query, k1=1.5, b=0.75):
    docs = [t.split() for t in texts]
    avg = sum(map(len, docs)) / len(docs)
    df = {w: sum(w in d for d in docs) for d in docs for w in d}
    idf = {w: math.log(len(docs) - n + 0.5) - math.log(n + 0.5) for w, n in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {w: (0.25 * mean if v < 0 else v) for w, v in idf.items()}
    return [
        sum(idf.get(w, 0) * d.count(w) * (k1 + 1) / (d.count(w) + k1 * (1 - b + b * len(d) / avg)) for w in query.split())
        for d in docs
    ]


def test_bm25_equals_the_formula_and_repeats_count(spark, reviews):
    texts = [r.feedback for r in reviews.orderBy("id").collect()]
    queries = spark.createDataFrame([(1, "apple apple sky"), (2, "zzzz")], "query_id long, query string")
    index = P.opened(reviews)
    got = {r.doc_id: r.bm25 for r in index.top_documents(queries).collect()}
    want = brute_bm25(texts, "apple apple sky")
    assert got == pytest.approx({i: s for i, s in enumerate(want) if s > 0}, abs=1e-8)
    assert [r.doc_id for r in index.top_documents(queries, 2).orderBy("rank").collect()] == list(np.argsort([-w for w in want], kind="stable")[:2])


def test_substring_fallback_only_for_queries_without_hits(spark, reviews):
    queries = spark.createDataFrame([(1, "apple"), (2, "APP"), (3, "TITLE 6"), (4, "nothing here")], "query_id long, query string")
    got = P.search_baseline(reviews, queries, fallback=True)
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, []).append(r.doc_id)
    assert sorted(found[1]) == [0, 1, 3] and sorted(found[2]) == [0, 1, 3] and found[3] == [6] and 4 not in found


def test_rank_fusion_and_order_of_lists(spark):
    a = spark.createDataFrame([(1, 1, 1), (1, 2, 2)], "query_id long, doc_id long, rank long")
    b = spark.createDataFrame([(1, 2, 1), (1, 3, 2)], "query_id long, doc_id long, rank long")
    for lists in ({"x": a, "y": b}, {"y": b, "x": a}):
        got = {r.doc_id: (r.rank, r.rrf) for r in fusion.rrf(fusion.ranked_lists(**lists)).collect()}
        assert {d: r for d, (r, _) in got.items()} == {2: 1, 1: 2, 3: 3}
        assert got[2][1] == pytest.approx(1 / 62 + 1 / 61, abs=1e-9) and got[3][1] == pytest.approx(1 / 62, abs=1e-9)


def test_similarity_filter_keeps_first_word_hits(spark):
    sims = [0.9, None, 0.1, None, None]
    fused = spark.createDataFrame([(1, i, i + 1, s) for i, s in enumerate(sims)], "query_id long, doc_id long, rank long, sim double")
    assert sorted(r.rank for r in fusion.min_sim_filter(fused, 0.5, 2).collect()) == [1, 2, 4]
    assert fusion.min_sim_filter(fused, 0.0).count() == 5
    assert [r.rank for r in fusion.limit_per_query(fused, 2).collect()] == [1, 2]


def test_hybrid_reports_zero_similarity_for_word_hits(spark, reviews):
    vectors = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(4)], "doc_id long, embedding array<float>")
    queries = spark.createDataFrame([(1, "sky", [1.0, 0.0])], "query_id long, query string, embedding array<float>")
    for options in (SearchOptions(min_sim=0.5), SearchOptions(k_lex=10, k_vec=10, min_sim=0.5)):
        got = {r.doc_id: r.similarity for r in P.search_hybrid(reviews, queries, vectors, options).collect()}
        assert got == pytest.approx({0: 1.0, 1: 1 / math.sqrt(2), 4: 0.0})


@pytest.mark.parametrize("metric", ["cosine", "euclidean", "manhattan"])
def test_neighbours_equal_brute_force_with_copies(spark, metric):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(300, 6))
    m[:100] = m[0]  # a third of the rows are copies
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "doc_id long, vector array<double>")
    queries = rows.withColumnRenamed("doc_id", "query_id")
    unit = m / (np.linalg.norm(m, axis=1, keepdims=True) + 1e-12) if metric == "cosine" else m
    d = np.round(np.stack([knn._exact(np.repeat(q[None], 300, 0), unit, metric) for q in unit]), 9)
    np.fill_diagonal(d, np.inf)
    want = {(q, r + 1): (int(c), d[q, c]) for q in range(300) for r, c in enumerate(np.lexsort((np.arange(300), d[q]))[:4])}
    for options in ({}, {"scan_queries": 0, "pivots": 16, "tile_rows": 40}):
        found = knn.nearest(queries, rows, 4, metric, exclude_self=True, **options).collect()
        assert len(found) == 1200
        for r in found:
            assert want[(r.query_id, r.rank)] == (r.doc_id, pytest.approx(r.distance, abs=1e-8))


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_zero_vectors_and_copies_give_the_same_lists_by_scan_and_cells(spark, metric):
    rng = np.random.default_rng(8)
    m = rng.normal(size=(120, 3)) + 1.5
    m[::9] = 0.0
    m[100:] = m[50]
    m[60:75] *= -1
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "doc_id long, vector array<double>")
    queries = rows.withColumnRenamed("doc_id", "query_id")
    unit = np.divide(m, np.linalg.norm(m, axis=1, keepdims=True), where=m.any(1, keepdims=True), out=np.zeros_like(m)) if metric == "cosine" else m
    d = np.round(np.stack([knn._exact(np.repeat(q[None], len(m), 0), unit, metric) for q in unit]), 9) + 0.0
    np.fill_diagonal(d, np.inf)
    want = sorted((q, r + 1, int(c)) for q in range(len(m)) for r, c in enumerate(np.lexsort((np.arange(len(m)), d[q]))[:5]))
    for options in ({}, {"scan_queries": 0, "pivots": 12, "tile_rows": 30}):
        found = knn.nearest(queries, rows, 5, metric, exclude_self=True, **options).collect()
        assert sorted((r.query_id, r.rank, r.doc_id) for r in found) == want
    nothing = rows.filter("doc_id % 9 = 0 AND doc_id < 100")
    only = knn.nearest(queries, nothing, 3, "cosine", scan_queries=0).filter("query_id = 1").orderBy("rank").collect()
    assert [(r.doc_id, r.distance) for r in only] == [(0, 0.0), (9, 0.0), (18, 0.0)]
    assert knn.nearest(queries, rows.filter("false"), 3, metric, scan_queries=0).count() == 0


def test_approximate_neighbours_reach_most_of_the_exact_ones(spark):
    rng = np.random.default_rng(6)
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(500, 4)))], "doc_id long, vector array<double>")
    queries = rows.withColumnRenamed("doc_id", "query_id")
    exact = knn.nearest(queries, rows, 5).select("query_id", "doc_id")
    close = knn.nearest(queries, rows, 5, pivots=16, probes=6).select("query_id", "doc_id")
    assert exact.join(close, ["query_id", "doc_id"]).count() / exact.count() > 0.9


def test_registered_approximate_search_reaches_nine_tenths(spark):
    from creditecho.catalog import all_runs

    runs, sf = all_runs(), "/root/testdata/sf0.01"
    exact, close = ({(r.query_id, r.doc_id) for r in runs[name](spark, sf).collect()} for name in ("knn_exact", "knn_approx"))
    assert len(exact & close) >= 0.9 * len(exact) > 0


def test_lexicon_model_and_stored_sentiment(spark, reviews):
    lexicon = spark.createDataFrame([("apple", 1.0), ("sky", -3.0)], "token string, weight double")
    got = {r.id: (r.sentiment_label, r.sentiment_score) for r in S.lexicon_sentiment(reviews, lexicon).collect()}
    assert got[0] == ("positive", 1.0) and got[2] == ("negative", -1.0) and got[6] == (None, None)

    def model(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"sentiment_label": ["neutral"] * len(texts), "sentiment_score": [0.0] * len(texts)})

    computed = S.model_sentiment(reviews, model)
    stored = reviews.withColumn("sentiment_score", F.when(F.col("id") > 0, F.col("sentiment_score")))
    assert {r.id: r.sentiment_score for r in S.prefer_stored(stored, computed).collect()}[0] == 0.0


def test_encoders_give_unit_vectors(spark, reviews):
    rows = encoder.fit_encoder(reviews, "feedback", 32).encode(reviews, "feedback").collect()
    assert all(np.linalg.norm(r.embedding) == pytest.approx(1, abs=1e-5) for r in rows)
    own = encoder.encode_with(reviews, lambda t: np.stack([t.str.len(), t.str.count("a") + 1], axis=1), "id", "feedback", "passage")
    assert all(np.linalg.norm(r.embedding) == pytest.approx(1, abs=1e-5) for r in own.collect())


def test_query_encoder_lemmas_and_sentiment_limit(spark, reviews):
    model = encoder.fit_encoder(reviews, "feedback")
    vectors = model.encode(reviews, "feedback").select(F.col("id").alias("doc_id"), "embedding")
    texts = spark.createDataFrame([(1, "sky")], "query_id long, query string")
    given = model.encode(texts, "query")
    options = SearchOptions(k_lex=5, k_vec=3, min_sim=0.1, sentiment_limit=1)
    got = P.search_hybrid(reviews, texts, vectors, options, encoder=model).collect()
    want = P.search_hybrid(reviews, given, vectors, options).collect()
    key = lambda rows: sorted((r.doc_id, r.rank, round(r.rrf, 9), r.sentiment_score) for r in rows)
    assert key(got) == key(want) and len(got) > 1
    assert all(r.sentiment_score is None for r in got if r.rank > 1)
    with pytest.raises(ValueError):
        P.search_hybrid(reviews, texts, vectors, options)
    lemmas = spark.createDataFrame([("apples", "apple"), ("skies", "sky")], "token string, lemma string")
    index = P.opened(reviews, lemmas=lemmas)
    many = spark.createDataFrame([(1, "skies"), (2, "apples")], "query_id long, query string")
    found = {(r.query_id, r.doc_id) for r in index.top_documents(many).collect()}
    assert found == {(1, 2), (1, 4), (2, 0), (2, 1), (2, 3)}

"""Review queries: sources, text, cleaning, sentiment and topics."""
from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditecho.catalog.registry import Registry, rounded
from creditecho.catalog.views import RAW_REVIEWS, REVIEWS
from creditecho.config import TURKISH_STOP_WORDS
from creditecho.functions import text as T
from creditecho.functions import vectors as V
from creditecho.operators import bm25
from creditecho.operators import cleaning as C
from creditecho.operators import insights as I
from creditecho.operators import sentiment as S
from creditecho.operators import totals as O
from creditecho.session import stored
from creditecho.sources import readers, sinks
from creditecho.sources.tables import doc_vectors, raw_reviews, reviews, table

R = Registry()


def words_sql(t: str) -> str:
    return (
        f"list_filter(string_split_regex(regexp_replace(lower({t}),'[^\\p{{L}}\\p{{N}}_\\s]',' ','g'),'\\s+'), lambda w: w <> '')"
    )


_SPACE = r"trim(regexp_replace({t},'\s+',' ','g'))"
_EMAIL = r"regexp_replace({t},'[\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}_.\-]*@[\p{{L}}\p{{N}}_.\-]+\.[\p{{L}}\p{{N}}_]{{2,}}',' ','g')"
_PHONE = r"regexp_replace({t},'\+?[0-9][0-9\-\s]{{7,}}[0-9]',' ','g')"
_URL = r"regexp_replace({t},'(https?://\S+|www\.\S+)',' ','g')"
_HTML = "regexp_replace({t},'<[^>]+>',' ','g')"
_NBSP = "translate({t}, chr(8203) || chr(160), '  ')"


def clean_sql(t: str) -> str:
    for step in (_NBSP, _HTML, _URL, _EMAIL, _PHONE, _SPACE):
        t = step.format(t=t)
    return t


# ----------------------------------------------------------------- sources
@R.add("src_review_pick", f"WITH {REVIEWS} SELECT id, score, title, feedback, timestamp FROM reviews")
def _(spark, sf):
    raw = reviews(spark, sf).select(
        F.col("id").alias("ID"), F.col("score").alias("Score"), F.col("title").alias("TITLE"),
        F.col("feedback").alias("Feedback"), F.col("timestamp").alias("Timestamp"), "sentiment_label",
    )
    return readers.pick_review_columns(raw)


@R.add("src_by_suffix", f"WITH {REVIEWS} SELECT id, score, title, feedback FROM reviews")
def _(spark, sf):
    folder = sinks.work_folder(spark, "suffix")
    base = reviews(spark, sf).select("id", "score", "title", "feedback")
    low, high = base.filter(F.col("id") % 2 == 0), base.filter(F.col("id") % 2 == 1)
    low.write.parquet(f"{folder}/part.parquet")
    high.write.option("header", True).option("escape", '"').csv(f"{folder}/part.csv")
    text = readers.read_by_suffix(spark, f"{folder}/part.csv")
    typed = text.select(F.col("id").cast("long").alias("id"), F.col("score").cast("double").alias("score"), "title", "feedback")
    return readers.read_by_suffix(spark, f"{folder}/part.parquet").unionByName(typed)


@R.add("src_contract", f"WITH {REVIEWS} SELECT * FROM reviews")
def _(spark, sf):
    return readers.require_columns(reviews(spark, sf))


@R.add("src_notempty", f"""WITH {REVIEWS}, c AS (SELECT id, nullif({clean_sql('feedback')},'') AS feedback FROM reviews)
SELECT id, feedback FROM c WHERE feedback IS NOT NULL""")
def _(spark, sf):
    df = reviews(spark, sf).select("id", T.clean_text(F.col("feedback")).alias("Feedback"))
    name = readers.find_column(df, "feedback")
    return C.non_empty_feedback(df, name).select("id", F.col(name).alias("feedback"))


@R.add("src_queries", r"""SELECT DISTINCT trim(q) AS query FROM (SELECT unnest(string_split(regexp_replace(text, '\s+', ' ', 'g'), ',')) AS q FROM benchmark) WHERE trim(q) <> ''""")
def _(spark, sf):
    folder = sinks.work_folder(spark, "queries")
    one_line = F.regexp_replace("text", r"\s+", " ")
    lines = table(spark, sf, "benchmark").select(F.explode(F.split(one_line, ",")).alias("value"))
    lines.write.text(folder)
    return readers.read_queries(spark, folder).distinct()


@R.add("sink_clean")
def _(spark, sf):
    folder = sinks.work_folder(spark, "clean")
    sinks.write_clean(C.clean_reviews(raw_reviews(spark, sf), sort=False), folder)
    return spark.read.parquet(f"{folder}/parquet").select("id", "score", "title", "timestamp")


# ---------------------------------------------------------------- cleaning
@R.add("coerce_num", """SELECT event_id, try_cast(CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(event_id AS VARCHAR) END AS DOUBLE) AS value FROM events""")
def _(spark, sf):
    from creditecho.functions.numeric import to_number

    raw = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("event_id").cast("string"))
    return table(spark, sf, "events").select("event_id", to_number(raw).alias("value"))


@R.add("coerce_ts", """SELECT event_id, try_cast(CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(ts AS VARCHAR) END AS TIMESTAMP) AS ts FROM events""")
def _(spark, sf):
    from creditecho.functions.numeric import to_utc_timestamp

    raw = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("ts").cast("string"))
    return table(spark, sf, "events").select("event_id", to_utc_timestamp(raw).alias("ts"))


@R.add("drop_bad_rows", f"WITH {RAW_REVIEWS} SELECT id, score, title, timestamp FROM raw WHERE id IS NOT NULL AND score BETWEEN 1 AND 5 AND length(feedback) >= 5")
def _(spark, sf):
    return C.drop_bad_reviews(raw_reviews(spark, sf)).select("id", "score", "title", "timestamp")


_LATEST = f"WITH {RAW_REVIEWS}, u AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY timestamp DESC NULLS LAST) AS rn FROM raw)"


@R.add("dedupe_latest", f"{_LATEST} SELECT id, score, title, timestamp FROM u WHERE rn = 1")
def _(spark, sf):
    return C.latest_per_id(raw_reviews(spark, sf)).select("id", "score", "title", "timestamp")


@R.add("dedupe_null_wins", f"""WITH {RAW_REVIEWS}, u AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY timestamp DESC NULLS FIRST) AS rn FROM raw)
SELECT id, score, title, timestamp FROM u WHERE rn = 1""")
def _(spark, sf):
    return C.latest_per_id(raw_reviews(spark, sf), null_wins=True).select("id", "score", "title", "timestamp")


@R.add("clean_reviews", f"""WITH {RAW_REVIEWS}, c AS (SELECT id, score, {clean_sql('title')} AS title, {clean_sql('feedback')} AS feedback, timestamp FROM raw),
u AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY timestamp DESC NULLS LAST) AS rn FROM c WHERE id IS NOT NULL AND score BETWEEN 1 AND 5 AND length(feedback) >= 5)
SELECT id, score, title, feedback, timestamp FROM u WHERE rn = 1""")
def _(spark, sf):
    return C.clean_reviews(raw_reviews(spark, sf)).select("id", "score", "title", "feedback", "timestamp")


@R.add("sort_time", f"WITH {REVIEWS} SELECT id, timestamp, row_number() OVER (ORDER BY timestamp NULLS LAST, id) AS place FROM reviews")
def _(spark, sf):
    df = reviews(spark, sf).select("id", "timestamp")
    last = F.coalesce(-F.col("timestamp").cast("double"), F.lit(-1e18))
    placed = O.ranked(df.withColumn("_t", last), [], "_t", "id", "place")
    return placed.select("id", "timestamp", "place")


# -------------------------------------------------------------------- text
def _text(name, key, source, column, spark_fn, sql):
    @R.add(name, f"SELECT {key}, {sql} AS cleaned FROM {source}")
    def _(spark, sf):
        return table(spark, sf, source).select(key, spark_fn(F.col(column)).alias("cleaned"))


_text("txt_nbsp", "page_id", "pages", "html", T.strip_invisible, _NBSP.format(t="html"))
_text("txt_html", "page_id", "pages", "html", T.strip_html, _HTML.format(t="html"))
_text("txt_url", "page_id", "pages", "html", T.strip_url, _URL.format(t="html"))
_text("txt_email", "doc_id", "documents", "text", T.strip_email, _EMAIL.format(t="text"))
_text("txt_phone", "doc_id", "documents", "text", T.strip_phone, _PHONE.format(t="text"))
_text("txt_ws", "doc_id", "documents", "text", T.squeeze_space, _SPACE.format(t="text"))
_text("txt_clean", "page_id", "pages", "html", T.clean_text, clean_sql("html"))
_text("prefix_text", "doc_id", "documents", "text", lambda t: T.with_prefix(t, "passage"), "concat('passage: ', text)")
_text("snippet", "doc_id", "documents", "text", T.snippet, "CASE WHEN length(text) > 160 THEN concat(substring(text,1,160),'...') ELSE text END")

_STOP = "[" + ", ".join(f"'{w}'" for w in TURKISH_STOP_WORDS) + "]"


def stop_sql(t: str) -> str:
    return f"list_filter({words_sql(t)}, lambda w: length(w) >= 2 AND NOT list_contains({_STOP}, w))"


@R.add("tok_basic", f"SELECT doc_id, array_to_string({words_sql('text')}, ' ') AS words FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(T.tokens(F.col("text")), " ").alias("words"))


@R.add("tok_stop", f"SELECT doc_id, array_to_string({stop_sql('text')}, ' ') AS words FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(T.content_tokens(F.col("text")), " ").alias("words"))


@R.add("bigrams", f"""WITH w AS (SELECT doc_id, {stop_sql('text')} AS w FROM documents)
SELECT doc_id, array_to_string(CASE WHEN len(w) < 2 THEN [] ELSE list_transform(list_zip(w[:-2], w[2:]), lambda p: p[1] || ' ' || p[2]) END, '|') AS pairs FROM w""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", T.content_tokens(F.col("text")).alias("w"))
    return docs.select("doc_id", F.array_join(T.bigrams(F.col("w")), "|").alias("pairs"))


@R.add("tok_lemma", f"""WITH l AS (SELECT DISTINCT t AS token, regexp_replace(t, 's$', '') AS lemma FROM (SELECT unnest({words_sql('text')}) AS t FROM benchmark) WHERE length(t) > 3 AND t LIKE '%s'),
d AS (SELECT doc_id, {words_sql('text')} AS w FROM documents), e AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS place FROM d),
g AS (SELECT doc_id, string_agg(coalesce(lemma, t), ' ' ORDER BY place) AS words FROM e LEFT JOIN l ON t = token GROUP BY doc_id)
SELECT d.doc_id, coalesce(words, '') AS words FROM d LEFT JOIN g ON d.doc_id = g.doc_id""")
def _(spark, sf):
    found = table(spark, sf, "benchmark").select(F.explode(T.tokens(F.col("text"))).alias("token")).distinct()
    lemmas = found.filter((F.length("token") > 3) & F.col("token").endswith("s")).select(
        "token", F.regexp_replace("token", "s$", "").alias("lemma")
    )
    out = bm25.lemmatized(bm25.tokenized(table(spark, sf, "documents"), "doc_id", "text"), lemmas)
    return out.select("doc_id", F.array_join("words", " ").alias("words"))


# --------------------------------------------------------------- sentiment
@R.add("join_sentiment", f"""WITH {REVIEWS}, s AS (SELECT doc_id AS id, max(quality) AS q FROM labels GROUP BY doc_id)
SELECT r.id, r.score, CASE WHEN q=1 THEN 'positive' WHEN q=0 THEN 'negative' END AS sentiment_label,
  CASE WHEN q=1 THEN 1.0::DOUBLE WHEN q=0 THEN -1.0::DOUBLE END AS sentiment_score FROM reviews r LEFT JOIN s ON r.id=s.id""")
def _(spark, sf):
    q = F.col("quality")
    stored = table(spark, sf, "labels").select(
        F.col("doc_id").alias("id"), F.when(q == 1, "positive").when(q == 0, "negative").alias("sentiment_label"),
        F.when(q == 1, 1.0).when(q == 0, -1.0).alias("sentiment_score"),
    )
    return C.attach_sentiment(reviews(spark, sf).select("id", "score"), stored.unionByName(stored))


@R.add("sentiment_class", f"""WITH {REVIEWS} SELECT id, CASE WHEN sentiment_score <= -0.2 THEN 'negative' WHEN sentiment_score >= 0.2 THEN 'positive'
  WHEN sentiment_score IS NOT NULL THEN 'neutral' END AS class FROM reviews""")
def _(spark, sf):
    return reviews(spark, sf).select("id", S.sentiment_class(F.col("sentiment_score")).alias("class"))


@R.add("map_score", f"WITH {REVIEWS} SELECT id, (score-3)/2 AS mapped FROM reviews")
def _(spark, sf):
    return reviews(spark, sf).select("id", S.mapped_score(F.col("score")).alias("mapped"))


@R.add("hidden_risk", f"WITH {REVIEWS} SELECT id, score, title, sentiment_score FROM reviews WHERE score >= 4 AND lower(sentiment_label)='negative'")
def _(spark, sf):
    return I.mismatches(reviews(spark, sf)).filter("mismatch = 'risk'").select("id", "score", "title", "sentiment_score")


@R.add("hidden_strength", f"WITH {REVIEWS} SELECT id, score, title, sentiment_score FROM reviews WHERE score <= 2 AND lower(sentiment_label)='positive'")
def _(spark, sf):
    return I.mismatches(reviews(spark, sf)).filter("mismatch = 'strength'").select("id", "score", "title", "sentiment_score")


@R.add("mismatch_counts", f"""WITH {REVIEWS} SELECT count(*) FILTER (WHERE score >= 4 AND sentiment_label='negative') AS risk_count,
  count(*) FILTER (WHERE score <= 2 AND sentiment_label='positive') AS strength_count FROM reviews""")
def _(spark, sf):
    return I.mismatch_counts(reviews(spark, sf))


@R.add("mismatch_topics", f"""WITH {REVIEWS}, m AS (SELECT CASE WHEN score >= 4 AND sentiment_label='negative' THEN 'risk' WHEN score <= 2 AND sentiment_label='positive' THEN 'strength' END AS mismatch, title FROM reviews),
c AS (SELECT mismatch, title, count(*) AS n FROM m WHERE mismatch IS NOT NULL AND title IS NOT NULL GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY mismatch ORDER BY n DESC, title) AS place FROM c) SELECT * FROM p WHERE place <= 10""")
def _(spark, sf):
    return I.mismatch_topics(reviews(spark, sf))


@R.add("neg_subset", f"WITH {REVIEWS} SELECT id, score, title FROM reviews WHERE sentiment_label='negative'")
def _(spark, sf):
    return I.negative_subset(reviews(spark, sf)).select("id", "score", "title")


@R.add("label_dist", f"""WITH {REVIEWS} SELECT sentiment_label, count(*) AS n, round(count(*)::DOUBLE/sum(count(*)) OVER (),6) AS share FROM reviews
WHERE sentiment_label IS NOT NULL GROUP BY sentiment_label""")
def _(spark, sf):
    return rounded(S.label_distribution(reviews(spark, sf)))


@R.add("timeline_daily", f"""WITH {REVIEWS} SELECT CAST(timestamp AS DATE) AS day, round(avg(sentiment_score),6) AS mean_sentiment, count(sentiment_score) AS n
FROM reviews WHERE timestamp IS NOT NULL GROUP BY 1 HAVING count(sentiment_score) > 0""")
def _(spark, sf):
    return rounded(I.daily_timeline(reviews(spark, sf)))


@R.add("sentiment_by_score", f"""WITH {REVIEWS} SELECT score, {", ".join(f"round(100.0::DOUBLE*count(*) FILTER (WHERE sentiment_label='{k}')/count(*),6) AS {k}" for k in S.LABELS)}
FROM reviews WHERE sentiment_label IS NOT NULL GROUP BY score""")
def _(spark, sf):
    return rounded(I.sentiment_by_score(reviews(spark, sf)))


_S5 = ", ".join(f"avg(sentiment_score) FILTER (WHERE score={i}) AS s{i}" for i in range(1, 6))


@R.add("topic_score_pivot", f"""WITH {REVIEWS}, k AS (SELECT * FROM reviews WHERE title IS NOT NULL AND sentiment_score IS NOT NULL),
t AS (SELECT title FROM k GROUP BY title ORDER BY count(*) DESC, title LIMIT 20), p AS (SELECT title, {_S5} FROM k WHERE title IN (SELECT title FROM t) GROUP BY title)
SELECT title, {", ".join(f"round(s{i},6) AS score_{i}" for i in range(1, 6))}, round(list_avg(list_filter([s1,s2,s3,s4,s5], lambda x: x IS NOT NULL)),6) AS mean_of_scores FROM p""")
def _(spark, sf):
    return rounded(I.topic_score_means(reviews(spark, sf)))


_TERMS = f"""w AS (SELECT {stop_sql('feedback')} AS w FROM reviews WHERE sentiment_label='negative'),
t AS (SELECT unnest(w) AS term, false AS is_bigram FROM w UNION ALL
  SELECT unnest(CASE WHEN len(w) < 2 THEN [] ELSE list_transform(list_zip(w[:-2], w[2:]), lambda p: p[1] || ' ' || p[2]) END), true FROM w)"""


@R.add("top_terms", f"WITH {REVIEWS}, {_TERMS} SELECT term, is_bigram, count(*) AS n FROM t GROUP BY ALL ORDER BY n DESC, is_bigram DESC, term LIMIT 15")
def _(spark, sf):
    return I.top_terms(I.negative_subset(reviews(spark, sf)), "feedback", 15)


@R.add("union_terms", f"WITH {REVIEWS}, {_TERMS} SELECT term, is_bigram, count(*) AS n FROM t GROUP BY ALL")
def _(spark, sf):
    return I.term_counts(I.negative_subset(reviews(spark, sf)), "feedback")


@R.add("topn_per_group", f"""WITH {REVIEWS}, p AS (SELECT title, id, sentiment_score, row_number() OVER (PARTITION BY title ORDER BY sentiment_score DESC NULLS LAST, id) AS place FROM reviews)
SELECT * FROM p WHERE place <= 5""")
def _(spark, sf):
    order = W.partitionBy("title").orderBy(F.col("sentiment_score").desc_nulls_last(), "id")
    df = reviews(spark, sf).select("title", "id", "sentiment_score", F.row_number().over(order).alias("place"))
    return df.filter(F.col("place") <= 5)


@R.add("avg_rank", f"""WITH {REVIEWS} SELECT title, sentiment_score, min(r) AS average_rank FROM (SELECT title, sentiment_score,
  rank() OVER (PARTITION BY title ORDER BY sentiment_score) + (count(*) OVER (PARTITION BY title, sentiment_score) - 1)/2.0::DOUBLE AS r
  FROM reviews WHERE sentiment_score IS NOT NULL) GROUP BY ALL""")
def _(spark, sf):
    known = reviews(spark, sf).filter(F.col("sentiment_score").isNotNull()).withColumn("one", F.lit(1))
    return O.average_ranks(known, ["title"], "sentiment_score", "one", "average_rank").drop("average_rank_n")


@R.add("score_rates", f"""WITH {REVIEWS}, c AS (SELECT title, score, CASE WHEN sentiment_score <= -0.2 THEN 'n' WHEN sentiment_score >= 0.2 THEN 'p' WHEN sentiment_score IS NOT NULL THEN 'u' END AS k FROM reviews)
SELECT title, round(avg(CASE WHEN k='n' THEN 1.0::DOUBLE ELSE 0 END) FILTER (WHERE score <= 2 AND k IS NOT NULL),6) AS rate_negative_for_score_le_2,
  round(avg(CASE WHEN k='p' THEN 1.0::DOUBLE ELSE 0 END) FILTER (WHERE score >= 3 AND k IS NOT NULL),6) AS rate_positive_for_score_ge_3 FROM c GROUP BY title""")
def _(spark, sf):
    out = S.sentiment_rates(reviews(spark, sf), ["title"])
    return rounded(out.select("title", "rate_negative_for_score_le_2", "rate_positive_for_score_ge_3"))


@R.add("mean_score", f"WITH {REVIEWS} SELECT title, round(avg(sentiment_score),6) AS mean_sentiment FROM reviews GROUP BY title")
def _(spark, sf):
    return rounded(reviews(spark, sf).groupBy("title").agg(F.avg("sentiment_score").alias("mean_sentiment")))


_SETS = """sets AS (
  SELECT 'stars' AS label_set, CAST(score AS BIGINT) AS class_id, concat(CAST(CAST(score AS BIGINT) AS VARCHAR), CASE WHEN score=1 THEN ' star' ELSE ' stars' END) AS label FROM (SELECT DISTINCT score FROM reviews)
  UNION ALL SELECT 'names', row_number() OVER (ORDER BY sentiment_label), sentiment_label FROM (SELECT DISTINCT sentiment_label FROM reviews WHERE sentiment_label IS NOT NULL)
  UNION ALL SELECT 'langs', row_number() OVER (ORDER BY lang), lang FROM (SELECT DISTINCT lang FROM documents))"""


@R.add("label_value", f"""WITH {REVIEWS}, {_SETS} SELECT label_set, class_id, label, CAST(CASE label_set WHEN 'stars' THEN (class_id-3)/2.0 WHEN 'names' THEN CASE label WHEN 'negative' THEN -1 ELSE 1 END
  ELSE 2.0*(class_id-1)/(count(*) OVER (PARTITION BY label_set)-1)-1 END AS DOUBLE) AS value FROM sets""")
def _(spark, sf):
    base = reviews(spark, sf)
    s = F.col("score").cast("long")
    order = W.partitionBy(F.lit(0))  # distinct class names only
    stars = base.select("score").distinct().select(
        F.lit("stars").alias("label_set"), s.alias("class_id"),
        F.concat(s.cast("string"), F.when(s == 1, " star").otherwise(" stars")).alias("label"),
    )
    names = base.select("sentiment_label").distinct().filter("sentiment_label IS NOT NULL").select(
        F.lit("names"), F.row_number().over(order.orderBy("sentiment_label")).cast("long"), "sentiment_label"
    )
    langs = table(spark, sf, "documents").select("lang").distinct().select(
        F.lit("langs"), F.row_number().over(order.orderBy("lang")).cast("long"), "lang"
    )
    return S.label_values(stars.union(names).union(langs))


@R.add("expected_sentiment", """WITH p AS (SELECT doc_id, 1+doc_id%7 AS a, 1+n_chars%5 AS b, 1+doc_id%3 AS c FROM documents)
SELECT doc_id, CASE WHEN a >= b AND a >= c THEN 'negative' WHEN b >= c THEN 'neutral' ELSE 'positive' END AS sentiment_label,
  round(CAST(c-a AS DOUBLE)/(a+b+c),6) AS sentiment_score FROM p""")
def _(spark, sf):
    a, b, c = 1 + F.col("doc_id") % 7, 1 + F.col("n_chars") % 5, 1 + F.col("doc_id") % 3
    probs = F.array(*[x.cast("double") / (a + b + c) for x in (a, b, c)])
    values = F.array(F.lit(-1.0), F.lit(0.0), F.lit(1.0))
    names = F.array(F.lit("negative"), F.lit("neutral"), F.lit("positive"))
    label, mean = S.expected_sentiment(probs, values, names)
    return rounded(table(spark, sf, "documents").select("doc_id", label.alias("sentiment_label"), mean.alias("sentiment_score")))


# -------------------------------------------------- lexicon and full scan
_LEX = f"""lex AS (SELECT DISTINCT t AS token, (length(t) % 5 - 2)/2.0::DOUBLE AS weight FROM (SELECT unnest({words_sql('text')}) AS t FROM benchmark)),
tk AS (SELECT id, unnest({words_sql('feedback')}) AS t FROM reviews),
m AS (SELECT id, CAST(sum(CAST(round(weight*1e10) AS BIGINT)) AS DOUBLE)/1e10/count(*) AS s FROM tk JOIN lex ON t=token GROUP BY id),
computed AS (SELECT r.id, CASE WHEN s <= -0.2 THEN 'negative' WHEN s >= 0.2 THEN 'positive' WHEN s IS NOT NULL THEN 'neutral' END AS sentiment_label, s AS sentiment_score
  FROM reviews r LEFT JOIN m ON r.id=m.id)"""


def lexicon(spark, sf):
    """A word list with weights made from the words of the benchmark table."""
    found = table(spark, sf, "benchmark").select(F.explode(T.tokens(F.col("text"))).alias("token")).distinct()
    return found.withColumn("weight", (F.length("token") % 5 - 2) / F.lit(2.0))


def computed_sentiment(spark, sf):
    return S.lexicon_sentiment(reviews(spark, sf), lexicon(spark, sf))


@R.add("sentiment_score", f"WITH {REVIEWS}, {_LEX} SELECT id, sentiment_label, round(sentiment_score,6) AS sentiment_score FROM computed")
def _(spark, sf):
    return rounded(computed_sentiment(spark, sf))


@R.add("full_scan", f"""WITH {REVIEWS}, {_LEX}, told AS (SELECT * FROM computed WHERE sentiment_label IS NOT NULL)
SELECT coalesce(sentiment_label, 'all') AS sentiment_label, count(*) AS n, round(count(*)::DOUBLE/(SELECT count(*) FROM told),6) AS share,
  round(avg(sentiment_score),6) AS mean_score, round(stddev_pop(sentiment_score),6) AS std_score FROM told GROUP BY GROUPING SETS ((sentiment_label), ())""")
def _(spark, sf):
    return rounded(S.scan_summary(stored(computed_sentiment(spark, sf), "full-scan")))


@R.add("sentiment_prefer_precomputed", f"""WITH {REVIEWS}, {_LEX} SELECT r.id, coalesce(r.sentiment_label, c.sentiment_label) AS sentiment_label,
  round(coalesce(r.sentiment_score, c.sentiment_score),6) AS sentiment_score FROM reviews r JOIN computed c ON r.id=c.id""")
def _(spark, sf):
    rows = reviews(spark, sf)
    known = rows.select("id", "sentiment_label", "sentiment_score")
    open_ = rows.filter("sentiment_label IS NULL OR sentiment_score IS NULL")  # only these are scored
    return rounded(S.prefer_stored(known, S.lexicon_sentiment(open_, lexicon(spark, sf))))


# ----------------------------------------------------------------- vectors
@R.add("l2_norm", """SELECT vec_id AS doc_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE/(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]))+1e-12))),6) AS total FROM embeddings""")
def _(spark, sf):
    unit = V.l2_normalize(F.col("embedding"))
    total = F.aggregate(unit, F.lit(0.0), lambda a, x: a + x)
    return rounded(doc_vectors(spark, sf).select("doc_id", total.alias("total")))


@R.add("dot", """SELECT a.vec_id AS doc_id, round(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]),6) AS product FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def _(spark, sf):
    a = doc_vectors(spark, sf).select("doc_id", "embedding")
    b = a.select((F.col("doc_id") - 1).alias("doc_id"), F.col("embedding").alias("other"))
    return rounded(a.join(b, "doc_id").select("doc_id", V.dot(F.col("embedding"), F.col("other")).alias("product")))

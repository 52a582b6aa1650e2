"""Topics, mismatches, trends, comparison of the two searches, metric bands and run timings."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditecho.functions.numeric import share
from creditecho.functions.text import bigrams, content_tokens

SCORES = (1.0, 2.0, 3.0, 4.0, 5.0)


def mismatch(score: Column, label: Column) -> Column:
    """``risk`` for a high score with negative text, ``strength`` for a low score with positive text."""
    kind = F.lower(label)
    return F.when((score >= 4) & (kind == "negative"), "risk").when((score <= 2) & (kind == "positive"), "strength")


def mismatches(df: DataFrame) -> DataFrame:
    return df.withColumn("mismatch", mismatch(F.col("score"), F.col("sentiment_label"))).filter("mismatch IS NOT NULL")


def mismatch_counts(df: DataFrame) -> DataFrame:
    kind = mismatch(F.col("score"), F.col("sentiment_label"))
    return df.agg(F.count_if(kind == "risk").alias("risk_count"), F.count_if(kind == "strength").alias("strength_count"))


def mismatch_topics(df: DataFrame, k: int = 10) -> DataFrame:
    """Most frequent titles among risks and among strengths."""
    counts = mismatches(df).filter(F.col("title").isNotNull()).groupBy("mismatch", "title").agg(F.count("*").alias("n"))
    place = F.row_number().over(W.partitionBy("mismatch").orderBy(F.col("n").desc(), "title"))
    return counts.withColumn("place", place).filter(F.col("place") <= k)


def negative_subset(df: DataFrame) -> DataFrame:
    """Negative reviews by label, else by score below -0.2; everything when none is found."""
    if "sentiment_label" in df.columns:
        test = F.lower("sentiment_label") == "negative"
    elif "sentiment_score" in df.columns:
        test = F.col("sentiment_score") < -0.2
    else:
        return df
    found = df.agg(F.count_if(test) > 0).scalar()
    return df.withColumn("_any", found).filter(F.coalesce(test, F.lit(False)) | ~F.col("_any")).drop("_any")


def term_counts(df: DataFrame, text: str, by: list[str] = ()) -> DataFrame:
    """(by..., term, is_bigram, n) for single words and adjacent pairs after stop words are removed."""
    words = df.select(*by, content_tokens(F.col(text)).alias("_w"))
    single = words.select(*by, F.explode("_w").alias("term"), F.lit(False).alias("is_bigram"))
    pairs = words.select(*by, F.explode(bigrams(F.col("_w"))).alias("term"), F.lit(True).alias("is_bigram"))
    return single.unionByName(pairs).groupBy(*by, "term", "is_bigram").agg(F.count("*").alias("n"))


def top_terms(df: DataFrame, text: str, k: int = 10, by: list[str] = ()) -> DataFrame:
    """First k terms by count; pairs before words on ties, then by text."""
    order = [F.col("n").desc(), F.col("is_bigram").desc(), F.col("term")]
    counts = term_counts(df, text, by)
    if not by:
        return counts.orderBy(*order).limit(k)
    place = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return counts.withColumn("place", place).filter(F.col("place") <= k)


def daily_timeline(df: DataFrame) -> DataFrame:
    """Mean sentiment and number of scored reviews per day."""
    dated = df.filter(F.col("timestamp").isNotNull())
    days = dated.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.avg("sentiment_score").alias("mean_sentiment"), F.count("sentiment_score").alias("n")
    )
    return days.filter(F.col("n") > 0).orderBy("day")


def sentiment_by_score(df: DataFrame, labels=("negative", "positive", "neutral")) -> DataFrame:
    """Share of each label per score in percent."""
    known = df.filter(F.col("score").isNotNull() & F.col("sentiment_label").isNotNull())
    return known.groupBy("score").agg(*[
        (100 * share(F.count_if(F.col("sentiment_label") == k), F.count("*"))).alias(k) for k in labels
    ]).orderBy("score")


def topic_score_means(df: DataFrame, topics: int = 20) -> DataFrame:
    """Mean sentiment of the most frequent titles by score, most negative title first."""
    known = df.filter(F.col("title").isNotNull() & F.col("score").isNotNull() & F.col("sentiment_score").isNotNull())
    top = known.groupBy("title").agg(F.count("*").alias("_n")).orderBy(F.col("_n").desc(), "title").limit(topics)
    chosen = known.join(F.broadcast(top.select("title")), "title", "left_semi")
    table = chosen.groupBy("title").agg(*[
        F.avg(F.when(F.col("score") == s, F.col("sentiment_score"))).alias(f"score_{int(s)}") for s in SCORES
    ])
    cells = F.filter(F.array(*[F.col(f"score_{int(s)}") for s in SCORES]), lambda x: x.isNotNull())
    mean = F.aggregate(cells, F.lit(0.0), lambda a, x: a + x) / F.size(cells)
    return table.withColumn("mean_of_scores", mean).orderBy(F.col("mean_of_scores").asc_nulls_last(), "title")


def compare_sides(metrics: DataFrame) -> DataFrame:
    """One row per query from (query_id, side, metrics...): both sides and their differences."""
    fields = {
        "coverage": F.col("count"), "positive_ratio": F.coalesce("class_ratio_positive", F.lit(0.0)),
        "negative_ratio": F.coalesce("class_ratio_negative", F.lit(0.0)),
        "neutral_ratio": F.coalesce("class_ratio_neutral", F.lit(0.0)), "mean_sentiment": F.col("sentiment_mean"),
    }
    picks = [
        F.max(F.when(F.col("side") == side, x)).alias(f"{side}_{name}")
        for name, x in fields.items() for side in ("baseline", "rag")
    ]
    wide = metrics.groupBy("query_id").agg(*picks)
    for name in ("coverage", "positive_ratio", "negative_ratio", "neutral_ratio"):
        for side in ("baseline", "rag"):
            c = f"{side}_{name}"
            wide = wide.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    return wide.withColumns({f"{n}_difference": F.col(f"rag_{n}") - F.col(f"baseline_{n}") for n in fields})


def insight_bands(metrics: DataFrame, negative: str = "negative_rate", positive: str = "positive_rate") -> DataFrame:
    """Readable bands for dissatisfaction, positivity and score-sentiment correlation."""
    n, p, r = F.col(negative), F.col(positive), F.abs(F.col("corr_pearson_score_vs_sentiment"))
    return metrics.withColumns({
        "dissatisfaction": F.when(n >= 0.6, "high").when(n >= 0.4, "medium").when(n.isNotNull(), "low"),
        "positivity": F.when(p >= 0.6, "dominant").when(p <= 0.3, "low"),
        "correlation": F.when(r >= 0.5, "high").otherwise("medium/low"),
        "correlation_percent": r * 100,
    })


def flat_metrics(metrics: DataFrame, names: list[str]) -> DataFrame:
    """One wide row per query with ``baseline.`` and ``rag.`` columns."""
    picks = [
        F.max(F.when(F.col("side") == side, F.col(m))).alias(f"{side}.{m}") for side in ("baseline", "rag") for m in names
    ]
    return metrics.groupBy("query_id").agg(*picks)


def compare_runs(runs: DataFrame) -> DataFrame:
    """Mean seconds of query runs and full scans, their ratio and difference; failed runs are left out."""
    mean = {
        name: F.avg(F.when(F.col("scenario") == scenario, F.col("seconds")))
        for name, scenario in (("query_seconds", "RAG"), ("scan_seconds", "Non-RAG"))
    }
    q, f = F.col("query_seconds"), F.col("scan_seconds")
    return runs.filter("ok").agg(*[x.alias(n) for n, x in mean.items()]).select(
        q, f, F.try_divide(f, q).alias("speedup"), (f - q).alias("saved_seconds")
    )

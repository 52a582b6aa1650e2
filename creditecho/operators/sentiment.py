"""Sentiment values, label mapping, and sentiment statistics per result set."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditecho.functions.numeric import share
from creditecho.functions.text import tokens
from creditecho.operators.bm25 import fixed_sum
from creditecho.operators.joins import lookup_join
from creditecho.operators.totals import average_ranks, null_safe_join, running_totals
from creditecho.session import stored

LABELS = ("negative", "positive", "neutral")


def sentiment_class(x: Column, null_as_neutral: bool = False) -> Column:
    out = F.when(x <= -0.2, "negative").when(x >= 0.2, "positive").when(x.isNotNull(), "neutral")
    return F.coalesce(out, F.lit("neutral")) if null_as_neutral else out


def mapped_score(score: Column) -> Column:
    """1..5 to -1..1."""
    return (score.cast("double") - 3) / 2


def label_values(labels: DataFrame) -> DataFrame:
    """Numbers for class names. Input (label_set, class_id, label); adds ``value`` in -1..1.

    Star names and negative / neutral / positive names map by name. Sets of two or three classes fall
    back to their position, larger sets without full names are spaced evenly by class order.
    """
    name = F.lower("label")
    stars = F.regexp_extract(name, r"\b([1-5])\s*star", 1)
    by_name = (
        F.when(stars != "", (stars.try_cast("double") - 3) / 2)
        .when(name.contains("neg"), -1.0).when(name.contains("pos"), 1.0).when(name.contains("neu"), 0.0)
    )
    w = W.partitionBy("label_set")
    known = labels.withColumns({"_v": by_name, "_star": stars != ""}).withColumns({
        "_n": F.count("*").over(w), "_hit": F.count("_v").over(w), "_stars": F.bool_or("_star").over(w),
        "_at": F.row_number().over(w.orderBy("class_id")) - 1,
    })
    complete = (F.col("_hit") == F.col("_n")) & (F.col("_stars") | F.col("_n").isin(2, 3))
    two = F.when(F.col("_at") == 0, -1.0).otherwise(1.0)
    three = F.col("_at") - 1.0
    even = F.coalesce(F.try_divide(2.0 * F.col("_at"), F.col("_n") - 1), F.lit(0.0)) - 1.0
    value = (
        F.when(complete, F.col("_v"))
        .when(F.col("_n") == 2, F.coalesce("_v", two))
        .when(F.col("_n") == 3, F.coalesce("_v", three))
        .otherwise(even)
    )
    return known.select("label_set", "class_id", "label", value.cast("double").alias("value"))


def expected_sentiment(probs: Column, values: Column, labels: Column) -> tuple[Column, Column]:
    """Label of the largest probability (first on ties) and the expected value."""
    best = F.get(labels, (F.array_position(probs, F.array_max(probs)) - 1).cast("int"))
    mean = F.aggregate(F.zip_with(probs, values, lambda p, v: p * v), F.lit(0.0), lambda acc, x: acc + x)
    return best, mean


def lexicon_sentiment(docs: DataFrame, lexicon: DataFrame, key: str = "id", text: str = "feedback") -> DataFrame:
    """(key, sentiment_label, sentiment_score): mean weight of the known words, within -1..1.

    ``lexicon`` holds (token, weight). A text without known words keeps NULL.
    """
    words = docs.select(F.col(key), F.explode_outer(tokens(F.col(text))).alias("_word"))
    joined = lookup_join(words, lexicon, F.col("_word") == F.col("token"))
    scored = joined.groupBy(key).agg(F.when(F.count("weight") > 0, fixed_sum(F.col("weight")) / F.greatest(F.count("weight"), F.lit(1))).alias("_m"))
    bounded = F.greatest(F.least(F.col("_m"), F.lit(1.0)), F.lit(-1.0))
    score = F.when(F.col("_m").isNotNull(), bounded)
    return scored.select(key, sentiment_class(score).alias("sentiment_label"), score.alias("sentiment_score"))


def model_sentiment(docs: DataFrame, model: Callable[[pd.Series], pd.DataFrame], key: str = "id", text: str = "feedback") -> DataFrame:
    """A user model over batches of texts; it returns ``sentiment_label`` and ``sentiment_score``."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = model(b[text])
            yield pd.DataFrame({
                key: b[key].to_numpy(), "sentiment_label": out["sentiment_label"].to_numpy(),
                "sentiment_score": out["sentiment_score"].to_numpy(),
            })

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInPandas(task, f"{key} {kind}, sentiment_label string, sentiment_score double")


def prefer_stored(stored: DataFrame, computed: DataFrame, key: str = "id") -> DataFrame:
    """Stored sentiment where present, else the computed one."""
    other = computed.select(
        F.col(key), F.col("sentiment_label").alias("_label"), F.col("sentiment_score").alias("_score")
    )
    return stored.join(other, key, "left").withColumns({
        "sentiment_label": F.coalesce("sentiment_label", "_label"),
        "sentiment_score": F.coalesce("sentiment_score", "_score"),
    }).drop("_label", "_score")


def cap_sentiment(df: DataFrame, n: int, rank: str = "rank") -> DataFrame:
    """Sentiment only for the first n results of a query, NULL beyond; ``n <= 0`` keeps all."""
    if n <= 0:
        return df
    first = F.col(rank) <= n
    return df.withColumns({c: F.when(first, F.col(c)) for c in ("sentiment_label", "sentiment_score")})


def spearman(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """(by..., spearman) over complete pairs. Pairs are counted first, so a hot value is one row."""
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by, x, y).agg(F.count("*").alias("_c"))
    rx = average_ranks(pairs, by, x, "_c", "_rx")
    ry = average_ranks(pairs, by, y, "_c", "_ry").drop("_ry_n")
    joined = pairs.join(rx, [*by, x]).join(ry, [*by, y])
    middle = (F.col("_rx_n") + 1) / 2
    a, b, c = F.col("_rx") - middle, F.col("_ry") - middle, F.col("_c")
    sums = joined.groupBy(*by).agg(
        F.sum(c * a * b).alias("_ab"), F.sum(c * a * a).alias("_aa"), F.sum(c * b * b).alias("_bb")
    )
    return sums.select(*by, F.try_divide(F.col("_ab"), F.sqrt("_aa") * F.sqrt("_bb")).alias("spearman"))


def contingency(results: DataFrame, by: list[str]) -> DataFrame:
    """(by..., score, label, sentiment, n): how often each combination occurs in a group. Counting starts in the tasks that read the
    rows, so a hot group or value arrives as few rows."""
    names = {"score": "score", "sentiment_label": "label", "sentiment_score": "sentiment"}
    return results.groupBy(*by, *[F.col(c).alias(n) for c, n in names.items()]).agg(F.count("*").alias("n"))


def _of(n: Column, condition: Column) -> Column:
    """Rows counted by ``n`` for which the condition holds."""
    return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))


def _plain_metrics(cells: DataFrame, by: list[str], null_as_neutral: bool) -> DataFrame:
    """Counts, means, shares and rates of each group of a contingency table, and the means over complete pairs."""
    n, s, x, label = F.col("n"), F.col("sentiment"), mapped_score(F.col("score")), F.col("label")
    cls = sentiment_class(s, null_as_neutral)
    known, pair = s.isNotNull(), s.isNotNull() & F.col("score").isNotNull()
    low, high = F.col("score") <= 2, F.col("score") >= 3
    total = F.sum(s.cast("decimal(19,10)") * n.cast("decimal(18,0)")).cast("double")  # up to 1e28, in any order of rows
    return cells.groupBy(*by).agg(
        F.sum("n").alias("count"),
        F.try_divide(total, F.sum(F.when(known, n))).alias("sentiment_mean"),
        *[share(_of(n, label == k), F.sum(F.when(label.isNotNull(), n))).alias(f"class_ratio_{k}") for k in LABELS],
        share(_of(n, low & (cls == "negative")), F.sum(F.when(low & cls.isNotNull(), n))).alias("rate_negative_for_score_le_2"),
        share(_of(n, high & (cls == "positive")), F.sum(F.when(high & cls.isNotNull(), n))).alias("rate_positive_for_score_ge_3"),
        _of(n, known).alias("_known"),
        F.try_divide(F.sum(F.when(pair, n * x)), _of(n, pair)).alias("_mx"),
        F.try_divide(F.sum(F.when(pair, n * s)), _of(n, pair)).alias("_my"),
    )


def sentiment_rates(results: DataFrame, by: list[str] = ("query_id",), null_as_neutral: bool = False) -> DataFrame:
    """The metrics that need no order: one scan and one grouping of the counted rows."""
    return _plain_metrics(contingency(results, list(by)), list(by), null_as_neutral).drop("_known", "_mx", "_my")


def sentiment_summary(results: DataFrame, by: list[str] = ("query_id",), null_as_neutral: bool = False) -> DataFrame:
    """All sentiment metrics of each result set, one row per group.

    The rows are read once, into a contingency table that is written to the shared folder. Mean, deviation, shares, rates, median and both
    correlations come from it: running totals over the sentiments of a group give its median and the ranks of one side, those over its
    scores the ranks of the other. A group without sentiment has NULL metrics, one without spread NULL correlations; groups may be NULL.
    """
    by = list(by)
    cells = stored(contingency(results, by), "sentiment-counts")
    n, pair = F.col("n"), F.col("score").isNotNull() & F.col("sentiment").isNotNull()
    plain = _plain_metrics(cells, by, null_as_neutral)
    flat = cells.groupBy(*by, "score", "sentiment").agg(F.sum("n").alias("n"))

    sides = cells.filter(F.col("sentiment").isNotNull()).groupBy(*by, "sentiment").agg(
        F.sum("n").alias("a"), _of(n, F.col("score").isNotNull()).alias("p")
    )
    sides = running_totals(sides, by, "sentiment", ["a", "p"])
    place = (F.col("a_total") - 1) / 2
    holds = lambda at: at.between(F.col("a_before"), F.col("a_before") + F.col("a") - 1)
    low, high = (F.max(F.when(holds(at), F.col("sentiment"))) for at in (F.floor(place), F.ceil(place)))
    medians = sides.groupBy(*by).agg(F.when(low == high, low).otherwise((low + high) / 2).alias("sentiment_median"))
    ranks_y = sides.filter("p > 0").select(
        *by, "sentiment", (F.col("p_before") + (F.col("p") + 1) / 2 - (F.col("p_total") + 1) / 2).alias("_ry")
    )
    scores = running_totals(cells.filter(pair).groupBy(*by, "score").agg(F.sum("n").alias("p")), by, "score", ["p"])
    ranks_x = scores.select(*by, "score", (F.col("p_before") + (F.col("p") + 1) / 2 - (F.col("p_total") + 1) / 2).alias("_rx"))

    joined = null_safe_join(flat.filter(F.col("sentiment").isNotNull()), plain.select(*by, "sentiment_mean", "_known", "_mx", "_my"), by)
    joined = null_safe_join(joined, ranks_y, [*by, "sentiment"], "left")
    joined = null_safe_join(joined, ranks_x, [*by, "score"], "left")
    only = F.when(pair, n)
    dx, dy = mapped_score(F.col("score")) - F.col("_mx"), F.col("sentiment") - F.col("_my")
    rx, ry = F.col("_rx"), F.col("_ry")
    off = F.col("sentiment") - F.col("sentiment_mean")
    sums = joined.groupBy(*by).agg(
        F.sum(n * off * off).alias("_ss"), F.max("_known").alias("_k"), F.sum(only).alias("_pairs"),
        *[F.sum(only * a * b).alias(c) for a, b, c in ((dx, dy, "_xy"), (dx, dx, "_xx"), (dy, dy, "_yy"), (rx, ry, "_ab"), (rx, rx, "_aa"), (ry, ry, "_bb"))],
    )

    def correlation(ab: str, aa: str, bb: str) -> Column:
        spread = F.least(F.sqrt(F.try_divide(F.col(aa), F.col("_pairs"))), F.sqrt(F.try_divide(F.col(bb), F.col("_pairs"))))
        return F.when(spread > 1e-12, F.try_divide(F.col(ab), F.sqrt(aa) * F.sqrt(bb)))

    spread = sums.select(
        *by, F.when(F.col("_k") > 1, F.sqrt(F.try_divide(F.col("_ss"), F.col("_k") - 1))).alias("sentiment_std"),
        correlation("_xy", "_xx", "_yy").alias("corr_pearson_score_vs_sentiment"),
        correlation("_ab", "_aa", "_bb").alias("corr_spearman_score_vs_sentiment"),
    )
    out = null_safe_join(null_safe_join(plain.drop("_known", "_mx", "_my"), medians, by, "left"), spread, by, "left")
    order = [
        "count", "sentiment_mean", "sentiment_std", *[f"class_ratio_{k}" for k in LABELS], "corr_pearson_score_vs_sentiment",
        "rate_negative_for_score_le_2", "rate_positive_for_score_ge_3", "sentiment_median", "corr_spearman_score_vs_sentiment",
    ]
    return out.select(*by, *order)


def label_distribution(df: DataFrame, by: list[str] = (), column: str = "sentiment_label") -> DataFrame:
    """Counts and shares per label; rows without a label are outside the share."""
    by = list(by)
    counts = df.filter(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("n"))
    w = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))  # one row per label
    return counts.withColumn("share", share(F.col("n"), F.sum("n").over(w)))


def scan_summary(df: DataFrame, label: str = "sentiment_label", score: str = "sentiment_score") -> DataFrame:
    """Counts, shares, mean and population deviation per label and, as label ``all``, over every row with a label; one scan."""
    told = df.filter(F.col(label).isNotNull()).rollup(label).agg(
        F.count("*").alias("n"), F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"), F.grouping(label).alias("_all"),
    ).filter((F.col("_all") == 0) | (F.col("n") > 0))
    total = F.max("n").over(W.partitionBy(F.lit(0)))  # one row per label
    return told.select(F.when(F.col("_all") == 1, "all").otherwise(F.col(label)).alias(label), "n", share(F.col("n"), total).alias("share"), "mean_score", "std_score")

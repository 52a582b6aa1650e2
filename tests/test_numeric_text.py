import pytest
from pyspark.sql import functions as F

from creditecho.functions import numeric as N
from creditecho.functions import text as T
from creditecho.functions import vectors as V


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_division_keeps_signed_infinity_and_nulls(spark):
    inf = float("inf")
    got = one(spark, *[N.ieee_div(F.lit(a), F.lit(b)) for a, b in ((5.0, 0.0), (-5.0, 0.0), (0.0, 0.0), (6.0, 3.0))])
    assert got == (inf, -inf, None, 2.0)
    assert one(spark, N.finite(F.lit(inf)), N.finite(F.lit(float("nan"))), N.finite(F.lit(1.5))) == (None, None, 1.5)


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 9.0)], "a double, b double")
    assert df.agg(N.safe_corr(F.col("a"), F.col("b"))).first()[0] is None
    pairs = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (None, 1.0)], "a double, b double")
    assert pairs.agg(N.safe_corr(F.col("a"), F.col("b"))).first()[0] == pytest.approx(1.0)


def test_text_cleaning_order(spark):
    raw = "a​ <b>x</b> http://t.co/a?b mail me.x@ex-a.com +90 532 123 45 67 \x1d end"
    assert one(spark, T.clean_text(F.lit(raw)))[0] == "a x mail end"
    assert one(spark, T.clean_text(F.lit(None).cast("string")))[0] is None


def test_tokens_bigrams_and_stop_words(spark):
    text = "İyi ÇOK güzel!! ürün_1"
    assert one(spark, T.tokens(F.lit(text)))[0] == ["i", "yi", "çok", "güzel", "ürün_1"]
    assert one(spark, T.content_tokens(F.lit("bu çok güzel a ürün")))[0] == ["güzel", "ürün"]
    for words, pairs in ((["a"], []), ([], []), (["a", "b", "c"], ["a b", "b c"])):
        column = F.array(*[F.lit(w) for w in words]).cast("array<string>")
        assert one(spark, T.bigrams(column))[0] == pairs


def test_formats(spark):
    assert one(spark, T.format_seconds(F.lit(198.9)))[0] == "3.31 minutes (198.90 seconds)"
    assert one(spark, T.format_seconds(F.lit(5.005)))[0] == f"{5.005:.2f} seconds"
    assert one(spark, T.format_seconds(F.lit(7322.5)))[0] == "2.0 hours 2.0 minutes (7322.50 seconds)"
    assert one(spark, T.slug(F.lit("müşteri hizmeti/!? x")))[0] == "müşteri_hizmeti_x"
    assert one(spark, T.title_case(F.lit("random_forest")))[0] == "Random Forest"
    assert one(spark, T.snippet(F.lit("x" * 161)))[0] == "x" * 160 + "..."


def test_vectors(spark):
    unit = one(spark, V.l2_normalize(F.array(F.lit(3.0), F.lit(4.0))))[0]
    assert unit == pytest.approx([0.6, 0.8])
    assert one(spark, V.dot(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(3.0), F.lit(4.0))))[0] == 11.0


def test_wide_sum_does_not_overflow(spark):
    from creditecho.operators.bm25 import wide_sum

    df = spark.createDataFrame([(6e8,), (6e8,), (0.1,), (None,)], "x double")
    assert df.agg(wide_sum(df["x"])).first()[0] == 1_200_000_000.1

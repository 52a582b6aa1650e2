"""Steps whose memory or work must not grow with a whole batch."""
import numpy as np
from pyspark.sql import functions as F

from creditecho.functions import text as T
from creditecho.operators import index_store, knn


def test_visits_leave_in_small_frames():
    rng = np.random.default_rng(3)
    ids, vectors, centers = np.arange(700), rng.normal(size=(700, 16)), rng.normal(size=(256, 16))
    limits = np.full(256, 9.0), np.full(256, 50.0), np.full(256, 50.0)  # every query visits every cell
    frames = list(knn.visited(ids, vectors, centers, limits, False, "euclidean", None))
    assert max(map(len, frames)) <= knn.VISITS_AT_ONCE and sum(map(len, frames)) == 700 * 256
    assert sorted({i for f in frames for i in f["query_id"]}) == list(range(700))


def test_tokens_in_one_pass_equal_two(spark):
    odd = "".join(map(chr, [*range(1, 0x250), 0x3A3, 0x130, 0x660, 0x2003, 0x2028, 0x3000, 0xFEFF, 0x1F600, 0x10400, 0x301, 0x5F]))
    texts = [odd, " ".join(odd), "a,b  c\u00a0d\x1ce_f", "", None, "...", " x "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    words = F.split(F.regexp_replace(F.lower(F.coalesce("t", F.lit(""))), r"[^\p{L}\p{N}_\s]", " "), T.SPACE_RUN)
    for r in df.select(T.tokens(F.col("t")).alias("a"), F.filter(words, lambda w: w != "").alias("b")).collect():
        assert r.a == r.b


def test_steps_round_halves_away_from_zero_without_decimals(spark, capsys):
    df = spark.createDataFrame([(2.5e-10,), (-2.5e-10,), (0.0,), (12345.678,), (None,)], "x double")
    assert [r[0] for r in df.select(index_store.steps(F.col("x"))).collect()] == [3, -3, 0, 123456780000000, None]
    df.select(index_store.steps(F.col("x"))).explain()
    assert "round(" not in capsys.readouterr().out

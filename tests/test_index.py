"""The stored index: partition pruning, exact top-k with skipped blocks, trigram candidates against a scan."""
import random

import pytest

from creditecho.operators import index_store
from creditecho.operators.index_store import StoredIndex

SCHEMA = "id long, score double, title string, feedback string, timestamp timestamp, sentiment_label string, sentiment_score double"


def rows_of(texts, titles=None):
    return [(i, 3.0, titles[i] if titles else f"t{i}", t, None, None, None) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    words = [f"w{int(rng.paretovariate(0.6)) % 900}" for _ in range(4000)]
    return [" ".join(rng.choices(words, k=rng.choice([3, 10, 40, 160]))) for _ in range(3000)]


@pytest.fixture(scope="module")
def index(spark, texts, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("index") / "i")
    return index_store.build(spark.createDataFrame(rows_of(texts), SCHEMA), folder, range_docs=32)


def queries(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, query string")


def test_top_k_equals_the_full_ranking_and_skips_blocks(spark, index, texts):
    asked = queries(spark, ["w1 w2 w777", "w3 w3 w899 w640 w5", "w1", "none", "", texts[7]])
    full = index.top_documents(asked)
    for k in (1, 10, 10_000):
        want = sorted(map(tuple, full.filter(full["rank"] <= k).select("query_id", "rank", "doc_id", "bm25").collect()))
        assert sorted(map(tuple, index.top_documents(asked, k).select("query_id", "rank", "doc_id", "bm25").collect())) == want
    read = index.blocks_read(asked, 10).collect()
    assert all(r.read <= r.blocks for r in read)
    print("READ", [(r.query_id, r.read, r.blocks) for r in read])
    assert sum(r.read for r in read) < 0.85 * sum(r.blocks for r in read)
    assert index.top_documents(asked.filter("query_id = -1"), 3).count() == 0


def test_only_the_buckets_of_the_words_are_read(spark, index, capsys):
    asked = queries(spark, ["w1 w2"])
    assert index.buckets == 8
    index.scores(asked).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket#", "bucket") and "regexp" not in plan
    heads = index.range_bounds(*index.weighted(asked))
    heads.explain("formatted")
    plan = capsys.readouterr().out
    assert "docs:array" not in plan  # bounds read no lists of documents
    import re

    named = re.search(r"PartitionFilters: (.*)", plan)[1]
    wanted = {r[0] for r in index.query_terms(asked).select(index_store.bucket(index_store.F.col("term"), 8)).distinct().collect()}
    assert 0 < len(wanted) < 8 and all(str(b) in named for b in wanted)


def test_substrings_equal_a_scan(spark, tmp_path):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abAB É.\n") for _ in range(rng.randint(0, 30))) for _ in range(300)] + ["", "a", "ab", None, "\u00e9" * 50]
    titles = ["".join(rng.choice("abcd") for _ in range(rng.randint(0, 4))) or None for _ in texts]
    index = index_store.build(spark.createDataFrame(rows_of(texts, titles), SCHEMA), str(tmp_path / "i"), range_docs=16)
    asked = ["", "a", "B", "ab", "É", "abc", "A B", "bab", texts[0], texts[1][2:9], "zzz", "zz", "ab\n", "\u00c9" * 40, "dca"]
    want = {
        (q, i) for q, text in enumerate(asked) for i in range(len(texts))
        if any(x is not None and text.lower() in x.lower() for x in (texts[i], titles[i]))
    }
    found = [tuple(r) for r in index.substring_matches(queries(spark, asked)).collect()]
    assert set(found) == want and len(found) == len(want)


def test_empty_and_odd_corpora(spark, tmp_path):
    empty = index_store.build(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"))
    assert empty.top_documents(queries(spark, ["a"]), 3).count() == 0 and empty.substring_matches(queries(spark, ["a", "abc"])).count() == 0
    one = index_store.build(spark.createDataFrame(rows_of(["same words"] * 50), SCHEMA), str(tmp_path / "o"))
    got = StoredIndex(spark, str(tmp_path / "o")).top_documents(queries(spark, ["words"]), 3)
    assert got.count() == one.top_documents(queries(spark, ["words"]), 3).count()


def test_a_key_with_texts_of_several_lengths_is_one_document(spark, tmp_path):
    rng = random.Random(8)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(60)], k=rng.choice([2, 9, 30, 90]))) for _ in range(1200)]
    rows = [(i % 700 if i < 1190 else None, 3.0, "t", t, None, None, None) for i, t in enumerate(texts)]
    index = index_store.build(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "r"), range_docs=16)
    asked = queries(spark, ["w1 w2 w3", "w59", "w7 w7 w30 w31"])
    full = index.scores(asked)
    assert full.count() == full.select("query_id", "doc_id").distinct().count()
    want = index.top_documents(asked).filter("rank <= 7")
    assert sorted(map(str, index.top_documents(asked, 7).select("query_id", "rank", "doc_id", "bm25").collect())) == \
        sorted(map(str, want.select("query_id", "rank", "doc_id", "bm25").collect()))


def test_blocks_are_made_without_a_row_per_word(spark, texts, capsys):
    from pyspark.sql import functions as F

    words = spark.createDataFrame(list(enumerate(texts[:200])), "doc_id long, text string").withColumn("words", index_store.tokens(F.col("text")))
    placed = words.select("doc_id", "words", F.size("words").alias("dl"), (F.col("doc_id") % 3).alias("rng"))
    blocks = index_store.word_blocks(placed, 20.0)
    blocks.explain()
    assert "Generate" not in capsys.readouterr().out
    got = {(r.term, r.rng): [tuple(d) for d in r.docs] for r in blocks.collect()}
    want = {}
    for i, t in enumerate(texts[:200]):
        for w in set(t.split()):
            want.setdefault((w, i % 3), []).append((i, t.split().count(w), len(t.split())))
    assert got == want


def test_trigrams_in_tasks_equal_the_expression(spark, capsys):
    from pyspark.sql import functions as F

    texts = ["", "a", "abab", "\u00e9\U0001f600\u0130x", "aaaaaa", "ABAB", "x\ny"]
    rows = spark.createDataFrame([(i, i % 2, t.lower()) for i, t in enumerate(texts)], "doc_id long, rng long, text string")
    want = {(g, r.doc_id) for r in rows.select("doc_id", index_store.trigrams(F.col("text")).alias("g")).collect() for g in r.g}
    lists = index_store.gram_lists(rows.withColumn("texts", F.array("text", "text"))).collect()
    assert {(r.gram, d) for r in lists for d in r.docs} == want and sum(r.n for r in lists) == len(want)


def test_files_are_few_and_both_lists_are_written_once(spark, tmp_path, capsys):
    assert index_store.buckets_for(28_000_000) * index_store.BUCKET_FILES <= 128 and index_store.buckets_for(280_000_000) <= 80
    from creditecho.catalog import search

    tables = {
        "documents": ([(i, f"w{i % 7} w{i % 3}", "s") for i in range(30)], "doc_id long, text string, source string"),
        "labels": ([(1, 1, 0)], "doc_id long, quality int, toxic int"), "benchmark": ([(0, "w1 w2"), (1, "w5")], "item_id long, text string"),
        "embeddings": ([(i, [1.0, float(i)], 0) for i in range(30)], "vec_id long, embedding array<double>, label int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    for side in search.lists(spark, str(tmp_path)):
        assert side.count() > 0
        side.explain()
        plan = capsys.readouterr().out
        assert "FileScan parquet" in plan and not any(x in plan for x in ("MapInPandas", "MapInArrow", "Window", "Exchange"))


def test_trigram_ranges_are_smaller_for_long_texts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index_store, "RANGE_WORDS", 50)
    index = index_store.build(spark.createDataFrame(rows_of([f"w{i} " * 40 for i in range(60)]), SCHEMA), str(tmp_path / "g"))
    assert index.grams.select("rng").distinct().count() > 10

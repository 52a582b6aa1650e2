"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, for every operator and stage."""
import pytest

import corpus_pipeline
import public_tokenizers
from creditecho.llm import (
    byte_bpe, jaccard_join, mixing, neighbours, quality_classifier, quality_rules, secret_scan, substring_dedup, suffix_array_dedup, url_filter,
)
from creditecho.llm.queries import URL_RULES, VOCABULARY

PATH = public_tokenizers.path(VOCABULARY)
WORDS = " ".join(f"word{i}" for i in range(40))
ROWS = [(1, WORDS), (1, WORDS), (2, None), (None, WORDS + " more"), (3, ""), (4, " \n\t "), (5, "é " * 30_000), (6, "tok"), (None, None)]
LABELS = "doc_id long, quality int, toxic int, text string, _y int"

OPERATORS = {
    "mixing": lambda d, n: mixing.mix_plan(d),
    "quality_rules": lambda d, n: quality_rules.quality_report(d, n),
    "substring_dedup": lambda d, n: substring_dedup.repeats_removed(d),
    "byte_bpe": lambda d, n: byte_bpe.encode(d, PATH, round_trip=True),
    "quality_classifier": lambda d, n: quality_classifier.quality_scores(d, n),
    "suffix_array_dedup": lambda d, n: suffix_array_dedup.repeats_removed(d),
    "jaccard_join": lambda d, n: jaccard_join.jaccard_classes(d),
    "secret_scan": lambda d, n: secret_scan.scan(d),
    "masked": lambda d, n: secret_scan.masked_documents(d),
}


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0, "t", 0), (1, 1, 0, "t", 0), (5, 0, 0, None, 1), (6, None, None, None, None), (None, 1, 0, "", 1)], LABELS)


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document(frame, labels, name):
    assert OPERATORS[name](frame(ROWS), labels).count() == len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(frame, labels, name):
    assert OPERATORS[name](frame(ROWS).filter("doc_id = -1"), labels.filter("doc_id = -1")).count() == 0


def test_stages_keep_the_columns(spark, frame, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (ROWS, []):
        docs = frame(ROWS) if rows else frame(ROWS).filter("doc_id = -1")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            assert out.count() >= (1 if rows else 0), name


def test_pages_and_vectors(spark):
    pages = spark.createDataFrame([(1, None, "a"), (2, "x", None), (2, "x", None), (None, "http://a.net/", "k")], "page_id long, url string, rule string")
    out = [tuple(r) for r in url_filter.judge(pages, URL_RULES).orderBy("page_id").collect()]
    assert out == [(None, "a.net", "/", "net/", "block"), (1, "", "", None, "allow"), (2, "", "", None, "allow"), (2, "", "", None, "allow")]
    assert url_filter.judge(pages, []).filter("verdict = 'allow'").count() == 4
    assert url_filter.judge(pages.filter("page_id = -1"), URL_RULES).count() == 0
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, [1.0]), (None, [1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in neighbours.nearest(vectors, every=100).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]
    assert neighbours.nearest(vectors.filter("vec_id = -1"), every=100).count() == 0

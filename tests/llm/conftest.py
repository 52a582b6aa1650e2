import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _size int, size string"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with columns that clash with helper names; some values are null in every column."""

    def make(rows, parts=3):
        full = [(i, t, None if k % 4 == 0 else "en", f"s{k % 3}" if k % 5 else None, len(t or ""), "x", 1, None) for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make

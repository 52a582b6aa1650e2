"""Permuterm neighbours against all pairs, and the words, forms and roots against a plain computation."""
import random
import re
import zlib
from collections import Counter

import pyarrow as pa

from creditecho.llm import spelling


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(counts, ratio=10):
    near = {w: [v for v in counts if v != w and is_near(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, n, len(near[w]), form[w], counts[form[w]] if form[w] else None, root(w)) for w, n in counts.items())


def got(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


def test_random_words(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé\U0001F600") for _ in range(rng.randint(1, 6))): rng.choice([1, 2, 3, 30, 300, 3000]) for _ in range(700)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # groups run over batch limits
    try:
        assert got(spelling.group_variants(frame, min_count=2)) == expected({w: n for w, n in words.items() if n >= 2})
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_ties_chains_repeats(spark):
    rows = [("word", 1000), ("wort", 1000), ("worm", 100), ("worms", 10), ("wormss", 1), ("wormss", 0), ("", 5), (None, 9), ("aab", 40), ("ab", 400), ("aaab", 4)]
    counts = Counter()
    for w, n in rows:
        if w is not None:
            counts[w] += n
    out = got(spelling.group_variants(spark.createDataFrame(rows, "word string, n long"), min_count=1))
    assert out == expected(dict(counts))
    assert {r[0]: r[5] for r in out}["wormss"] == "word"  # ties go to the smaller word, forms are followed to the last


def test_long_words(spark):
    rng = random.Random(9)
    bases = ["".join(rng.choice("abc") for _ in range(size)) for size in (spelling.LONG - 1, spelling.LONG, spelling.LONG + 1, 300)]
    words = {}
    for base in bases:
        for _ in range(25):
            i, kind = rng.randrange(len(base)), rng.randrange(3)
            word = base[:i] + ("" if kind == 0 else rng.choice("abc") * kind) + base[i + 1:]
            words[word] = rng.choice([2, 2, 50, 50])
        words[base] = 2
    assert got(spelling.group_variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == expected(words)


def test_documents(spark, frame):
    rng = random.Random(5)
    stock = ["".join(rng.choice("abcÉé") for _ in range(8)) for _ in range(12)]
    rows = [(i if i % 9 else None, " ".join(w if rng.random() < 0.8 else w[:3] + "x" + w[4:] for w in rng.choices(stock, k=60)).title()) for i in range(80)]
    rows += [(500, None), (501, ""), (502, " \n"), (503, "short 12345678"), (504, "Z" * 50_000), (504, "Z" * 50_000), (505, "one÷two×three " * 3)]
    counts = Counter()
    for key, text in rows:
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for run in re.findall("[a-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= 7
    docs = frame(rows)
    assert got(spelling.spelling_variants(docs)) == expected({w: n for w, n in counts.items() if n >= 2})
    assert spelling.spelling_variants(docs.filter("doc_id = -1")).count() == 0


def test_no_neighbours():
    batch = pa.RecordBatch.from_pydict({"key": ["a\x00", "b\x00"], "ch": ["", ""], "first": [False, False], "n": [1, 1]})
    assert spelling.near_in_groups(batch) is None
    assert list(spelling.scan_groups(iter([batch]))) == []

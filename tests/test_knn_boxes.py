"""Neighbours of many queries in few dimensions: boxes against brute force."""
import numpy as np
import pytest

from creditecho.operators import knn


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_boxes_equal_brute_force(spark, metric, monkeypatch):
    monkeypatch.setattr(knn, "BOX_ROWS", 16)
    rng = np.random.default_rng(5)
    c = np.concatenate([rng.normal(size=(500, 3)), np.tile([0.25, 0.5, 3.0], (90, 1)), np.round(rng.normal(size=(300, 3))), [[900.0, 0, 0]]])
    q = np.concatenate([rng.normal(size=(150, 3)), c[480:620], [[-800.0, 5, 5], [np.nan, 0, 0]]])
    keys = rng.permutation(len(c)) * 3
    left = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id long, vector array<double>")
    right = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(keys, c)], "doc_id long, vector array<double>")
    got = {}
    for r in knn.nearest(left, right, 5, metric, scan_queries=0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.distance, r.doc_id))
    for i, v in enumerate(q[:-1]):
        gap = c - v
        d = np.round(np.abs(gap).sum(1) if metric == "manhattan" else np.sqrt((gap * gap).sum(1)), 9)
        want = sorted(zip(d, keys))[:5]
        assert [(x[1], x[2]) for x in sorted(got[i])] == [(pytest.approx(a, abs=2e-9), b) for a, b in want]
    assert len(q) - 1 not in got


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_boxes_leave_out_rows_of_the_own_key(spark, metric, monkeypatch):
    monkeypatch.setattr(knn, "BOX_ROWS", 16)
    monkeypatch.setattr(knn, "_cells", None)
    rng = np.random.default_rng(7)
    rows = np.concatenate([rng.normal(size=(300, 3)), np.tile([0.25, 0.5, 3.0], (60, 1)), np.round(rng.normal(size=(200, 3))), [[900.0, 0, 0]]])
    keys = rng.permutation(len(rows)) * 3
    keys[300:309] = keys[300]  # a key nine times, with one vector
    keys[10:16] = keys[10]  # and one with six
    table = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(keys, rows)], "doc_id long, vector array<double>")
    asked = table.withColumnRenamed("doc_id", "query_id")
    got = {}
    for r in knn.nearest(asked, table, 4, metric, exclude_self=True, scan_queries=0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.distance, r.doc_id))
    for key in set(keys.tolist()):
        hits = []
        for v in rows[keys == key]:
            gap = rows - v
            d = np.round(np.abs(gap).sum(1) if metric == "manhattan" else np.sqrt((gap * gap).sum(1)), 9)
            hits += [(a, b) for a, b in zip(d, keys) if b != key]
        assert [(x[1], x[2]) for x in sorted(got[key])] == [(pytest.approx(a, abs=2e-9), b) for a, b in sorted(hits)[:4]]


def test_a_query_visits_few_boxes_at_any_size():
    rng = np.random.default_rng(6)
    mean = []
    for n in (4_000, 32_000):
        rows = rng.normal(size=(n, 3))
        tree = knn.BoxTree(rows[::8], n // 100)
        leaf = tree.place(rows)
        size = len(tree.axis)
        count, low, high = np.bincount(leaf, minlength=size), np.full((size, 3), np.inf), np.full((size, 3), -np.inf)
        np.minimum.at(low, leaf, rows)
        np.maximum.at(high, leaf, rows)
        tree.fit(count, low, high)
        assert count.max() <= n and tree.count[0] == n and count[tree.axis < 0].max() < 400
        asked = rng.normal(size=(200, 3))
        bound = np.array([np.sort(np.sqrt(((rows[leaf == b] - v) ** 2).sum(1)))[4] for v, b in zip(asked, tree.place(asked))])
        mean.append(len(tree.visits(asked, bound, 5, "euclidean")[0]) / 200)
    assert mean[1] < 1.5 * mean[0] and mean[1] < 16


def test_broadcasts_hold_plain_arrays():
    tree = knn.BoxTree(np.arange(64.0).reshape(32, 2), 4)
    assert all(type(x) in (np.ndarray, type(None)) for x in tree.arrays())
    assert (knn.BoxTree.of(tree.arrays()).place(np.ones((3, 2))) == tree.place(np.ones((3, 2)))).all()

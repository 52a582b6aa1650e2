"""Nearest neighbours between two tables of vectors.

Vector arithmetic runs in NumPy inside Arrow tasks; Spark spreads the work and merges the lists. Only the
first k per query leave a task, never all pairs.

* few queries: their matrix is broadcast after a count, and the corpus is read once;
* many queries: both tables are divided into cells around pivots. A query visits only the cells that can
  still hold one of its k nearest rows (triangle inequality), so the answer stays exact. Large cells are
  split into tiles, and the visitors of a cell into blocks, so no group grows with the data.

* many queries of few dimensions: boxes of a kd-tree over a bounded sample instead of cells. A query first searches the box it lies in; its k-th
  distance there says which other boxes it must visit. Boxes hold about ``BOX_ROWS`` rows, so the work per query does not grow with the corpus.

A zero vector has cosine 0 with everything. The triangle inequality says nothing about it, so zero rows stay out of the cells; only the
first k of them by key can be among the nearest, and these join every list.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditecho.operators.totals import top_ranked
from creditecho.session import stored

SCAN_QUERIES = 20_000
SCAN_CELLS = 5_000_000
TILE_ROWS = 20_000
PAIRS_AT_ONCE = 4_000_000
VISITS_AT_ONCE = 16_384
DIGITS = 9
BOX_DIMENSIONS = 16
BOX_ROWS = 2_048
MAX_BOXES = 65_536
BOX_SAMPLE = 16  # sampled rows a box
BOX_QUERIES = 4_096
HITS_A_QUERY = 8  # rows within the known distance, in lists of k, from which on a block looks for its own k-th distance


def _unit(m: np.ndarray) -> np.ndarray:
    """Rows of length 1; zero rows stay zero."""
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm > 0, norm, 1.0)


def _matrix(column) -> np.ndarray:
    return np.asarray(np.stack(column.to_numpy()), dtype=np.float64) if len(column) else np.zeros((0, 1))


def _flat(column) -> np.ndarray:
    """The matrix of an Arrow column of lists of equal length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _keys(column) -> np.ndarray:
    return np.asarray(column.fill_null(np.iinfo(np.int64).min), dtype=np.int64)


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def distances(q: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    """Distance of every query to every row; inner product is negated."""
    if metric == "cosine":
        return -(q @ c.T)
    if metric == "manhattan":
        out = np.zeros((len(q), len(c)))
        for j in range(q.shape[1]):
            out += np.abs(q[:, j, None] - c[None, :, j])
        return out
    squares = (q * q).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * (q @ c.T)
    return np.sqrt(np.maximum(squares, 0))


def _exact(q: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    """Row-by-row distance of paired vectors."""
    if metric == "cosine":
        return -np.einsum("ij,ij->i", q, c)
    gap = q - c
    return np.abs(gap).sum(1) if metric == "manhattan" else np.sqrt((gap * gap).sum(1))


class NearestList:
    """The k nearest rows seen so far for each query; ties go to the smaller key."""

    def __init__(self, queries: np.ndarray, k: int, metric: str, own: np.ndarray | None = None):
        self.queries, self.k, self.metric, self.own = queries, k, metric, own
        self.row = np.zeros(0, dtype=np.int64)
        self.dist = np.zeros(0)
        self.key = np.zeros(0, dtype=np.int64)
        self.worst = np.full(len(queries), np.inf)

    def add(self, keys: np.ndarray, vectors: np.ndarray) -> None:
        step = max(1, PAIRS_AT_ONCE // max(1, len(self.queries)))
        for at in range(0, len(keys), step):
            self._add(keys[at:at + step], vectors[at:at + step])

    def _add(self, keys: np.ndarray, vectors: np.ndarray) -> None:
        d = distances(self.queries, vectors, self.metric)
        if self.own is not None:
            d[self.own[:, None] == keys[None, :]] = np.inf
        cut = self.worst
        slack = 1e-6 * (1 + np.abs(np.where(np.isfinite(cut), cut, 0)))
        near = d <= (cut + slack)[:, None]
        if d.shape[1] > self.k and np.count_nonzero(near) > HITS_A_QUERY * self.k * len(d):
            cut = np.minimum(cut, np.partition(d, self.k - 1, axis=1)[:, self.k - 1])
            slack = 1e-6 * (1 + np.abs(np.where(np.isfinite(cut), cut, 0)))
            near = d <= (cut + slack)[:, None]
        r, c = np.nonzero(near & np.isfinite(d))
        if not len(r):
            return
        exact = np.round(_exact(self.queries[r], vectors[c], self.metric), DIGITS) + 0.0  # no negative zero
        row = np.concatenate([self.row, r])
        dist = np.concatenate([self.dist, exact])
        key = np.concatenate([self.key, keys[c]])
        order = np.lexsort((key, dist, row))
        row, dist, key = row[order], dist[order], key[order]
        place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
        keep = place < self.k
        self.row, self.dist, self.key = row[keep], dist[keep], key[keep]
        full = place[keep] == self.k - 1
        self.worst[self.row[full]] = self.dist[full]


def _result(frame: DataFrame, k: int) -> DataFrame:
    best = top_ranked(frame.withColumn("_near", -F.col("distance")), ["query_id"], "_near", "doc_id", k)
    return best.drop("_near")


def _scan(queries: DataFrame, corpus: DataFrame, k: int, metric: str, exclude_self: bool) -> DataFrame:
    rows = queries.select("query_id", "vector").toPandas()
    ids = rows["query_id"].to_numpy(dtype=np.int64)
    matrix = _matrix(rows["vector"])
    shared = queries.sparkSession.sparkContext.broadcast((ids, _unit(matrix) if metric == "cosine" else matrix))

    def task(batches):
        keys, m = shared.value
        best = NearestList(m, k, metric, keys if exclude_self else None)
        for b in batches:
            if len(b):
                v = _matrix(b["vector"])
                best.add(b["doc_id"].to_numpy(dtype=np.int64), _unit(v) if metric == "cosine" else v)
        if len(best.row):
            yield pd.DataFrame({"query_id": keys[best.row], "doc_id": best.key, "distance": best.dist})

    if not len(ids):
        return corpus.select(F.lit(0).cast("long").alias("query_id"), F.col("doc_id").cast("long").alias("doc_id"),
                             F.lit(0.0).alias("distance")).filter("false")
    return corpus.select("doc_id", "vector").mapInPandas(task, "query_id long, doc_id long, distance double")


def _pivots(corpus: DataFrame, n: int) -> np.ndarray:
    """A bounded, repeatable sample of corpus vectors in hash order."""
    rows = corpus.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).select("vector").collect()
    return np.array([r[0] for r in rows], dtype=np.float64)


def _cells(
    queries: DataFrame, corpus: DataFrame, k: int, metric: str, exclude_self: bool, pivots: int, probes: int | None,
    tile_rows: int,
) -> DataFrame:
    spark = corpus.sparkSession
    unit = metric == "cosine"
    need = k + (1 if exclude_self else 0)
    beside = None
    if unit:
        zero = F.coalesce(F.forall("vector", lambda x: x == 0), F.lit(False))
        beside = _zero_hits(queries, corpus.filter(zero), need, exclude_self)
        corpus = corpus.filter(~zero)
    space = "euclidean" if unit else metric  # order by angle equals order by distance of unit vectors
    centers = _pivots(corpus, pivots)
    if not len(centers):
        return beside if unit else _no_hits(queries)
    centers = _unit(centers) if unit else centers
    shared = spark.sparkContext.broadcast(centers)

    def assign(batches):
        for b in batches:
            if len(b):
                v = _matrix(b["vector"])
                v = _unit(v) if unit else v
                d = distances(v, shared.value, space)
                near = d.argmin(1)
                yield pd.DataFrame({
                    "doc_id": b["doc_id"], "vector": list(v), "cell": near, "radius": d[np.arange(len(v)), near]
                })

    placed = corpus.select("doc_id", "vector").mapInPandas(
        assign, "doc_id long, vector array<double>, cell int, radius double"
    )
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("radius").alias("far")).collect()
    inner = (
        top_ranked(placed.select("cell", "doc_id", (-F.col("radius")).alias("_near"), "radius"), ["cell"], "_near", "doc_id", need)
        .groupBy("cell").agg(F.max("radius").alias("r"), F.count("*").alias("m")).collect()
    )
    count, far, kth = (np.zeros(len(centers)), np.full(len(centers), -np.inf), np.full(len(centers), np.inf))
    for row in sizes:
        count[row["cell"]], far[row["cell"]] = row["n"], row["far"]
    for row in inner:
        if row["m"] >= need:
            kth[row["cell"]] = row["r"]
    limits = spark.sparkContext.broadcast((count, far, kth))

    def visit(batches):
        for b in batches:
            yield from visited(b["query_id"].to_numpy(), _matrix(b["vector"]), shared.value, limits.value, unit, space, probes)

    visits = queries.select("query_id", "vector").mapInPandas(visit, "query_id long, vector array<double>, cell int")
    guests = {row["cell"]: row["n"] for row in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    plan = [
        (c, max(1, math.ceil(count[c] / tile_rows)), max(1, math.ceil(guests.get(c, 0) / tile_rows)))
        for c in range(len(centers)) if count[c] > 0 and guests.get(c)
    ]
    plan = plan or [(-1, 1, 1)]
    tiles = spark.createDataFrame(plan, "cell int, tiles int, blocks int")
    left = visits.join(F.broadcast(tiles), "cell").select(
        "query_id", "vector", "cell", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"),
    )
    right = placed.join(F.broadcast(tiles), "cell").select(
        "doc_id", "vector", "cell", F.pmod(F.xxhash64("doc_id"), F.col("tiles")).cast("int").alias("tile"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )

    def compare(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": [], "doc_id": [], "distance": []}).astype(
                {"query_id": "int64", "doc_id": "int64", "distance": "float64"}
            )
        ids = q["query_id"].to_numpy(dtype=np.int64)
        best = NearestList(_matrix(q["vector"]), k, metric, ids if exclude_self else None)
        best.add(c["doc_id"].to_numpy(dtype=np.int64), _matrix(c["vector"]))
        return pd.DataFrame({"query_id": ids[best.row], "doc_id": best.key, "distance": best.dist})

    keys = ["cell", "tile", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        compare, "query_id long, doc_id long, distance double"
    )
    return found.unionByName(beside) if unit else found


def visited(ids: np.ndarray, vectors: np.ndarray, centers: np.ndarray, limits: tuple, unit: bool, space: str, probes: int | None):
    """Frames (query_id, vector, cell) of the cells that queries visit, at most VISITS_AT_ONCE rows or one query each: a query may visit
    every cell, so one frame for all of a batch would hold its vectors as often as there are cells."""
    n, reach, inside = limits
    step = max(1, VISITS_AT_ONCE // len(centers))
    for at in range(0, len(ids), step):
        v = _unit(vectors[at:at + step]) if unit else vectors[at:at + step]
        d = distances(v, centers, space)
        bound = (d + inside[None, :]).min(1)
        go = ((d - reach[None, :]) <= bound[:, None] + 1e-6) & (n[None, :] > 0)
        if probes:
            open_d = np.where(n[None, :] > 0, d, np.inf)
            rank = open_d.argsort(1, kind="stable").argsort(1, kind="stable")
            go &= rank < probes
        r, c = np.nonzero(go)
        yield pd.DataFrame({"query_id": ids[at:at + step][r], "vector": [v[i] for i in r], "cell": c.astype(np.int32)})


class BoxTree:
    """A kd-tree over a sample: arrays of nodes, whose leaves are the boxes. Any split is right; the sample only decides balance."""

    def __init__(self, sample: np.ndarray, boxes: int):
        self.axis, self.cut, self.left, self.right = [], [], [], []
        self._grow(sample, boxes)
        self.axis, self.cut, self.left, self.right = (np.array(x) for x in (self.axis, self.cut, self.left, self.right))
        self.low = self.high = self.count = None

    def arrays(self) -> tuple:
        """What a broadcast may hold: workers have no copy of the package."""
        return self.axis, self.cut, self.left, self.right, self.count, self.low, self.high

    @staticmethod
    def of(arrays: tuple) -> BoxTree:
        tree = BoxTree.__new__(BoxTree)
        tree.axis, tree.cut, tree.left, tree.right, tree.count, tree.low, tree.high = arrays
        return tree

    def _grow(self, rows: np.ndarray, boxes: int) -> int:
        node = len(self.axis)
        for values, value in ((self.axis, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1)):
            values.append(value)
        if boxes > 1 and len(rows) > 1:
            spread = rows.max(0) - rows.min(0)
            axis = int(spread.argmax())
            x = np.sort(rows[:, axis])
            if x[0] < x[-1]:
                cut = x[(len(x) - 1) // 2]
                cut = cut if cut < x[-1] else x[x < cut].max()
                below = rows[:, axis] <= cut
                self.axis[node], self.cut[node] = axis, cut
                self.left[node] = self._grow(rows[below], boxes // 2)
                self.right[node] = self._grow(rows[~below], boxes - boxes // 2)
        return node

    def place(self, v: np.ndarray) -> np.ndarray:
        """The leaf of every vector."""
        at = np.zeros(len(v), dtype=np.int64)
        while True:
            go = np.flatnonzero(self.axis[at] >= 0)
            if not len(go):
                return at
            here = at[go]
            at[go] = np.where(v[go, self.axis[here]] <= self.cut[here], self.left[here], self.right[here])

    def fit(self, count: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Rows and limits of the leaves; those of inner nodes follow, children first. An empty box is nowhere."""
        self.count, self.low, self.high = count, low, high
        for i in range(len(self.axis) - 1, -1, -1):
            if self.axis[i] >= 0:
                sides = [self.left[i], self.right[i]]
                self.count[i], self.low[i], self.high[i] = count[sides].sum(), low[sides].min(0), high[sides].max(0)

    def gap(self, v: np.ndarray, node: np.ndarray, metric: str, farthest: bool = False) -> np.ndarray:
        """Least (or largest) distance of a vector to the box of a node, pair by pair."""
        below, above = self.low[node] - v, v - self.high[node]
        side = np.maximum(-below, -above) if farthest else np.maximum(np.maximum(below, above), 0)
        return side.sum(-1) if metric == "manhattan" else np.sqrt((side * side).sum(-1))

    def visits(self, v: np.ndarray, bound: np.ndarray, k: int, metric: str) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of all boxes that may hold a row within ``bound``. Without a bound, a box of k rows that lies wholly near gives one."""
        bound = bound.copy()
        full = np.flatnonzero((self.axis < 0) & (self.count >= k))
        for i in np.flatnonzero(~np.isfinite(bound)) if len(full) else ():
            bound[i] = self.gap(v[i][None, :], full, metric, farthest=True).min()
        row, node = np.arange(len(v)), np.zeros(len(v), dtype=np.int64)
        rows, leaves = [], []
        while len(row):
            near = (self.count[node] > 0) & (self.gap(v[row], node, metric) <= bound[row] + 1e-6 * (1 + np.abs(bound[row])))
            row, node = row[near], node[near]
            leaf = self.axis[node] < 0
            rows.append(row[leaf])
            leaves.append(node[leaf])
            row, node = row[~leaf], node[~leaf]
            row, node = np.concatenate([row, row]), np.concatenate([self.left[node], self.right[node]])
        return np.concatenate(rows or [row]), np.concatenate(leaves or [node])


def _first_of_equal(rows: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """Of equal vectors the rows that can be in a list of k: the first k by key. Where a query leaves out rows of its own key, rows of the
    first k + 1 keys, at most k of a key."""
    if not exclude_self:
        return top_ranked(rows.withColumn("_near", -F.col("doc_id")), ["vector"], "_near", "doc_id", k).select("doc_id", "vector")
    place = F.dense_rank().over(W.partitionBy("vector").orderBy("doc_id"))
    copy = F.row_number().over(W.partitionBy("vector", "doc_id").orderBy("doc_id"))
    return rows.withColumn("_key", place).filter(F.col("_key") <= k + 1).withColumn("_copy", copy).filter(F.col("_copy") <= k).select("doc_id", "vector")


def _boxes(queries: DataFrame, corpus: DataFrame, k: int, metric: str, exclude_self: bool = False) -> DataFrame:
    """Exact lists by boxes. Of equal vectors only the first by key can be in a list, so a hot vector is cut to these before rows are placed."""
    spark = corpus.sparkSession
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.coalesce(F.forall("vector", finite), F.lit(False))
    queries = queries.filter(usable).select(F.col("query_id").cast("long").alias("query_id"), F.col("vector").cast("array<double>").alias("vector"))
    rows = corpus.filter(usable).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("vector").cast("array<double>").alias("vector"))
    rows = stored(_first_of_equal(rows, k, exclude_self), "knn-rows")
    n = rows.count()
    if not n:
        return _no_hits(queries)
    boxes = max(1, min(MAX_BOXES, n // BOX_ROWS))
    step = max(1, n // (boxes * BOX_SAMPLE))
    sample = _flat(rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0).select("vector").toArrow().column("vector"))
    tree = BoxTree(sample, boxes if len(sample) else 1)
    shape = spark.sparkContext.broadcast(tree.arrays())

    def place(batches):
        tree = BoxTree.of(shape.value)
        for b in batches:
            if b.num_rows:
                box = pa.array(tree.place(_flat(b.column("vector"))), pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column("vector"), box], names=[b.schema.names[0], "vector", "box"])

    placed = rows.mapInArrow(place, "doc_id long, vector array<double>, box int")
    width = len(rows.select("vector").first()[0])
    limits = [f(F.get("vector", F.lit(i))).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in range(width)]
    told = placed.groupBy("box").agg(F.count("*").alias("n"), *limits).toArrow()  # at most MAX_BOXES rows
    count, low, high = np.zeros(len(tree.axis), np.int64), np.full((len(tree.axis), width), np.inf), np.full((len(tree.axis), width), -np.inf)
    at, ends = np.asarray(told.column("box")), np.stack([np.asarray(told.column(i), float) for i in range(2, 2 + 2 * width)], axis=1)
    count[at], low[at], high[at] = np.asarray(told.column("n")), ends[:, :width], ends[:, width:]
    tree.fit(count, low, high)
    fitted = spark.sparkContext.broadcast(tree.arrays())
    # a box of so many rows holds k that a query may list
    enough = k + (rows.groupBy("doc_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] if exclude_self else 0)

    def searched(asked: DataFrame, task, schema: str) -> DataFrame:
        """``task`` on the queries of every box, at most about BOX_QUERIES at once, beside the rows of the box."""
        guests = asked.groupBy("box").agg(F.ceil(F.count("*") / BOX_QUERIES).cast("int").alias("blocks"))
        guests = F.broadcast(stored(guests, "knn-guests"))
        left = asked.join(guests, "box").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int")).drop("blocks")
        right = placed.join(guests, "box").select("doc_id", "vector", "box", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        return left.groupBy("box", "block").cogroup(right.groupBy("box", "block")).applyInArrow(task, schema)

    def listed(q: pa.Table, c: pa.Table, bound: np.ndarray | None = None) -> tuple[np.ndarray, NearestList]:
        ids = _keys(q.column("query_id"))
        best = NearestList(_flat(q.column("vector")), k, metric, ids if exclude_self else None)
        if bound is not None:
            best.worst = bound.copy()
        if len(ids) and c.num_rows:
            best.add(_keys(c.column("doc_id")), _flat(c.column("vector")))
        return ids, best

    def home(q: pa.Table, c: pa.Table) -> pa.Table:
        _, best = listed(q, c)
        ends = np.searchsorted(best.row, np.arange(q.num_rows + 1))
        return pa.table({
            "query_id": q.column("query_id"), "vector": q.column("vector"), "box": q.column("box"), "bound": pa.array(best.worst[:q.num_rows]),
            "docs": _lists(best.key, ends), "distances": _lists(best.dist, ends),
        })

    def visit(batches):
        tree = BoxTree.of(fitted.value)
        for b in batches:
            for at in range(0, b.num_rows, VISITS_AT_ONCE // 16):
                part = b.slice(at, VISITS_AT_ONCE // 16)
                v, bound = _flat(part.column("vector")), np.asarray(part.column("bound"), dtype=np.float64)
                row, box = tree.visits(v, bound, enough, metric)
                away = box != np.asarray(part.column("box"))[row]
                row, box = row[away], box[away]
                for first in range(0, len(row), VISITS_AT_ONCE):
                    r = pa.array(row[first:first + VISITS_AT_ONCE])
                    yield pa.RecordBatch.from_arrays([
                        part.column("query_id").take(r), part.column("vector").take(r), part.column("bound").take(r),
                        pa.array(box[first:first + VISITS_AT_ONCE], pa.int32()),
                    ], names=["query_id", "vector", "bound", "box"])

    def compare(q: pa.Table, c: pa.Table) -> pa.Table:
        ids, best = listed(q, c, np.asarray(q.column("bound"), dtype=np.float64))
        return pa.table({"query_id": pa.array(ids[best.row]), "doc_id": pa.array(best.key), "distance": pa.array(best.dist)})

    asked = queries.mapInArrow(place, "query_id long, vector array<double>, box int")
    near = stored(searched(
        asked, home, "query_id long, vector array<double>, box int, bound double, docs array<long>, distances array<double>"
    ), "knn-home")
    own = near.select("query_id", F.explode(F.arrays_zip("docs", "distances")).alias("h")).select(
        "query_id", F.col("h.docs").alias("doc_id"), F.col("h.distances").alias("distance")
    )
    visits = near.select("query_id", "vector", "bound", "box").mapInArrow(visit, "query_id long, vector array<double>, bound double, box int")
    return own.unionByName(searched(visits, compare, "query_id long, doc_id long, distance double"))


def _no_hits(queries: DataFrame) -> DataFrame:
    return queries.sparkSession.createDataFrame([], "query_id long, doc_id long, distance double")


def _zero_hits(queries: DataFrame, zeros: DataFrame, need: int, exclude_self: bool) -> DataFrame:
    """The first ``need`` zero rows by key as hits of every query: at most k + 1 keys pass through the driver."""
    keys = [int(r[0]) for r in zeros.select("doc_id").orderBy("doc_id").limit(need).collect()]
    if not keys:
        return _no_hits(queries)
    listed = F.explode(F.array(*[F.lit(x).cast("long") for x in keys]))
    hits = queries.select(F.col("query_id").cast("long").alias("query_id"), listed.alias("doc_id"), F.lit(0.0).alias("distance"))
    return hits.filter("query_id <> doc_id") if exclude_self else hits


def nearest(
    queries: DataFrame, corpus: DataFrame, k: int, metric: str = "cosine", exclude_self: bool = False,
    pivots: int = 256, probes: int | None = None, scan_queries: int = SCAN_QUERIES, tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """(query_id, doc_id, distance, rank): the k nearest corpus rows of every query.

    ``queries`` holds (query_id, vector), ``corpus`` (doc_id, vector). Metrics: cosine (the distance is the
    negated similarity), euclidean, manhattan. ``probes`` visits only that many cells per query: approximate.
    """
    metric = {"minkowski": "euclidean"}.get(metric, metric)
    queries = queries.filter(F.col("vector").isNotNull())
    corpus = corpus.filter(F.col("vector").isNotNull())
    allowed = min(scan_queries, SCAN_CELLS // max(1, k))
    few = probes is None and queries.limit(allowed + 1).count() <= allowed
    if few:
        return _result(_scan(queries, corpus, k, metric, exclude_self), k)
    first = corpus.select(F.size("vector")).first() if probes is None and metric in ("euclidean", "manhattan") else None
    if first and 0 < first[0] <= BOX_DIMENSIONS:
        return _result(_boxes(queries, corpus, k, metric, exclude_self), k)
    return _result(_cells(queries, corpus, k, metric, exclude_self, pivots, probes, tile_rows), k)


def similar(queries: DataFrame, corpus: DataFrame, min_sim: float | None = None, block_rows: int = SCAN_QUERIES) -> DataFrame:
    """(query_id, doc_id, distance) of every pair with cosine similarity >= ``min_sim``.

    Pairs below the limit never leave a task. Without a limit the answer is the whole list by definition.
    Query tables above one block take several passes over the corpus.
    """
    queries = queries.filter(F.col("vector").isNotNull())
    corpus = corpus.filter(F.col("vector").isNotNull()).select("doc_id", "vector")
    limit = -np.inf if min_sim is None else min_sim
    blocks = max(1, -(-queries.count() // block_rows))
    out = None
    for block in range(blocks):
        mine = queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        rows = mine.select("query_id", "vector").toPandas()
        ids = rows["query_id"].to_numpy(dtype=np.int64)
        shared = queries.sparkSession.sparkContext.broadcast((ids, _unit(_matrix(rows["vector"]))))

        def task(batches, shared=shared):
            keys, m = shared.value
            for b in batches:
                step = max(1, PAIRS_AT_ONCE // max(1, len(keys)))
                for at in range(0, len(b), step):
                    part = b.iloc[at:at + step]
                    v = _unit(_matrix(part["vector"]))
                    r, c = np.nonzero((m @ v.T) >= limit - 1e-6) if len(keys) else ([], [])
                    exact = np.round(_exact(m[r], v[c], "cosine"), DIGITS) if len(r) else np.zeros(0)
                    near = -exact >= limit
                    yield pd.DataFrame({
                        "query_id": keys[r][near] if len(r) else np.zeros(0, dtype=np.int64),
                        "doc_id": part["doc_id"].to_numpy(dtype=np.int64)[c][near] if len(r) else np.zeros(0, dtype=np.int64),
                        "distance": exact[near],
                    })

        found = corpus.mapInPandas(task, "query_id long, doc_id long, distance double")
        out = found if out is None else out.unionByName(found)
    return out


def knn_classify(test: DataFrame, train: DataFrame, k: int, metric: str = "euclidean", **options) -> DataFrame:
    """Positive share among the k nearest training rows: (query_id, probability, prediction)."""
    found = nearest(test, train.select("doc_id", "vector"), k, metric, **options)
    voted = found.join(train.select("doc_id", "label"), "doc_id").groupBy("query_id").agg(
        F.avg(F.col("label").cast("double")).alias("probability")
    )
    return voted.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))

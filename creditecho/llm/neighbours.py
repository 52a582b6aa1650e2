"""Approximate nearest neighbours by low-dimensional stable projections, a kd-tree over them, and a chi-square stopping test.

Vectors are projected by ``dims`` Gaussian (2-stable) directions. For a point at distance r the squared projected distance, divided by r squared, is
chi-square distributed with ``dims`` degrees of freedom. One kd-tree serves the whole table: its splits are fitted on a sample of at most ``SAMPLE``
rows, every row is assigned to a leaf (a cell), and the cells' boxes are taken over all rows. A query takes its nearest cells first. With the k-th
distance found there, it goes to those other cells only whose box is near enough that a nearer neighbour would, with probability ``sure``, have been
projected there. In a cell the points come in order of projected distance and are verified on the original vectors until the same test holds for
the next one. ``search_cost`` tells how many rows were verified.

Every row is indexed, once per round in the shuffle. A cell of many rows (equal vectors, or a very large table) is dealt into tiles and its queries into
blocks, so a task's groups stay bounded; only k rows per query and tile leave it.

Defined cases: vectors that are null, empty, zero, of another length than the most common one, or that hold null or non-finite components take no part,
neither as queries nor as candidates; equal rows (vec_id and vector) count once; rows with the query's vec_id are not its candidates; query rows
of one vec_id have a ranking each; ties go to the smaller vec_id; a null vec_id takes no part; an empty table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditecho.llm.store import stored

DIMS = 24
SURE = 0.92
SEED = 5
SAMPLE = 20_000
CELL_ROWS = 8_000
BLOCK_ROWS = 4_000
FIRST_CELLS = 2
STEP = 64  # points verified between two tests


def chi_square_quantile(p: float, dims: int) -> float:
    """Solved by bisection on the series of the regularised lower incomplete gamma function."""

    def below(x: float) -> float:
        a, z = dims / 2, x / 2
        term = total = 1 / a
        k = a
        while term > total * 1e-15:
            k += 1
            term *= z / k
            total += term
        return total * math.exp(-z + a * math.log(z) - math.lgamma(a)) if z > 0 else 0.0

    low, high = 0.0, 20.0 * dims + 100
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return (low + high) / 2


def directions(width: int, dims: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((width, dims))


class KdTree:
    """Median splits of a sample on the widest side, down to ``leaves`` cells."""

    def __init__(self, points: np.ndarray, leaves: int):
        self.side, self.value, self.child = [], [], []
        self.leaves = 0
        self._grow(points, max(1, min(leaves, len(points))))

    def _grow(self, points: np.ndarray, leaves: int) -> int:
        """Number of the new node; leaves are numbered -1, -2, ..."""
        spread = np.ptp(points, axis=0) if len(points) else np.zeros(1)
        if leaves <= 1 or len(points) < 2 or spread.max() == 0:
            self.leaves += 1
            return -self.leaves
        side = int(spread.argmax())
        value = float(np.median(points[:, side]))
        low = points[:, side] < value
        if not low.any():  # more than half of the points are the least ones
            value = float(points[:, side][points[:, side] > value].min())
            low = points[:, side] < value
        node = len(self.side)
        self.side.append(side)
        self.value.append(value)
        self.child.append([0, 0])
        self.child[node] = [self._grow(points[low], leaves // 2), self._grow(points[~low], leaves - leaves // 2)]
        return node

    def cells(self, points: np.ndarray) -> np.ndarray:
        """Cell of every point, from 0 on."""
        at = np.zeros(len(points), np.int64) if self.side else np.full(len(points), -1)
        side, value, child = np.array(self.side, np.int64), np.array(self.value), np.array(self.child, np.int64).reshape(-1, 2)
        while (open_ := np.flatnonzero(at >= 0)).size:
            node = at[open_]
            at[open_] = child[node, (points[open_, side[node]] >= value[node]).astype(np.int64)]
        return -at - 1


def box_distances(low: np.ndarray, high: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distance of a projected query to every box."""
    gap = np.maximum(np.maximum(low - q, q - high), 0)
    return np.einsum("ij,ij->i", gap, gap)


def verify(vectors: np.ndarray, flat: np.ndarray, ids: np.ndarray, q: np.ndarray, own: int, q_flat: np.ndarray, k: int, limit: float, known: float):
    """(row numbers, distances, rows verified): the k nearest rows, taken in order of projected distance until the test holds; ``known`` is a k-th distance found elsewhere."""
    gap = flat - q_flat
    ahead = np.einsum("ij,ij->i", gap, gap)
    rows = np.flatnonzero((ids != own) & (ahead <= limit * known * known))
    rows = rows[np.argsort(ahead[rows], kind="stable")]
    best, at, done = np.zeros(0), np.zeros(0, np.int64), 0
    for begin in range(0, len(rows), STEP):
        if len(best) >= k:
            known = min(known, best[k - 1])
        part = rows[begin: begin + STEP]
        part = part[ahead[part] <= limit * known * known]
        if not len(part):
            break
        done += len(part)
        step = vectors[part] - q
        best, at = np.concatenate([best, np.sqrt((step * step).sum(axis=1))]), np.concatenate([at, part])
        keep = np.lexsort((ids[at], best))[:k]
        best, at = best[keep], at[keep]
    return at, best, done


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): distinct rows with finite, non-zero vectors of the most common length, as double arrays."""
    v = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter("vec_id is not null and v is not null")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.filter(good)
    width = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (width[0].n if width else 0)).dropDuplicates(["vec_id", "v"])


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    flat = table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1)


FOUND = "query long, query_id long, vec_id long, score double, verified long"
QUERY = "query long, query_id long, q array<double>, known double, cell int, tile int, block int"


class Index:
    """Rows with their cell, and the boxes of the cells."""

    def __init__(self, rows: DataFrame, dims: int, cell_rows: int):
        total = rows.count()
        sample = rows.select("v", F.xxhash64("vec_id", "v").alias("h")).orderBy("h").limit(SAMPLE).toArrow()
        points = _matrix(sample, "v") if sample.num_rows else np.zeros((0, 1))
        self.ways = ways = directions(points.shape[1], dims)
        self.tree = tree = KdTree(points @ ways, min(-(-total // cell_rows), SAMPLE // 8))
        width = points.shape[1]

        @F.pandas_udf("int")
        def cell(v):
            import pandas as pd

            return pd.Series(tree.cells(np.stack(v.to_numpy()).reshape(-1, width) @ ways) if len(v) else [], dtype="int32")

        self.rows = stored(rows.withColumn("cell", cell("v")), "ann-cells")

        def extent(table: pa.Table) -> pa.Table:
            flat = _matrix(table, "v") @ ways
            return pa.table({"cell": table.column("cell").slice(0, 1), "n": pa.array([len(flat)], pa.int64()), "low": [flat.min(axis=0).tolist()], "high": [flat.max(axis=0).tolist()]})

        # One partial box per cell and piece of at most cell_rows or so, then their union: as many rows as cells.
        pieces = F.pmod(F.xxhash64("row"), F.lit(max(1, -(-total // cell_rows)))).alias("piece")
        parts = self.rows.select("cell", "v", pieces).groupBy("cell", "piece").applyInArrow(extent, "cell int, n long, low array<double>, high array<double>")
        side = lambda f, c: F.array(*[f(F.col(c)[i]) for i in range(dims)]).alias(c)
        boxes = sorted(parts.groupBy("cell").agg(F.sum("n").alias("n"), side(F.min, "low"), side(F.max, "high")).collect())
        self.cell = np.array([r.cell for r in boxes], np.int64)
        self.low, self.high = (np.array([r[c] for r in boxes], float).reshape(-1, dims) for c in ("low", "high"))
        self.tiles = {r.cell: -(-r.n // cell_rows) for r in boxes}

    def visits(self, queries: DataFrame, limit: float, first: bool, block_rows: int) -> DataFrame:
        """(query, query_id, q, known, cell, tile, block) for the nearest cells, or for all others that the test leaves."""
        cell, low, high, tiles, ways = self.cell, self.low, self.high, self.tiles, self.ways

        def run(batches):
            for batch in batches:
                out = []
                for part in range(0, batch.num_rows, 256):
                    piece = batch.slice(part, 256)
                    q = _matrix(pa.Table.from_batches([piece]), "q")
                    for query, query_id, known, v, flat in zip(*(piece.column(c).to_pylist() for c in ("query", "query_id", "known")), q, q @ ways):
                        ahead = box_distances(low, high, flat)
                        order = np.lexsort((cell, ahead))
                        chosen = order[:FIRST_CELLS] if first else order[FIRST_CELLS:][ahead[order[FIRST_CELLS:]] <= limit * known * known]
                        v = v.tolist()
                        out += [(query, query_id, v, known, int(cell[c]), t) for c in chosen for t in range(tiles[int(cell[c])])]
                    names = ["query", "query_id", "q", "known", "cell", "tile"]
                    kinds = [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.float64(), pa.int32(), pa.int32()]
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[i]) for i in range(6)], names=names)
                    out = []

        asked = stored(queries.mapInArrow(run, QUERY.removesuffix(", block int")), "ann-visits")
        per_tile = asked.groupBy("cell", "tile").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
        placed = asked.join(per_tile, ["cell", "tile"]).withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int"))
        return stored(placed.drop("blocks"), "ann-blocks")

    def found(self, visits: DataFrame, k: int, limit: float) -> DataFrame:
        """The k nearest rows of each visit; a row without vec_id tells how many were verified."""
        ways, keys = self.ways, ["cell", "tile", "block"]
        tiles = F.element_at(F.create_map(*[F.lit(x) for c, t in self.tiles.items() for x in (c, t)]), F.col("cell")) if self.tiles else F.lit(1)
        blocks = visits.select("cell", "tile", "block").distinct()
        tile = F.pmod(F.xxhash64("row"), tiles).cast("int").alias("tile")
        held = self.rows.select("vec_id", "v", "cell", tile).join(blocks, ["cell", "tile"])

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            out = {"query": [], "query_id": [], "vec_id": [], "score": [], "verified": []}
            if left.num_rows and right.num_rows:
                vectors, ids, queries = _matrix(left, "v"), left.column("vec_id").to_numpy(), _matrix(right, "q")
                flat = vectors @ ways
                told = zip(*(right.column(c).to_pylist() for c in ("query", "query_id", "known")), queries, queries @ ways)
                for query, query_id, known, q, q_flat in told:
                    at, best, done = verify(vectors, flat, ids, q, query_id, q_flat, k, limit, known)
                    out["query"] += [query] * (len(at) + 1)
                    out["query_id"] += [query_id] * (len(at) + 1)
                    out["vec_id"] += [*ids[at].tolist(), None]
                    out["score"] += [*best.tolist(), None]
                    out["verified"] += [0] * len(at) + [done]
            return pa.table({n: pa.array(c, pa.float64() if n == "score" else pa.int64()) for n, c in out.items()})

        asked = visits.select(*[F.col(c).alias(f"a_{c}") if c in keys else F.col(c) for c in visits.columns])
        return held.groupBy(*keys).cogroup(asked.groupBy(*[f"a_{c}" for c in keys])).applyInArrow(run, FOUND)


def found_rows(vectors: DataFrame, every: int, k: int, dims: int, sure: float, cell_rows: int, block_rows: int) -> DataFrame:
    rows = stored(usable(vectors).withColumn("row", F.monotonically_increasing_id()), "ann-rows")
    index, limit = Index(rows, dims, cell_rows), chi_square_quantile(sure, dims)
    queries = rows.filter(F.col("vec_id") % every == 0).select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    one = stored(index.found(index.visits(queries.withColumn("known", F.lit(float("inf"))), limit, True, block_rows), k, limit), "ann-first")
    order = W.partitionBy("query").orderBy("score", "vec_id")
    kth = one.filter("vec_id is not null").withColumn("n", F.row_number().over(order)).filter(F.col("n") == k).select("query", F.col("score").alias("known"))
    open_ = queries.join(kth, "query", "left").fillna(float("inf"), ["known"])
    return one.unionByName(stored(index.found(index.visits(open_, limit, False, block_rows), k, limit), "ann-others"))


def nearest(
    vectors: DataFrame, every: int, k: int = 10, dims: int = DIMS, sure: float = SURE, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) for the rows whose vec_id is divisible by ``every``."""
    found = found_rows(vectors, every, k, dims, sure, cell_rows, block_rows).filter("vec_id is not null")
    order = W.partitionBy("query").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def search_cost(vectors: DataFrame, every: int, k: int = 10, dims: int = DIMS, sure: float = SURE, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, verified): rows compared on their original vectors, per query."""
    found = found_rows(vectors, every, k, dims, sure, cell_rows, block_rows)
    return found.groupBy("query", "query_id").agg(F.sum("verified").alias("verified")).drop("query")

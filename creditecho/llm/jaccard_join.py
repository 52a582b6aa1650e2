"""Near-duplicate classes by exact Jaccard similarity of word shingles, with R-trees over count vectors.

A document's set is its distinct shingles of ``shingle`` lower-cased words (with fewer words, all of them as one). Two documents link when
``100 * intersection >= percent * union``.

1. Equal sets are one node. Shingles are counted over the corpus (``shared_keys``). Only a document with enough shared shingles can link at all.
2. Two linking sets share one of the first ``n - ceil(n * percent / 100) + 1`` shingles in any common order; in order of frequency these are rare.
   Nodes that share one fall into one block. Blocks are connected components, so no link leaves its block, and no pair is written down.
3. In a block, shingles are hashed into groups and the group counts of a node are a point. A packed R-tree over the points bounds the overlap of
   two boxes, or of two points, by the summed coordinate minima; pairs that the bound lets through are verified on the whole sets, unless they
   are already in one class. A block beyond ``BLOCK_ITEMS`` shingles is dealt into tiles; every pair of tiles is a task of its own.
4. Links (one per joined pair of classes) are merged into components.

Count classes and hashes only order and route; the verification compares 64-bit shingle hashes.

Defined cases: a null, empty or blank text has an empty set and is a class of its own; repeated rows and texts with equal sets are one class; a null
doc_id is ignored for the class id unless the class has no other (then it is null); an empty table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditecho.llm.chunks import Chunk, pack, unpack
from creditecho.llm.components import components
from creditecho.llm.shared_keys import QUESTIONS, answers, bucket_count, levels, question_rows
from creditecho.llm.store import give_back, stored
from creditecho.llm.textbatch import Texts, grams, mixed

SHINGLE = 5
PERCENT = 75
KEY_BYTES = 5
BLOCK_ITEMS = 4_000_000
LEAF = 16
_U = np.uint64


class Sets:
    """Distinct shingles of each document of a chunk: ``h`` grouped by ``doc``, sorted inside a document; ``n`` per document."""

    def __init__(self, parts: list[bytes], shingle: int):
        t = Texts(parts, lower=True)
        words = t.word_hashes()
        h, ok = grams(words, t.doc, shingle)
        h, doc = h[ok], t.doc[: len(h)][ok]
        short = np.flatnonzero((t.n_words > 0) & (t.n_words < shingle))
        if len(short):
            whole = []
            for d in short.tolist():
                value = _U(t.n_words[d])
                for w in words[t.first_word[d]: t.first_word[d] + t.n_words[d]]:
                    value = mixed(np.array([value ^ w], np.uint64))[0]
                whole.append(value)
            h, doc = np.concatenate([h, np.array(whole, np.uint64)]), np.concatenate([doc, short])
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        self.h, self.doc = h[new], doc[new]
        self.n = np.bincount(self.doc, minlength=len(parts))
        self.begin = np.cumsum(self.n) - self.n

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct keys, documents that hold each, place of every shingle's key); a key is the shingle's upper bytes."""
        cut = (self.h >> _U(64 - 8 * KEY_BYTES)) << _U(64 - 8 * KEY_BYTES)
        keys, back, counts = np.unique(cut, return_inverse=True, return_counts=True)
        return keys, counts, back

    def node(self) -> list[bytes]:
        """16 bytes that stand for each set."""
        out = []
        for salt in (1, 2):
            total = np.zeros(len(self.h) + 1, np.uint64)
            np.cumsum(mixed(self.h ^ _U(salt * 0x51ED270B9F3C2A75)), dtype=np.uint64, out=total[1:])
            out.append(mixed(total[self.begin + self.n] - total[self.begin] + self.n.astype(np.uint64)))
        both = np.column_stack(out).astype(">u8")
        return [row.tobytes() for row in both]


def least_prefix(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (n * percent + 99) // 100 + 1


def documents_and_candidates(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Stored rows (doc_id, n, node, items, prefix); items and prefix only for documents that can link."""
    chunks = pack(docs, "jaccard-chunks")
    buckets = bucket_count(chunks)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = unpack(batch, row)
                keys, counts, _ = Sets(chunk.parts, shingle).keys()
                yield question_rows(chunk.chunk_id, keys, counts, buckets, KEY_BYTES)
        batch = chunk = keys = counts = None
        give_back()

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = unpack(batch, row)
                yield _chunk_rows(chunk, Sets(chunk.parts, shingle), levels(batch.column("replies")[row].as_py()), percent)
        batch = chunk = None
        give_back()

    replies = answers(chunks.mapInArrow(ask, QUESTIONS), KEY_BYTES)
    joined = chunks.join(replies, "chunk_id", "left")
    return stored(joined.mapInArrow(tell, "doc_id long, n long, node binary, items binary, prefix binary"), "jaccard-sets")


def _chunk_rows(chunk: Chunk, sets: Sets, level: np.ndarray, percent: int) -> pa.RecordBatch:
    _, _, back = sets.keys()
    of = level[back] if len(back) else np.zeros(0, np.uint8)
    total = np.concatenate([[0], np.cumsum(of > 0)])
    shared = total[sets.begin + sets.n] - total[sets.begin]
    can = (sets.n > 0) & (100 * shared >= percent * sets.n)
    items, prefix = [None] * len(sets.n), [None] * len(sets.n)
    for d, size in zip(np.flatnonzero(can).tolist(), least_prefix(sets.n, percent)[can].tolist()):
        a, b = sets.begin[d], sets.begin[d] + sets.n[d]
        own, rare = sets.h[a:b], of[a:b]
        items[d] = own.tobytes()
        first = np.argsort(rare, kind="stable")[:size]
        prefix[d] = own[first[rare[first] > 0]].tobytes()
    return pa.RecordBatch.from_arrays([
        chunk.id_array(), pa.array(sets.n, pa.int64()), pa.array(sets.node(), pa.binary()), pa.array(items, pa.binary()),
        pa.array(prefix, pa.binary()),
    ], names=["doc_id", "n", "node", "items", "prefix"])


class Classes:
    """Union-find over numbers."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.parent))], np.int64)


def block_links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) that connect all nodes with a common prefix shingle.

    Rows are ordered by shingle and node over all tasks, so a frequent shingle is spread over several; each task joins its neighbours and sends one
    link per joined node, and the shingles at its ends are joined over tasks.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes_, prefixes = batch.column("node").to_pylist(), [np.frombuffer(p, np.int64) for p in batch.column("prefix").to_pylist()]
            for at in range(0, len(nodes_), 500):
                own = prefixes[at: at + 500]
                take = np.repeat(np.arange(at, at + len(own)), [len(p) for p in own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(own)), batch.column("node").take(pa.array(take))], names=["h", "node"]
                )

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        pairs: set[tuple[int, int]] = set()
        first = last = None
        for batch in batches:
            for h, node in zip(batch.column("h").to_pylist(), batch.column("node").to_pylist()):
                if last is not None and last[0] == h and last[1] != node:
                    pairs.add((number.setdefault(last[1], len(number)), number.setdefault(node, len(number))))
                first = first or (h, node)
                last = (h, node)
        names, classes = list(number), Classes(len(number))
        for i, j in pairs:
            classes.join(i, j)
        roots = classes.roots()
        rows = [(names[i], names[r], None) for i, r in enumerate(roots.tolist()) if i != r]
        rows += [(node, None, h) for h, node in {x for x in (first, last) if x}]
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64()),
        ], names=["a", "b", "h"])

    rows = stored(nodes.filter("length(prefix) > 0").select("node", "prefix").mapInArrow(spread, "h long, node binary"), "jaccard-prefixes")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "h", "node").sortWithinPartitions("h", "node")
    links = stored(ordered.mapInArrow(chain, "a binary, b binary, h long"), "jaccard-chains")
    ends = links.filter("h is not null")
    least = ends.groupBy("h").agg(F.min("a").alias("b")).withColumnRenamed("h", "k")
    over = ends.join(least, F.col("h") == F.col("k")).select("a", least["b"])
    return links.filter("b is not null").select("a", "b").unionByName(over)


class CountTree:
    """A packed R-tree of two levels over count vectors: boxes keep coordinate maxima and the least set size.

    The number of groups follows the mean set size, so that the points never hold more counts than the sets hold shingles, or 16 a set.
    """

    def __init__(self, sets: list[np.ndarray], leaf: int = LEAF):
        n = np.array([len(s) for s in sets], np.int64)
        groups = 1 << int(np.clip(np.floor(np.log2(max(1, n.mean()))), 4, 12))
        points = np.zeros((len(sets), groups), np.int32)
        for i, s in enumerate(sets):
            points[i] = np.bincount((s & _U(groups - 1)).astype(np.int64), minlength=groups)
        self.order = np.lexsort((points[:, 0], n))  # neighbours have alike sizes
        self.points, self.n = points[self.order], n[self.order]
        self.leaves = self._boxes(self.points, self.n, leaf)
        self.nodes = self._boxes(*self.leaves[:2], leaf)
        self.leaf = leaf

    @staticmethod
    def _boxes(points: np.ndarray, n: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(0, len(points), leaf)
        return np.maximum.reduceat(points, at, axis=0), np.minimum.reduceat(n, at)

    @staticmethod
    def reach(point: np.ndarray, n: np.ndarray, others: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
        """Which others an overlap bound lets through: the intersection must reach percent/(100+percent) of both sizes."""
        bound = np.minimum(others, point).sum(axis=1)
        return (100 + percent) * bound >= percent * (n + sizes)

    def candidates(self, i: int, percent: int, root: np.ndarray) -> np.ndarray:
        """Places (in tree order) behind ``i`` in another class that the bounds let through; sizes rise along the order."""
        point, n = self.points[i], self.n[i]
        nodes = np.flatnonzero(self.reach(point, n, *self.nodes, percent))
        leaf = (nodes[:, None] * self.leaf + np.arange(self.leaf)).ravel()
        leaf = leaf[(leaf < len(self.leaves[1])) & (leaf >= i // self.leaf)]
        leaf = leaf[self.leaves[1][leaf] * percent <= 100 * n]
        leaf = leaf[self.reach(point, n, self.leaves[0][leaf], self.leaves[1][leaf], percent)]
        at = (leaf[:, None] * self.leaf + np.arange(self.leaf)).ravel()
        at = at[(at < len(self.n)) & (at > i)]
        at = at[root[at] != root[i]]
        return at[self.reach(point, n, self.points[at], self.n[at], percent)]


def classes_of(sets: list[np.ndarray], percent: int) -> Classes:
    """Classes of linked sets (sorted distinct hashes)."""
    out, tree, root = Classes(len(sets)), CountTree(sets), np.arange(len(sets))
    for i, name in enumerate(tree.order.tolist()):
        a, near = sets[name], tree.candidates(i, percent, root)
        while len(near):
            place, near = int(near[0]), near[1:]
            other = int(tree.order[place])
            b = sets[other]
            common = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
            if 100 * common >= percent * (len(a) + len(b) - common):
                low, high = sorted((int(root[i]), int(root[place])))
                root[root == high] = low
                out.join(name, other)
                near = near[root[near] != root[i]]
    return out


def tile_links(tiles: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) found inside each tile pair of each block; one link per node that joined a class."""

    def run(table: pa.Table) -> pa.Table:
        names = table.column("node").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("items").to_pylist()]
        roots = classes_of(sets, percent).roots().tolist()
        rows = [(names[i], names[r]) for i, r in enumerate(roots) if i != r]
        return pa.table({"a": pa.array([r[0] for r in rows], pa.binary()), "b": pa.array([r[1] for r in rows], pa.binary())})

    return tiles.groupBy("block", "i", "j").applyInArrow(run, "a binary, b binary")


def jaccard_classes(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """doc_id, n_shingles and component_id (least doc_id of the class) for every document."""
    rows = documents_and_candidates(docs, shingle, percent)
    nodes = rows.filter("items is not null").groupBy("node").agg(
        F.first("n").alias("n"), F.first("items").alias("items"), F.first("prefix").alias("prefix")
    )
    nodes = stored(nodes, "jaccard-nodes")
    blocks = components(block_links(nodes))
    heads = blocks.select("b").distinct().select(F.col("b").alias("k"), F.col("b").alias("block"))
    member = blocks.select(F.col("a").alias("k"), F.col("b").alias("block")).unionByName(heads)
    placed = stored(nodes.join(member, F.col("node") == F.col("k")).select("block", "node", "n", "items"), "jaccard-blocks")
    size = placed.groupBy("block").agg(F.ceil(F.sum("n") / block_items).cast("int").alias("parts")).withColumnRenamed("block", "k")
    tiled = placed.join(size, F.col("block") == F.col("k")).withColumn("t", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    tiled = tiled.withColumn("o", other).select("block", F.least("t", "o").alias("i"), F.greatest("t", "o").alias("j"), "node", "items")
    classes = components(tile_links(tiled, percent))

    of_node = rows.groupBy("node").agg(F.min("doc_id").alias("first_id"))
    named = of_node.join(classes, F.col("node") == F.col("a"), "left").select("node", F.coalesce("b", "node").alias("class"), "first_id")
    linked = named.join(classes.select(F.col("b").alias("c")).distinct(), F.col("class") == F.col("c"), "left")
    several = linked.filter("c is not null")
    least = several.groupBy("class").agg(F.min("first_id").alias("component_id")).withColumnRenamed("class", "c2")
    of_several = several.join(least, F.col("class") == F.col("c2")).select("node", "component_id")
    of_one = linked.filter("c is null").select("node", F.col("first_id").alias("component_id"))
    ids = of_several.unionByName(of_one).withColumnRenamed("node", "k")
    out = rows.filter("n > 0").join(ids, F.col("node") == F.col("k")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(empty)


def one_per_class(docs: DataFrame, **options) -> DataFrame:
    """The document with the least doc_id of every class, with all columns; of rows that repeat a doc_id one stays. Documents without a doc_id
    cannot be told apart by it: one of each text stays."""
    kept = jaccard_classes(docs.select("doc_id", "text"), **options)
    kept = kept.filter("doc_id = component_id").select("doc_id").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("key"), F.xxhash64("text").alias("text_hash"))
    named = rows.filter("key is not null").join(kept, F.col("key") == kept["doc_id"]).drop(kept["doc_id"])
    every = named.unionByName(rows.filter("key is null"))
    place = W.partitionBy("key", F.when(F.col("key").isNull(), F.col("text_hash"))).orderBy("text_hash")
    return every.withColumn("nth", F.row_number().over(place)).filter("nth = 1").select("row.*")

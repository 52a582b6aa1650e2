"""The stored search index: word blocks with score bounds, trigram postings, review rows and vectors, read by partition.

``build`` tokenizes the corpus once and writes

* ``postings`` – one row per word and document range: the range's documents with their counts and lengths, and ``bound``, the highest
  score factor among them. Partitioned by ``bucket``, a hash of the word;
* ``terms`` – document frequency and idf, in the same partitions;
* ``grams`` – trigrams of the searched text columns, ignoring case, with the documents of a range that hold them, partitioned like words;
* ``reviews`` – the review rows, partitioned by a hash of their key; ``vectors``, ``corpus`` and ``config``.

A document range holds documents of like length, so that its bounds are close to its scores. A search reads only the buckets of its words, given as
a list in the plan, and no text. Top-k is exact without scoring every document that shares a word: the bounds of a query's words are added up
per range; the most promising ranges are scored; their k-th score is the threshold; of the other ranges only those whose bound reaches it are read.

Substring search takes the rarest trigrams of a text, intersects their documents and compares only these. Texts are wrapped in marks, so that one or two
characters also lie in some trigram.

Documents travel once, as a row, to the task of their range; a range's word blocks and trigram lists are made there in NumPy, so no row per word or trigram of
a document is ever shuffled. A search sends the blocks of its words to the task of their range too, and adds up scores there.
"""
from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creditecho.config import BM25_B, BM25_EPSILON, BM25_K1
from creditecho.functions.text import tokens
from creditecho.operators.joins import is_small
from creditecho.operators.totals import top_ranked
from creditecho.session import stored

RANGE_DOCS = 1024
RANGE_WORDS = 1 << 20
LENGTH_CLASSES = 64
BUCKET_ROWS = 4_000_000
MAX_BUCKETS = 4096
BUCKET_FILES = 16
SCALE = 1e10
ASKED_AT_ONCE = 5_000
PAIRS_AT_ONCE = 2_000_000
RARE_GRAMS = 4
FIRST_DOCS = 4  # ranges of the first round hold about this many times k documents
OPEN, CLOSE = "\x02", "\x03"


def buckets_for(rows: int) -> int:
    return max(8, min(MAX_BUCKETS, rows // BUCKET_ROWS))


def bucket(word: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(n)).cast("int")


def factor(tf: Column, dl: Column, avgdl: Column, k1: float = BM25_K1, b: float = BM25_B) -> Column:
    """Score of a word in a document without its weight."""
    norm = F.lit(k1) * (F.lit(1 - b) + F.lit(b) * dl / avgdl)
    return tf.cast("double") * F.lit(k1 + 1) / (tf.cast("double") + norm)


def steps(x: Column) -> Column:
    """Fixed-point steps, so that sums do not depend on the order of rows; halves go away from zero, without a decimal per row."""
    return (F.signum(x) * F.floor(F.abs(x) * F.lit(SCALE) + 0.5)).cast("long")


def with_ranges(docs: DataFrame, range_docs: int = RANGE_DOCS) -> DataFrame:
    """Adds ``rng``: documents of one length class are dealt by a hash of their key into ranges of about ``range_docs``, fewer if they are long."""
    cuts = docs.agg(F.percentile_approx("dl", [i / LENGTH_CLASSES for i in range(1, LENGTH_CLASSES)], 1000)).first()[0] or []
    limits = F.array(*[F.lit(c) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<int>")
    class_ = F.size(F.filter(limits, lambda c: c < F.col("dl")))
    sizes = docs.groupBy(class_.alias("c")).agg(F.count("*"), F.sum(F.col("dl").cast("long"))).collect()  # at most LENGTH_CLASSES rows
    counts = {c: (rows, words) for c, rows, words in sizes}
    first, n, at = [], [], 0
    for c in range(LENGTH_CLASSES):
        rows, words = counts.get(c, (0, 0))
        n.append(max(-(-rows // range_docs), -(-words // RANGE_WORDS), 1))
        first.append(at)
        at += n[-1] if c in counts else 0
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), class_ + 1)
    return docs.withColumn("rng", (pick(first) + F.pmod(F.xxhash64("doc_id"), pick(n))).cast("long"))


def word_blocks(placed: DataFrame, avgdl: float) -> DataFrame:
    """(term, rng, n, bound, docs) of documents (doc_id, rng, dl, words): the blocks of a range are made in the task that holds its documents."""
    key = placed.schema["doc_id"].dataType.simpleString()

    def task(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        order = pc.sort_indices(t.select(["doc_id", "dl"]), sort_keys=[("doc_id", "ascending"), ("dl", "ascending")])
        lists, ids, dl = t["words"].combine_chunks(), t["doc_id"].combine_chunks().take(order), t["dl"].combine_chunks().take(order).to_numpy()
        code = pc.dictionary_encode(ids, null_encoding="encode").indices.to_numpy()
        new = np.r_[True, (code[1:] != code[:-1]) | (dl[1:] != dl[:-1])]  # a key that repeats with its length is one document
        place = np.empty(len(new), np.int64)
        place[order.to_numpy()] = np.cumsum(new) - 1  # rows are numbered in order of their key; their words stay where they are
        doc = np.repeat(place, pc.list_value_length(lists).to_numpy())
        words = pc.dictionary_encode(lists.flatten())
        kept = np.flatnonzero(new)
        pair, tf = np.unique(words.indices.to_numpy().astype(np.int64) * len(kept) + doc, return_counts=True)
        word, doc = np.divmod(pair, max(1, len(kept)))
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]][:len(word)])
        rows = pa.array(kept[doc])
        held = pa.StructArray.from_arrays(
            [ids.take(rows), pa.array(tf, pa.int64()), pa.array(dl).take(rows)], ["doc_id", "tf", "dl"]
        )
        length = dl[kept[doc]].astype(np.float64)
        score = tf * (BM25_K1 + 1) / (tf + BM25_K1 * ((1 - BM25_B) + BM25_B * length / avgdl))
        return pa.table({
            "term": words.dictionary.take(pa.array(word[starts])), "rng": pa.array(np.full(len(starts), t["rng"][0].as_py()), pa.int64()),
            "n": pa.array(np.diff(np.r_[starts, len(word)]), pa.int64()),
            "bound": pa.array(np.maximum.reduceat(score, starts) if len(starts) else score),
            "docs": pa.ListArray.from_arrays(pa.array(np.r_[starts, len(word)], pa.int32()), held),
        })

    schema = f"term string, rng long, n long, bound double, docs array<struct<doc_id: {key}, tf: long, dl: int>>"
    return placed.filter("dl > 0").select("doc_id", "rng", "dl", "words").groupBy("rng").applyInArrow(task, schema)


def gram_lists(texts: DataFrame) -> DataFrame:
    """(gram, rng, n, docs): distinct trigrams of rows (doc_id, rng, texts) with the documents of a range that hold them, ascending."""
    key = texts.schema["doc_id"].dataType.simpleString()

    def task(t: pa.Table) -> pa.Table:
        t = t.combine_chunks().sort_by([("doc_id", "ascending")])
        grams, docs = [], []
        for at, texts in enumerate(t["texts"].to_pylist()):
            held = []
            for text in texts:
                c = np.frombuffer(f"{OPEN}{text}{CLOSE}{CLOSE}".encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
                held.append(c[:-2] << 42 | c[1:-1] << 21 | c[2:])
            grams.append(np.unique(np.concatenate(held)))
            docs.append(np.full(len(grams[-1]), at))
        gram, doc = np.concatenate(grams), np.concatenate(docs)
        order = np.argsort(gram, kind="stable")
        gram, doc = gram[order], doc[order]
        starts = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        one = gram[starts]
        letters = np.stack([one >> 42, one >> 21 & 0x1FFFFF, one & 0x1FFFFF], axis=1).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        return pa.table({
            "gram": pa.array([letters[i:i + 3] for i in range(0, 3 * len(one), 3)], pa.string()),
            "rng": pa.array(np.full(len(one), t["rng"][0].as_py()), pa.int64()), "n": pa.array(np.diff(np.r_[starts, len(gram)]), pa.int64()),
            "docs": pa.ListArray.from_arrays(pa.array(np.r_[starts, len(gram)], pa.int32()), t["doc_id"].combine_chunks().take(pa.array(doc))),
        })

    return texts.filter(F.size("texts") > 0).select("doc_id", "rng", "texts").groupBy("rng").applyInArrow(task, f"gram string, rng long, n long, docs array<{key}>")


def trigrams(text: Column) -> Column:
    """Distinct trigrams of a text between marks, lower case; none for NULL. Characters are split once, so long texts take linear time."""
    c = F.split(F.concat(F.lit(OPEN), F.lower(text), F.lit(CLOSE + CLOSE)), "")
    behind = lambda i: F.slice(c, i, F.size(c))
    three = F.arrays_zip(c.alias("x"), behind(2).alias("y"), behind(3).alias("z"))
    return F.array_distinct(F.filter(F.transform(three, lambda t: F.concat(t["x"], t["y"], t["z"])), lambda g: g.isNotNull()))


def with_idf(counts: DataFrame, n_docs: int) -> DataFrame:
    """(..., df, idf); a negative idf becomes a quarter of the mean idf."""
    raw = F.ln(F.lit(float(n_docs)) - F.col("df") + 0.5) - F.ln(F.col("df") + 0.5)
    told = counts.withColumn("_raw", raw)
    floor = F.lit(BM25_EPSILON) * told.agg(F.avg("_raw")).scalar()
    return told.withColumn("idf", F.when(F.col("_raw") < 0, floor).otherwise(F.col("_raw"))).drop("_raw")


def write_partitioned(df: DataFrame, by: str, path: str) -> DataFrame:
    """Written by partition and read again. A bucket is dealt over a few files, so that one very frequent word is not one task.
    Files are few and of a megabyte or so: every open, commit and listing costs time in proportion to their number. Rows are ordered by
    partition alone, an integer; no search relies on an order inside a bucket, and comparing words took most of the time of a write."""
    dealt = df.repartition(by, F.pmod(F.xxhash64("rng"), F.lit(BUCKET_FILES))) if "rng" in df.columns else df.repartition(by)
    dealt.sortWithinPartitions(by).write.mode("overwrite").option("compression", "zstd").partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build(
    reviews: DataFrame, folder: str, key: str = "id", text: str = "feedback", searched: tuple[str, ...] = ("feedback", "title"),
    vectors: DataFrame | None = None, lemmas: DataFrame | None = None, config: dict | None = None, range_docs: int = RANGE_DOCS,
) -> StoredIndex:
    """Writes the index of ``reviews`` and opens it. ``lemmas`` (token, lemma) replaces words on this side and, kept beside it, in queries."""
    spark = reviews.sparkSession
    rows = reviews.withColumnRenamed(key, "doc_id")
    words = rows.select("doc_id", tokens(F.col(text)).alias("words"))
    if lemmas is not None:
        from creditecho.operators.bm25 import lemmatized

        lemmas.select("token", "lemma").write.mode("overwrite").parquet(f"{folder}/lemmas")
        words = lemmatized(words, spark.read.parquet(f"{folder}/lemmas"))
    words = stored(words.withColumn("dl", F.size("words")), "index-words", compression="zstd")
    placed = with_ranges(words, range_docs)
    n_docs, n_words, avgdl = words.agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0)), F.avg("dl")).first()
    repeats = words.select("doc_id", "dl").distinct().groupBy("doc_id").count().filter("count > 1").limit(1).count() > 0
    corpus = words.agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"))
    corpus.write.mode("overwrite").parquet(f"{folder}/corpus")

    buckets = buckets_for(n_words)
    blocks = word_blocks(placed, avgdl)
    tables = {"postings": write_partitioned(blocks.withColumn("bucket", bucket(F.col("term"), buckets)), "bucket", f"{folder}/postings")}
    frequency = stored(tables["postings"].groupBy("term").agg(F.sum("n").alias("df")), "index-frequency")
    terms = with_idf(frequency, n_docs).withColumn("bucket", bucket(F.col("term"), buckets))
    tables["terms"] = write_partitioned(terms, "bucket", f"{folder}/terms")

    tables["reviews"] = write_partitioned(rows.withColumn("part", part(n_docs)), "part", f"{folder}/reviews")
    texts = F.array_compact(F.array(*[F.lower(F.col(c)) for c in searched])).alias("texts")
    ranges = max(1, n_docs // range_docs, n_words // RANGE_WORDS)  # fewer documents if they are long
    told = rows.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(ranges)).alias("rng"), texts)
    lists = gram_lists(told)
    tables["grams"] = write_partitioned(lists.withColumn("bucket", bucket(F.col("gram"), buckets)), "bucket", f"{folder}/grams")
    if vectors is not None:
        vectors.write.mode("overwrite").parquet(f"{folder}/vectors")
    values = {"tokenizer": "word", "metric": "cosine", "buckets": str(buckets), "searched": ",".join(searched), "lemmas": str(lemmas is not None), "repeats": str(repeats), **(config or {})}
    values["schemas"] = json.dumps({name: t.schema.jsonValue() for name, t in tables.items()})
    described = spark.read.parquet(f"{folder}/corpus").select("*", *[F.lit(v).alias(k) for k, v in values.items()])
    described.coalesce(1).write.mode("overwrite").json(f"{folder}/config")
    return StoredIndex(spark, folder)


def part(n_docs: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(max(8, min(MAX_BUCKETS, n_docs // 50_000)))).cast("int")


class StoredIndex:
    """An index opened from its folder. ``terms``, ``corpus`` and ``postings()`` are whole tables; searches read parts of them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        config = spark.read.json(f"{folder}/config").first()
        self.buckets, self.searched, self.has_lemmas = int(config["buckets"]), config["searched"].split(","), config["lemmas"] == "True"
        self.repeats = config["repeats"] == "True"  # a key has texts of several lengths, which lie in several ranges
        self.corpus = spark.read.parquet(f"{folder}/corpus")
        self.n_docs, self.avgdl = self.corpus.select("n_docs", "avgdl").first()
        schemas = {name: StructType.fromJson(x) for name, x in json.loads(config["schemas"]).items()}
        table = lambda name: spark.read.schema(schemas[name]).parquet(f"{folder}/{name}")
        self.blocks, self.words, self.grams, self.reviews = table("postings"), table("terms"), table("grams"), table("reviews")
        self.terms = self.words.drop("bucket")

    def vectors(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/vectors")

    def postings(self) -> DataFrame:
        """(term, doc_id, tf, dl), one row per word of a document."""
        return self.blocks.select("term", F.explode("docs").alias("d")).select("term", "d.doc_id", "d.tf", "d.dl")

    def rows(self, doc_ids: DataFrame, columns: list[str]) -> DataFrame:
        """Rows of the documents named by the distinct column ``doc_id``, reading only their partitions."""
        wanted = [r[0] for r in doc_ids.select(part(self.n_docs)).distinct().collect()]  # at most MAX_BUCKETS
        found = self.reviews.filter(F.col("part").isin(wanted))
        return _small_join(found.select("doc_id", *columns), doc_ids.select("doc_id"), ["doc_id"])

    # ------------------------------------------------------------ word search
    def query_terms(self, queries: DataFrame) -> DataFrame:
        """(query_id, term, qtf); a repeated word counts each time. Lemmas of the index are used here too."""
        words = queries.select("query_id", F.explode(tokens(F.col("query"))).alias("term"))
        if self.has_lemmas:
            lemmas = self.spark.read.parquet(f"{self.folder}/lemmas")
            words = words.join(lemmas, F.col("term") == F.col("token"), "left").select("query_id", F.coalesce("lemma", "term").alias("term"))
        return words.groupBy("query_id", "term").agg(F.count("*").alias("qtf"))

    def weighted(self, queries: DataFrame) -> tuple[DataFrame, list[int]]:
        """(query_id, term, w) of words that the index knows, and the buckets they lie in; there are at most MAX_BUCKETS."""
        asked = stored(self.query_terms(queries).withColumn("bucket", bucket(F.col("term"), self.buckets)), "index-query")
        buckets = [r[0] for r in asked.select("bucket").distinct().collect()]
        known = self.words.filter(F.col("bucket").isin(buckets)).select("term", "idf")
        return stored(_small_join(known, asked, ["term"]).select("query_id", "term", (F.col("qtf") * F.col("idf")).alias("w")), "index-weights"), buckets

    def scores(self, queries: DataFrame) -> DataFrame:
        """(query_id, doc_id, bm25) of every document that shares a word with a query."""
        found = self._scored(*self.weighted(queries))
        if self.repeats:
            found = found.groupBy("query_id", "doc_id").agg(F.sum("steps").alias("steps"))
        return found.select("query_id", "doc_id", (F.col("steps") / F.lit(SCALE)).alias("bm25"))

    def _scored(self, weights: DataFrame, buckets: list[int], ranges: DataFrame | None = None, k: int = 0) -> DataFrame:
        """(query_id, doc_id, steps). With ``ranges`` (query_id, rng, least) only these are scored, and of a range and query only the first
        ``k`` positive scores of at least ``least`` come out; equal ones all come out.

        Every block gets the list of queries that ask for its word and travels once to the task of its range, where scores are added up.
        """
        parts = 1 + weights.select("query_id").distinct().count() // ASKED_AT_ONCE
        part = F.pmod(F.xxhash64("query_id"), F.lit(parts)).alias("part")
        asks = weights.groupBy("term", part).agg(F.collect_list(F.struct("query_id", "w")).alias("asks"))
        blocks = self.blocks.filter(F.col("bucket").isin(buckets)).select("term", "rng", "docs")
        schema = f"query_id {_kind(weights, 'query_id')}, doc_id {blocks.schema['docs'].dataType.elementType['doc_id'].dataType.simpleString()}, steps long"
        if ranges is None:
            matched = _small_join(blocks, asks, ["term"]).select("rng", "part", "asks", "docs")
            return matched.groupBy("rng", "part").applyInArrow(range_scores(self.avgdl), schema)
        named = ranges.select("rng").distinct()
        blocks = blocks.join(F.broadcast(named) if is_small(named) else named, "rng", "left_semi")
        matched = _small_join(blocks, asks, ["term"]).select("rng", "part", "asks", "docs")
        picked = ranges.select("rng", part, "query_id", "least").groupBy("rng", "part")
        return matched.groupBy("rng", "part").cogroup(picked).applyInArrow(range_scores(self.avgdl, k), schema)

    def range_bounds(self, weights: DataFrame, buckets: list[int]) -> DataFrame:
        """(query_id, rng, n_blocks, bound): no document of the range scores more. Reads no lists of documents."""
        heads = self.blocks.filter(F.col("bucket").isin(buckets)).select("term", "rng", "bound")
        joined = _small_join(heads, weights, ["term"])
        most = steps(F.greatest(F.col("w"), F.lit(0.0)) * F.col("bound")) + 1  # a step for rounding
        return joined.groupBy("query_id", "rng").agg(F.count("*").alias("n_blocks"), F.sum(most).alias("bound"))

    def _rounds(self, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        """Scores of both rounds, all range bounds, and the ranges read."""
        weights, buckets = self.weighted(queries)
        bounds = stored(self.range_bounds(weights, buckets), "index-bounds")
        first_ranges = max(2, -(-FIRST_DOCS * k // RANGE_DOCS))
        first = stored(top_ranked(bounds, ["query_id"], "bound", "rng", first_ranges).select("query_id", "rng"), "index-first")
        value = (F.col("steps") / F.lit(SCALE)).alias("bm25")
        one = stored(self._scored(weights, buckets, first.withColumn("least", F.lit(1).cast("long")), k), "index-round")
        best = top_ranked(one, ["query_id"], "steps", "doc_id", k)
        limits = best.groupBy("query_id").agg(F.count("*").alias("c"), F.min("steps").alias("least"))
        rest = bounds.join(first, ["query_id", "rng"], "left_anti").join(limits, "query_id", "left")
        least = F.when(F.col("c") >= k, F.col("least")).otherwise(F.lit(0))
        more = stored(rest.filter(F.col("bound") >= least).select("query_id", "rng", F.greatest(least, F.lit(1)).cast("long").alias("least")), "index-more")
        two = self._scored(weights, buckets, more, k)
        scores = [x.select("query_id", "doc_id", value) for x in (one, two)]
        return *scores, bounds, first.unionByName(more.drop("least"))

    def top_documents(self, queries: DataFrame, k: int = 0) -> DataFrame:
        """Ranked list per query over positive scores; ``k <= 0`` keeps all."""
        if k <= 0 or self.repeats:
            return top_ranked(stored(self.scores(queries).filter("bm25 > 0"), "index-scores"), ["query_id"], "bm25", "doc_id", k)
        one, two, _, _ = self._rounds(queries, k)
        return top_ranked(one.unionByName(two), ["query_id"], "bm25", "doc_id", k)

    def blocks_read(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, blocks, read): word blocks that hold a word of the query, and those whose documents a top-k search scores."""
        _, _, bounds, ranges = self._rounds(queries, k)
        marked = bounds.join(ranges.withColumn("r", F.lit(1)), ["query_id", "rng"], "left")
        return marked.groupBy("query_id").agg(F.sum("n_blocks").alias("blocks"), F.sum(F.when(F.col("r") == 1, F.col("n_blocks")).otherwise(0)).alias("read"))

    # ------------------------------------------------------- substring search
    def with_fallback(self, hits: DataFrame, queries: DataFrame) -> DataFrame:
        """Adds substring matches, in key order, for queries without any hit."""
        empty = queries.join(hits.select("query_id").distinct(), "query_id", "left_anti")
        plain = self.substring_matches(empty).withColumn("bm25", F.lit(0.0))
        return hits.unionByName(top_ranked(plain, ["query_id"], "bm25", "doc_id", 0).select(hits.columns))

    def substring_matches(self, queries: DataFrame) -> DataFrame:
        """(query_id, doc_id) where a searched column contains the query text, ignoring case."""
        asked = stored(queries.filter("query IS NOT NULL").select("query_id", F.lower("query").alias("q")), "index-texts")
        candidates = self._by_grams(asked.filter(F.length("q") >= 3)).unionByName(self._by_short(asked.filter(F.length("q") < 3)))
        candidates = stored(candidates, "index-candidates")
        texts = self.rows(candidates.select("doc_id").distinct(), self.searched)
        pairs = candidates.join(asked, "query_id")
        compared = texts.join(pairs, "doc_id")
        hit = F.lit(False)
        for c in self.searched:
            hit = hit | F.coalesce(F.contains(F.lower(c), F.col("q")), F.lit(False))
        return compared.filter(hit).select("query_id", "doc_id")

    def _by_grams(self, asked: DataFrame) -> DataFrame:
        """Documents that hold the rarest trigrams of a text, all of them."""
        inside = F.filter(trigrams(F.col("q")), lambda g: ~g.contains(OPEN) & ~g.contains(CLOSE))
        grams = stored(
            asked.select("query_id", F.explode(inside).alias("gram")).withColumn("bucket", bucket(F.col("gram"), self.buckets)), "index-grams"
        )
        buckets = [r[0] for r in grams.select("bucket").distinct().collect()]
        table = self.grams.filter(F.col("bucket").isin(buckets))
        counts = table.groupBy("gram").agg(F.sum("n").alias("df"))
        sized = grams.join(counts, "gram", "left").fillna(0, ["df"]).withColumn("less", -F.col("df"))
        rare = stored(top_ranked(sized, ["query_id"], "less", "gram", RARE_GRAMS).select("query_id", "gram"), "index-rare")
        wanted = rare.groupBy("query_id").agg(F.count("*").alias("c"))
        held = _small_join(table.select("gram", "docs"), rare, ["gram"]).select("query_id", F.explode("docs").alias("doc_id"))
        return held.groupBy("query_id", "doc_id").agg(F.count("*").alias("h")).join(wanted, "query_id").filter("h = c").select("query_id", "doc_id")

    def _by_short(self, asked: DataFrame) -> DataFrame:
        """One or two characters lie in some trigram of a marked text; no character lies in every text that is not NULL."""
        named = asked.withColumn("n", F.length("q")).distinct()
        inside = self.grams.select("gram").distinct()
        pieces = inside.select("gram", F.explode(F.array_distinct(F.flatten(F.array(
            F.array(F.lit("")), F.transform(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda i: F.substring("gram", i, F.lit(1))),
            F.transform(F.array(F.lit(1), F.lit(2)), lambda i: F.substring("gram", i, F.lit(2))),
        )))).alias("q"))
        grams = _small_join(pieces, named.select("query_id", "q"), ["q"]).select("query_id", "gram")
        return _small_join(self.grams.select("gram", "docs"), grams, ["gram"]).select("query_id", F.explode("docs").alias("doc_id")).distinct()


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def range_scores(avgdl: float, k: int = 0):
    """The task that adds up the scores of one range: blocks (asks, docs), and for a cogroup the queries (query_id, least) it is for."""

    def scored(blocks: pa.Table, picked: pa.Table | None):
        asks, docs = blocks["asks"].combine_chunks(), blocks["docs"].combine_chunks()
        held, n = docs.flatten(), pc.list_value_length(docs).to_numpy()
        at = np.cumsum(n) - n
        tf, dl = held.field("tf").to_numpy(), held.field("dl").to_numpy().astype(np.float64)
        part = tf.astype(np.float64) * (BM25_K1 + 1) / (tf + BM25_K1 * ((1 - BM25_B) + BM25_B * dl / avgdl))
        known = pc.dictionary_encode(held.field("doc_id"), null_encoding="encode")
        doc, width = known.indices.to_numpy(), len(known.dictionary)
        asked = asks.flatten()
        told = pc.dictionary_encode(asked.field("query_id"), null_encoding="encode")
        query, w = told.indices.to_numpy(), asked.field("w").to_numpy()
        block = np.repeat(np.arange(len(n)), pc.list_value_length(asks).to_numpy())
        least = np.full(len(told.dictionary), 1 if k else np.iinfo(np.int64).min)
        if picked is not None:
            place = pc.index_in(told.dictionary, picked["query_id"].combine_chunks()).to_numpy(zero_copy_only=False)
            wanted = ~np.isnan(place.astype(np.float64))
            least[wanted] = picked["least"].to_numpy()[place[wanted].astype(np.int64)]
            keep = wanted[query]
            query, w, block = query[keep], w[keep], block[keep]
        order = np.argsort(query, kind="stable")
        query, w, block = query[order], w[order], block[order]
        step = max(1, PAIRS_AT_ONCE // max(1, len(doc)))
        for first in range(0, len(told.dictionary), step):
            lo, hi = np.searchsorted(query, [first, first + step])
            if lo == hi:
                continue
            size = n[block[lo:hi]]
            row = np.repeat(query[lo:hi] - first, size)
            pos = np.arange(size.sum()) + np.repeat(at[block[lo:hi]] - (np.cumsum(size) - size), size)
            value = np.repeat(w[lo:hi], size) * part[pos]
            value = (np.sign(value) * np.floor(np.abs(value) * SCALE + 0.5)).astype(np.int64)
            cell = row * width + doc[pos]
            total = np.zeros((step, width), dtype=np.int64)
            np.add.at(total.reshape(-1), cell, value)
            hit = np.zeros((step, width), dtype=bool)
            hit.reshape(-1)[cell] = True
            if k:
                rows = least[first:first + step]
                floor = np.pad(rows, (0, step - len(rows)))[:, None]
                hit &= total >= floor
                if width > k:
                    hit &= total >= np.partition(total, width - k, axis=1)[:, width - k][:, None]
            r, c = np.nonzero(hit)
            yield pa.table({"query_id": told.dictionary.take(pa.array(r + first)), "doc_id": known.dictionary.take(pa.array(c)), "steps": pa.array(total[r, c])})

    def whole(blocks: pa.Table, picked: pa.Table | None) -> pa.Table:
        found = list(scored(blocks, picked))
        if found:
            return pa.concat_tables(found)
        ids = blocks["asks"].type.value_type.field("query_id").type, blocks["docs"].type.value_type.field("doc_id").type
        return pa.table({"query_id": pa.array([], ids[0]), "doc_id": pa.array([], ids[1]), "steps": pa.array([], pa.int64())})

    if k:
        def chosen(blocks: pa.Table, picked: pa.Table) -> pa.Table:
            return whole(blocks, picked)

        return chosen

    def every(blocks: pa.Table) -> pa.Table:
        return whole(blocks, None)

    return every


def _small_join(big: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """Inner join; ``small`` is broadcast if its rows were counted to be few."""
    return big.join(F.broadcast(small) if is_small(small) else small, on)

"""Spelling variants by permuterm rotations.

A word and a terminator are rotated to every place: ``w[i:] + END + w[:i]``. Two words that differ by a replaced character share the
rotation that begins behind it up to its last character; a word that lacks one character of another equals that prefix as a whole. So every
rotation is a key, and so is every rotation without its last character, which is the edited one. Keys are dealt by hash and sorted with the
more frequent word first; one scan of a task's sorted keys sees each group of equal keys as neighbours, streaming, and emits for every word of a
group how many near words it has there and the best of them. No pairs are emitted: a replacement group holds at most one word per letter,
and the best neighbour of a word is the group's first or second. Of a run of equal letters only the first may be the inserted one, so a pair is met once.

A word of more than ``LONG`` letters would need the square of its length for its rotations, so there a key holds digests of the part before
and the part behind the edited place, both made in one run over the word, and the word itself is known by a digest, its label. Words of
``LONG`` letters also ask under such keys, for partners one letter longer. Where a label is among the best neighbours, ties are settled on the words.

Root: forms are followed by pointer doubling; n grows tenfold with each step, so the chain is short. A word has at most some thousand near
words, so no key of these joins is hot.

Defined cases: a null text has no words; a null doc_id counts as an empty text in the crc; repeated rows count each; an empty table gives an empty
result; other columns are ignored. Null words of a given table are dropped, repeated ones are added up.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditecho.llm.store import stored

END = "\x00"
LABEL = "\x01"  # begins keys and labels made of digests; sorted before every letter
LONG = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "a-zÀ-ÿ"  # runs are taken after A-Z are lower-cased
KEYS = "key string, ch string, first boolean, n long"
NEAR = "label string, near long, best_n long, best string"


def word_counts(docs: DataFrame, min_length: int = 7, drop_one_in: int = 31) -> DataFrame:
    """(word, n) of letter runs; every run whose crc32 is divisible by ``drop_one_in`` loses the code point at crc modulo length."""
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    # A shorter run cannot become a longer word, so it is never taken apart.
    runs = docs.select(name.alias("id"), F.explode(F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    at = F.col("h") % F.length("run")
    cut = F.concat(F.substring("run", F.lit(1), at.cast("int")), F.substring("run", (at + 2).cast("int"), F.length("run")))
    words = hashed.select(F.when(F.col("h") % drop_one_in == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))


def rotation_keys(words: DataFrame) -> DataFrame:
    """(key, ch, first, n): per word its rotations (ch empty) and its rotations without their last character ``ch``. The word is
    again what the key has behind END, then ``ch``, then what it has before END."""
    size = F.length("word")
    places = words.select("word", "n", F.explode(F.sequence(F.lit(0), size)).alias("i"))
    i, word = F.col("i"), F.col("word")
    head = F.substring(word, F.lit(1), i)
    tail = F.substring(word, i + 1, size)
    behind = F.substring(word, i + 2, size)
    letter, before = F.substring(word, i + 1, F.lit(1)), F.when(i > 0, F.substring(word, i, F.lit(1))).otherwise(F.lit(""))
    whole = F.struct(F.concat(tail, F.lit(END), head).alias("key"), F.lit("").alias("ch"), F.lit(False).alias("first"))
    edited = F.struct(F.concat(behind, F.lit(END), head).alias("key"), letter.alias("ch"), (letter != before).alias("first"))
    both = F.when(i < size, F.array(whole, edited)).otherwise(F.array(whole))
    return places.select(F.explode(both).alias("r"), "n").select("r.key", "r.ch", "r.first", "n")


def label_of(word: str) -> str:
    return LABEL + hashlib.blake2b(word.encode(), digest_size=16).hexdigest() if len(word) > LONG else word


def prefix_digests(word: str) -> list[str]:
    """Digest of each prefix, the empty one first, in one run."""
    state, out = hashlib.blake2b(digest_size=16), []
    out.append(state.hexdigest())
    for c in word:
        state.update(c.encode())
        out.append(state.hexdigest())
    return out


def digest_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``rotation_keys`` for words of ``LONG`` letters (rotations only) and more; ``ch`` also holds the word's label."""
    for batch in batches:
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            before, behind, size = prefix_digests(word), prefix_digests(word[::-1]), len(word)
            label = END + label_of(word)
            for begin in range(0, size + 1, 4096):
                part = range(begin, min(begin + 4096, size + 1))
                rows = [(LABEL + before[i] + END + behind[size - i], label, False) for i in part]
                if size > LONG:
                    rows += [(LABEL + before[i] + END + behind[size - i - 1], word[i] + label, i == 0 or word[i - 1] != word[i]) for i in part if i < size]
                key, ch, first = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ch), pa.array(first), pa.array([n] * len(rows), pa.int64())], names=["key", "ch", "first", "n"])


def near_in_groups(batch: pa.RecordBatch | pa.Table) -> pa.RecordBatch | None:
    """Neighbours inside groups of equal keys; rows are sorted by key, then n descending, then ch."""
    key = batch.column("key")
    if isinstance(key, pa.ChunkedArray):
        key = key.combine_chunks()
    m = len(key)
    if m < 2:
        return None
    new = np.concatenate([[True], pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)])
    group = np.cumsum(new) - 1
    shared = np.flatnonzero(np.bincount(group)[group] > 1)
    if not len(shared):
        return None
    batch, group = batch.take(pa.array(shared)), np.unique(group[shared], return_inverse=True)[1]
    ch = pa.concat_arrays(batch.column("ch").chunks) if isinstance(batch.column("ch"), pa.ChunkedArray) else batch.column("ch")
    n = np.asarray(batch.column("n"), np.int64)
    first = np.asarray(batch.column("first")).astype(bool)
    halves = pc.split_pattern(batch.column("key"), END)
    tail, head = pc.list_element(halves, 0), pc.list_element(halves, 1)
    word = pc.binary_join_element_wise(head, ch, tail, "")
    full = pc.equal(ch, "").to_numpy(zero_copy_only=False)
    by_label = pc.starts_with(batch.column("key"), LABEL)
    if pc.any(by_label).as_py():
        named = [c.partition(END) for c in ch.to_pylist()]
        word = pc.if_else(by_label, pa.array([label for _, _, label in named]), word)
        full = np.array([not letter for letter, _, _ in named])
    at, none, starts = np.arange(len(n)), len(n), np.flatnonzero(np.diff(group, prepend=-1))

    def least(mask: np.ndarray) -> np.ndarray:
        return np.minimum.reduceat(np.where(mask, at, none), starts)

    best = least(~full)
    second = least(~full & (at != best[group]))
    insertable = least(first)
    whole = least(full)
    edits = np.add.reduceat((~full).astype(np.int64), starts)
    inserts = np.add.reduceat(first.astype(np.int64), starts)
    replaced = np.flatnonzero(~full & (edits[group] > 1))
    longer = np.flatnonzero(first & (whole[group] < none))
    shorter = np.flatnonzero(full & (inserts[group] > 0))
    one = np.concatenate([replaced, longer, shorter])
    other = np.concatenate([
        np.where(best[group[replaced]] == replaced, second[group[replaced]], best[group[replaced]]), whole[group[longer]], insertable[group[shorter]],
    ])
    near = np.concatenate([edits[group[replaced]] - 1, np.ones(len(longer), np.int64), inserts[group[shorter]]])
    take = lambda rows: word.take(pa.array(rows))
    words, bests = take(one), take(other)
    flat = lambda x: x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    return pa.RecordBatch.from_arrays([flat(words), pa.array(near), pa.array(n[other]), flat(bests)], names=["label", "near", "best_n", "best"])


def scan_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scans sorted keys; a group that goes on in the next batch waits for it."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        last = table.column("key")[len(table) - 1]
        begin = pc.index(table.column("key"), last).as_py()
        held = table.slice(begin)
        if begin and (out := near_in_groups(table.slice(0, begin))) is not None:
            yield out
    if held is not None and (out := near_in_groups(held)) is not None:
        yield out


def label_column(word: str) -> Column:
    @F.pandas_udf("string")
    def labelled(words):
        return words.map(label_of)

    return F.when(F.length(word) > LONG, labelled(F.col(word))).otherwise(F.col(word))


def settled(top: DataFrame, near: DataFrame, words: DataFrame) -> DataFrame:
    """``top`` with words instead of labels; where a label is among the best, the least word of the best is taken."""
    open_ = top.filter(F.col("best").startswith(LABEL))
    tied = near.join(open_.select("label", F.col("top_n").alias("best_n")), ["label", "best_n"]).select("label", "best").distinct()
    named = words.select(label_column("word").alias("best"), "word")
    least = tied.join(named, "best").groupBy("label").agg(F.min("word").alias("least"))
    return top.join(least, "label", "left").select("label", "n_near", "top_n", F.coalesce("least", "best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form, by pointer doubling."""
    now = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while now.filter("moved").limit(1).count():
        next_ = now.select(F.col("word").alias("w"), F.col("root").alias("r"))
        step = now.join(next_, F.col("root") == F.col("w"), "left")
        now = stored(step.select("word", F.coalesce("r", "root").alias("root"), F.col("r").isNotNull().alias("moved")), "spelling-roots")
    return now.select("word", "root")


def group_variants(words: DataFrame, min_count: int = 2, ratio: int = 10) -> DataFrame:
    """word, n, n_near, form, form_n, root for a table (word, n). ``form``: the near word of largest n, if n is ``ratio`` times the word's or more."""
    counted = stored(words.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count), "spelling-words")
    size = F.length("word")
    keys = rotation_keys(counted.filter(size <= LONG))
    has_long = counted.filter(size > LONG).limit(1).count() > 0
    if has_long:
        keys = keys.unionByName(counted.filter(size >= LONG).mapInArrow(digest_keys, KEYS))
    near = keys.repartition("key").sortWithinPartitions("key", F.desc("n"), "ch").mapInArrow(scan_groups, NEAR)
    near = stored(near, "spelling-near") if has_long else near
    top = near.groupBy("label").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best"))).alias("top"),
    ).select("label", "n_near", (-F.col("top.less")).alias("top_n"), F.col("top.best").alias("best"))
    is_form = F.col("top_n") >= ratio * F.col("n")
    told = counted.withColumn("label", label_column("word")).join(settled(top, near, counted) if has_long else top, "label", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("top_n")).alias("form_n"),
    )
    told = stored(told, "spelling-forms")
    rooted = roots(told.filter("form is not null"))
    return told.join(rooted, "word", "left").select("*", F.coalesce("root", "word").alias("last")).drop("root").withColumnRenamed("last", "root")


def spelling_variants(docs: DataFrame, min_length: int = 7, min_count: int = 2, ratio: int = 10, drop_one_in: int = 31) -> DataFrame:
    """Variants among the words of all documents."""
    return group_variants(word_counts(docs, min_length, drop_one_in), min_count, ratio)

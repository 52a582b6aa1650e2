"""Byte-level BPE encoding and decoding of whole texts in numpy.

Splitting: the pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` sees only character classes,
so piece starts follow from class changes in one code point array. Merging: different pieces of a batch are padded into matrices by
length class; each round every row merges its leftmost pair of least rank, found in a hash table of pairs, and loses one column;
rows without a pair leave the matrix. A piece that is a token as a whole is that token. Pieces beyond ``MATRIX_LIMIT`` bytes use
a heap, which gives the same merges.

Ranks come from a file given by path (base64 token and rank per line); the tables are broadcast, their size is that of the vocabulary.

Defined cases: a null text is empty; an empty text has no tokens; repeated rows are encoded each on its own; an empty table gives an
empty result; other columns of the input are ignored.
"""
from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from creditecho.llm.textbatch import groups, range_hash

MATRIX_LIMIT = 2048
ENCODE_BYTES = 1 << 19
NONE = np.int32(2**31 - 1)
_U = np.uint64
# The characters of the Unicode property White_Space.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACE, LETTER, NUMBER, OTHER, EDGE = range(5)
_classes: list[np.ndarray] = []


def char_classes() -> np.ndarray:
    if not _classes:
        table = np.full(0x110000, OTHER, np.uint8)
        kinds = {"L": LETTER, "N": NUMBER}
        for c in range(0x110000):
            if (kind := kinds.get(unicodedata.category(chr(c))[0])) is not None:
                table[c] = kind
        table[WHITE_SPACE] = SPACE
        _classes.append(table)
    return _classes[0]


def pieces(parts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, starts, ends, document) of the pattern's matches in byte places of the joined buffer."""
    joined = b"\n".join([*parts, b""])
    buf = np.frombuffer(joined, np.uint8)
    cp = np.frombuffer(joined.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    ends = np.cumsum(np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))) - 1
    edge = np.searchsorted(at, ends)
    kind = table[cp]
    kind[edge] = EDGE
    n = len(cp)
    change = np.ones(n, bool)
    change[1:] = kind[1:] != kind[:-1]
    change[edge] = True
    start = change.copy()
    run = np.flatnonzero(change)
    run_end = np.append(run[1:], n)
    space = kind[run] == SPACE
    follows = run_end[space]
    last = follows - 1
    open_end = kind[np.minimum(follows, n - 1)] != EDGE
    start[last[open_end]] = True
    glued = open_end & (cp[last] == 32)
    start[follows[glued]] = False

    quote = np.flatnonzero((cp == 39) & start & (kind == OTHER))
    quote = quote[quote + 2 < n]
    quote = quote[kind[quote + 1] == LETTER]
    one, two = cp[quote + 1], cp[quote + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    for hit, size in ((short, 2), (long & ~short, 3)):
        q = quote[hit]
        start[q + 1] = False
        behind = q + size
        behind = behind[behind < n]
        start[behind[kind[behind] == LETTER]] = True

    first = np.flatnonzero(start)
    first_end = np.append(first[1:], n)
    real = kind[first] != EDGE
    byte_at = np.append(at, len(buf))
    starts, stops = byte_at[first[real]], byte_at[first_end[real]]
    return buf, starts, stops, np.searchsorted(ends, starts, side="right")


class Vocabulary:
    """Tables for encoding and decoding, built from token bytes by rank."""

    def __init__(self, tokens: dict[bytes, int]):
        size = max(tokens.values()) + 1
        by_rank = [b""] * size
        for token, rank in tokens.items():
            by_rank[rank] = token
        self.size = size
        self.lengths = np.fromiter((len(t) for t in by_rank), np.int64, size)
        self.bytes = np.frombuffer(b"".join(by_rank), np.uint8)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.of_byte = np.array([tokens[bytes([b])] for b in range(256)], np.int32)
        held = self.lengths > 0
        hashes = range_hash(self.bytes, self.offsets[held], self.offsets[held] + self.lengths[held])
        order = np.argsort(hashes)
        self.token_hash, self.token_rank = hashes[order], np.flatnonzero(held)[order].astype(np.int32)
        left, right, rank = [], [], []
        for token, r in tokens.items():
            for cut in range(1, len(token)):
                a, b = tokens.get(token[:cut]), tokens.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        self._place(np.array(left, np.int64) * size + np.array(right, np.int64), np.array(rank, np.int32))

    @classmethod
    def from_tables(cls, tables: dict) -> "Vocabulary":
        """A vocabulary over tables made elsewhere: only plain arrays are broadcast, so a worker needs no copy of this module."""
        out = cls.__new__(cls)
        out.__dict__.update(tables)
        return out

    def _place(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """Open addressing: a key lies in the first free slot from its own on."""
        self.bits = max(10, int(np.ceil(np.log2(max(2, 4 * len(keys))))))
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        waiting, slot = np.arange(len(keys)), self._slot(keys)
        while len(waiting):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = keys[waiting[free]]
            won = self.slots[slot] == keys[waiting]
            self.values[slot[won]] = ranks[waiting[won]]
            waiting, slot = waiting[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's token; NONE where there is none or a side is padding (below 0)."""
        keys = left.astype(np.int64) * self.size + right
        slot = self._slot(keys)
        found = self.slots[slot]
        out = np.where(found == keys, self.values[slot], NONE)
        waiting = np.flatnonzero((found != keys) & (found >= 0))
        slot = slot[waiting]
        while len(waiting):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            found = self.slots[slot]
            hit = found == keys[waiting]
            out[waiting[hit]] = self.values[slot[hit]]
            going = ~hit & (found >= 0)
            waiting, slot = waiting[going], slot[going]
        out[(left < 0) | (right < 0)] = NONE
        return out


def load(path: str) -> Vocabulary:
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})


def merge_long(ids: list[int], vocabulary: Vocabulary) -> list[int]:
    """The same merges for one long piece, with a heap over (rank, place)."""
    n = len(ids)
    nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    a = np.array(ids, np.int32)
    ranks = vocabulary.pair_ranks(a[:-1], a[1:]).tolist()
    heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(ranks) if r != NONE]
    heapq.heapify(heap)

    def push(i: int) -> None:
        j = nxt[i]
        if i >= 0 and j < n:
            r = int(vocabulary.pair_ranks(np.array([ids[i]], np.int32), np.array([ids[j]], np.int32))[0])
            if r != NONE:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

    while heap:
        r, i, x, y = heapq.heappop(heap)
        j = nxt[i]
        if not alive[i] or j >= n or ids[i] != x or ids[j] != y:
            continue
        ids[i], alive[j], nxt[i] = r, False, nxt[j]
        if nxt[j] < n:
            prv[nxt[j]] = i
        push(i)
        if prv[i] >= 0:
            push(prv[i])
    return [x for x, ok in zip(ids, alive) if ok]


def merge_matrix(m: np.ndarray, vocabulary: Vocabulary) -> list[tuple[np.ndarray, np.ndarray]]:
    """Merges rows of token ids padded by -1 until no pair is left; returns (row numbers, finished rows) as they leave."""
    rows, done = np.arange(len(m)), []
    ranks = vocabulary.pair_ranks(m[:, :-1].ravel(), m[:, 1:].ravel()).reshape(len(m), -1)
    while len(rows):
        if not ranks.shape[1]:
            done.append((rows, m))
            break
        at = ranks.argmin(axis=1)
        best = ranks[np.arange(len(rows)), at]
        going = best != NONE
        if not going.all():
            done.append((rows[~going], m[~going]))
            rows, m, ranks, at, best = rows[going], m[going], ranks[going], at[going], best[going]
            if not len(rows):
                break
        line, col = np.arange(len(rows)), np.arange(m.shape[1] - 1)
        m = np.where(col[None, :] <= at[:, None], m[:, :-1], m[:, 1:])
        m[line, at] = best
        if m.shape[1] == 1:
            done.append((rows, m))
            break
        ranks = np.where(col[None, :-1] < at[:, None], ranks[:, :-1], ranks[:, 1:])
        right = np.flatnonzero(at < m.shape[1] - 1)
        ranks[right, at[right]] = vocabulary.pair_ranks(m[right, at[right]], m[right, at[right] + 1])
        left = np.flatnonzero(at > 0)
        ranks[left, at[left] - 1] = vocabulary.pair_ranks(m[left, at[left] - 1], m[left, at[left]])
    return done


def _ranges(offset: np.ndarray, count: np.ndarray) -> np.ndarray:
    """offset[0], offset[0] + 1, ... for each count, one after the other."""
    total = np.cumsum(count)
    return np.repeat(offset - (total - count), count) + np.arange(total[-1] if len(total) else 0)


def encode_pieces(buf: np.ndarray, starts: np.ndarray, stops: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all pieces in order, number of ids per piece); equal pieces are merged once."""
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    hashes = range_hash(buf, starts, stops)
    unique, one, back = np.unique(hashes, return_index=True, return_inverse=True)
    begin, size = starts[one], (stops - starts)[one]
    count = np.ones(len(unique), np.int64)
    flat: list[np.ndarray] = []
    order: list[np.ndarray] = []
    at = np.minimum(np.searchsorted(v.token_hash, unique), len(v.token_hash) - 1)
    whole = (v.token_hash[at] == unique) & (v.lengths[v.token_rank[at]] == size)
    flat.append(v.token_rank[at[whole]])
    order.append(np.flatnonzero(whole))
    width = 2
    rest = np.flatnonzero(~whole)
    while len(rest) and width <= MATRIX_LIMIT:
        now = rest[(size[rest] <= width) & (size[rest] > width // 2)]
        if width == 2:
            now = rest[size[rest] <= 2]
        width *= 2
        for part in np.array_split(now, max(1, len(now) * width // (1 << 22))):
            if not len(part):
                continue
            wide = int(size[part].max())
            col = np.arange(wide)
            inside = col[None, :] < size[part][:, None]
            place = np.minimum(begin[part][:, None] + col[None, :], len(buf) - 1)
            m = np.where(inside, v.of_byte[buf[place]], np.int32(-1))
            for row, ids in merge_matrix(m, v):
                real = ids >= 0
                count[part[row]] = real.sum(axis=1)
                flat.append(ids[real])
                order.append(part[row])
    for i in rest[size[rest] > MATRIX_LIMIT]:
        ids = merge_long(v.of_byte[buf[begin[i]: begin[i] + size[i]]].tolist(), v)
        count[i] = len(ids)
        flat.append(np.array(ids, np.int32))
        order.append(np.array([i]))
    seq = np.concatenate(order)
    offset = np.zeros(len(unique), np.int64)
    offset[seq] = np.cumsum(count[seq]) - count[seq]
    per_piece = count[back]
    return np.concatenate(flat)[_ranges(offset[back], per_piece)], per_piece


def encode_texts(parts: list[bytes], v: Vocabulary, table: np.ndarray) -> list[np.ndarray]:
    buf, starts, stops, doc = pieces(parts, table)
    ids, per_piece = encode_pieces(buf, starts, stops, v)
    total = np.bincount(doc, weights=per_piece, minlength=len(parts)).astype(np.int64)
    return np.split(ids, np.cumsum(total)[:-1])


def decode_ids(rows: list[np.ndarray], v: Vocabulary) -> list[bytes]:
    ids = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    data = v.bytes[_ranges(v.offsets[ids], v.lengths[ids])]
    ends = np.concatenate([[0], np.cumsum(v.lengths[ids])])
    cut = np.cumsum([0, *(len(r) for r in rows)])
    return [data[ends[a]: ends[b]].tobytes() for a, b in zip(cut[:-1], cut[1:])]


def encode(docs: DataFrame, path: str, round_trip: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit numbers) and, if asked for, the bytes decoded from them again."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vars(load(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, table = Vocabulary.from_tables(shared.value), char_classes()
        for batch, parts in groups(batches, size=ENCODE_BYTES):
            rows = encode_texts(parts, v, table)
            columns = [
                batch.column("doc_id").cast(pa.int64()), pa.array([len(r) for r in rows], pa.int64()),
                pa.array([r.astype("<u4").tobytes() for r in rows], pa.binary()),
            ]
            if round_trip:
                columns.append(pa.array(decode_ids(rows, v), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "decoded"][: len(columns)])

    schema = "doc_id long, n_tokens long, ids binary" + (", decoded binary" if round_trip else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the bytes that a column ``ids`` stands for; null ids count as none."""
    shared = encoded.sparkSession.sparkContext.broadcast(vars(load(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary.from_tables(shared.value)
        for batch, parts in groups(batches, "ids"):
            rows = [np.frombuffer(p, "<u4").astype(np.int64) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(decode_ids(rows, v), pa.binary())],
                names=["doc_id", "decoded"],
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")

"""Alignment of two tokenizations of the same text, corpus-wide counts of overlapping id pairs, and their use per document.

A tokenized byte range is a fragment: an open prefix (tokens before the first place where tokens of both sides end), closed groups between such
places, and an open suffix. Fragments of neighbouring ranges compose: suffix and prefix meet in one group, the rest is joined. Composition is
associative, so a document may be cut at any bytes and its fragments be put together in any order of neighbours. It is used three ways:

* every different word of a pack (a byte range between safe places) has one fragment; it begins and ends at a common end, so the numbers and
  the text of a document are sums and joins over its words;
* a document of more than ``chunk_bytes`` is dealt over tasks as byte ranges. A range holds the tokens that end in it; to know them it
  brings the words it cuts. Its fragment is open at both sides;
* the fragments of such a document are composed by a tree: each level composes ``FAN`` neighbours in one task.

Safe place: before a space that follows a character that is no white space. The byte-level tokenizer splits its text there, and no piece of the other
one holds a space behind something else (checked when it is loaded), so both end a token there and neither sees across.

Every text is tokenized once, into packs that hold word numbers and the tokens of the different words. A pack (about two megabytes) counts its id pairs, each once per document, before they travel; sums and the best
count per first id follow by aggregation. The best counts are as many as the first tokenizer has ids, so they are broadcast. Replies go back per pack.

Defined cases: a text that is null, empty, or that one of the tokenizers does not give back byte by byte has no tokens and counts in no pair;
strings of special tokens inside a text are plain text; repeated rows count as documents of their own; null ids stay; an empty table gives
an empty result; other columns are ignored. A word without a safe place inside is tokenized as a whole, however long.
"""
from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditecho.llm.chunks import NULL_ID
from creditecho.llm.store import give_back, stored
from creditecho.llm.textbatch import groups

FAN = 8
PACK_BYTES = 2 << 20
MEMO_ENTRIES = 150_000
LEARN_WORDS = 4_096
QUICK_BYTES = 512
PACKS_PER_TASK = 4
LONG_PER_TASK = 64
SPACE_MARK = "▁"  # Fixed value: the mark that stands for a space in pieces
Token = tuple[int, int]  # id, length in bytes that lie in the range or before it; see Fragment


def byte_letters() -> dict[str, int]:
    """The printable letter of each byte in a byte-level vocabulary: printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, made in the task from the bytes of their files."""

    def __init__(self, first: bytes, second: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        self.first, self._a = first, None
        letters, described = byte_letters(), json.loads(first)
        vocabulary = described["model"]["vocab"]
        self.a_bytes = {i: bytes(letters[c] for c in t) for t, i in vocabulary.items() if all(c in letters for c in t)}
        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces):
            raise ValueError("a piece holds a space behind another character; words cannot be tokenized by themselves")
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i) else p.replace(SPACE_MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.a_length = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_length[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        self.quick = self._quick(described, vocabulary)

    @property
    def a(self):
        """The first tokenizer's own library, loaded when a long word needs it; it takes much more memory than the quick one."""
        if self._a is None:
            from tokenizers import Tokenizer

            self._a = Tokenizer.from_str(self.first.decode())
            self._a.encode_special_tokens = True
        return self._a

    def _quick(self, described: dict, vocabulary: dict[str, int]):
        """The faster library with the same vocabulary, if it splits and merges alike: merges in the order of their ids."""
        import public_tokenizers
        import tiktoken

        merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in described["model"]["merges"]]
        split = described["pre_tokenizer"]
        if merged != sorted(merged) or split.get("type") != "ByteLevel" or not split.get("use_regex") or split.get("add_prefix_space") or described["normalizer"]:
            return None
        ranks = {b: i for i, b in self.a_bytes.items()}
        return tiktoken.Encoding("first", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def words(self, words: list[bytes]) -> list[tuple[bytes, bytes] | None]:
        """Ids of both sides (32-bit numbers) for words that begin with a space; None where the bytes do not come back."""
        texts = [w.decode() for w in words]
        ids_a: list[list[int]] = [[]] * len(words)
        slow = [i for i, w in enumerate(words) if self.quick is None or len(w) > QUICK_BYTES]
        if slow:
            for i, e in zip(slow, self.a.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False)):
                ids_a[i] = e.ids
        if self.quick is not None:
            for i, (w, t) in enumerate(zip(words, texts)):
                if len(w) <= QUICK_BYTES:
                    ids_a[i] = self.quick.encode_ordinary(t)
        out = []
        bytes_a, bytes_b = self.a_bytes, self.b_bytes
        for w, a, b in zip(words, ids_a, self.b.encode([t[1:] for t in texts], num_threads=1)):
            fits = b"".join([bytes_a.get(i, b"") for i in a]) == w and b"".join([bytes_b[i] for i in b]) == w
            out.append((array("i", a).tobytes(), array("i", b).tobytes()) if fits else None)
        return out

    def tokens(self, word: tuple[bytes, bytes]) -> tuple[list[Token], list[Token]]:
        a, b = (np.frombuffer(x, np.int32) for x in word)
        return list(zip(a.tolist(), self.a_length[a].tolist())), list(zip(b.tolist(), self.b_length[b].tolist()))


@dataclass
class Fragment:
    """Tokens that end in one byte range. ``size``: its bytes. ``prefix``: tokens of both sides up to the first common end, as (id, end);
    ends count from the start of the range. ``cut``: there is such an end; without one all tokens are in ``prefix`` and the rest is empty. ``groups``: text of
    the closed groups behind the first end, ``links``: their pairs; ``suffix``: tokens behind the last common end, which lies at ``last``."""

    size: int = 0
    ok: bool = True
    prefix: tuple[list[Token], list[Token]] = field(default_factory=lambda: ([], []))
    cut: bool = False
    groups: list[str] = field(default_factory=list)
    links: list[tuple[int, int]] = field(default_factory=list)
    suffix: tuple[list[Token], list[Token]] = field(default_factory=lambda: ([], []))
    last: int = 0
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0

    def compose(self, other: "Fragment") -> "Fragment":
        """The fragment of this range and the one behind it. Extends lists of this one, which is given up."""
        moved = tuple([(t, e + self.size) for t, e in side] for side in other.prefix)
        out = Fragment(self.size + other.size, self.ok and other.ok, n_a=self.n_a + other.n_a, n_b=self.n_b + other.n_b)
        out.groups, out.links = self.groups, self.links
        if self.cut:
            out.prefix, out.cut, out.n_groups = self.prefix, True, self.n_groups
            met = (self.suffix[0] + moved[0], self.suffix[1] + moved[1])
            if other.cut:
                text, links = close(*met, self.last)
                out.groups.append(text)
                out.links += links
                out.n_groups += 1
            else:
                out.suffix, out.last = met, self.last
        else:
            out.prefix = (self.prefix[0] + moved[0], self.prefix[1] + moved[1])
            out.cut = other.cut
        if other.cut:
            out.groups += other.groups
            out.links += other.links
            out.n_groups += other.n_groups
            out.suffix = tuple([(t, e + self.size) for t, e in side] for side in other.suffix)
            out.last = other.last + self.size
        return out


def close(a: list[Token], b: list[Token], begin: int) -> tuple[str, list[tuple[int, int]]]:
    """Text and links of one group whose tokens (id, end) begin at ``begin``."""
    links, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        links.append((a[i][0], b[j][0]))
        end_a, end_b = a[i][1], b[j][1]
        i += end_a <= end_b
        j += end_b <= end_a
    return ",".join(str(t) for t, _ in a) + "|" + ",".join(str(t) for t, _ in b), links


def fragment(a: list[Token], b: list[Token], begin: int, end: int) -> Fragment:
    """Fragment of the range begin..end of a word whose tokens (id, length) are given; it takes the tokens that end in the range."""
    placed = []
    for side in (a, b):
        at, ends = 0, []
        for t, size in side:
            at += size
            if begin < at <= end:
                ends.append((t, at - begin))
        placed.append(ends)
    a, b = placed
    out = Fragment(end - begin, n_a=len(a), n_b=len(b))
    common = sorted({e for _, e in a} & {e for _, e in b})
    if not common:
        out.prefix = (a, b)
        return out
    pick = lambda side, low, high: [x for x in side if low < x[1] <= high]
    out.cut, out.last = True, common[-1]
    out.prefix = (pick(a, 0, common[0]), pick(b, 0, common[0]))
    out.suffix = (pick(a, common[-1], end), pick(b, common[-1], end))
    for low, high in zip(common[:-1], common[1:]):
        text, links = close(pick(a, low, high), pick(b, low, high), low)
        out.groups.append(text)
        out.links += links
    out.n_groups = len(out.groups)
    return out


def finished(f: Fragment) -> tuple[int, int, int, str, list[tuple[int, int]]] | None:
    """n_a, n_b, n_groups, text and links of a whole document; None if it has no tokens."""
    if not f.ok or not f.size or not f.cut or f.suffix != ([], []):
        return None
    text, links = close(*f.prefix, 0)
    return f.n_a, f.n_b, f.n_groups + 1, ";".join([text, *f.groups]), links + f.links


def safe_places(buf: np.ndarray) -> np.ndarray:
    """Places of spaces that follow a character that is surely no white space."""
    at = np.flatnonzero(buf == 32)
    at = at[(at > 0) & (at < len(buf) - 1)]  # a last space alone would be an empty text to the second tokenizer
    before = buf[at - 1]
    good = (before > 32) & (before < 127)
    wide = np.flatnonzero(before >= 128)
    place = at[wide]
    two, three = buf[np.maximum(place - 2, 0)], buf[np.maximum(place - 3, 0)]
    # White space beyond ASCII is U+0085, U+00A0 or lies in the blocks that begin with E1 9A, E2 80, E2 81 and E3 80; whole blocks are left out.
    latin = (two == 0xC2) & ((before[wide] == 0x85) | (before[wide] == 0xA0))
    block = ((three == 0xE1) & (two == 0x9A)) | ((three == 0xE2) & ((two == 0x80) | (two == 0x81))) | ((three == 0xE3) & (two == 0x80))
    good[wide] = ~(latin | block)
    return at[good]


class Aligner:
    """Tokens of words, kept over the texts of a task, and fragments made of them."""

    def __init__(self, first: bytes, second: bytes):
        self.tokenizers = Tokenizers(first, second)
        self.memo: dict[bytes, tuple[bytes, bytes] | None] = {}

    def learn(self, words: list[bytes]) -> None:
        """Tokenizes the words that are not known yet, ``LEARN_WORDS`` together: lists of ids take many times the memory of what is kept."""
        new = [w for w in words if w not in self.memo]
        for at in range(0, len(new), LEARN_WORDS):
            some = new[at:at + LEARN_WORDS]
            self.memo.update(zip(some, self.tokenizers.words(some)))

    def forget(self) -> None:
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()

    def pack(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        """Texts as numbers of their different words, and the tokens of these words. A text that does not come back counts no words."""
        number: dict[bytes, int] = {}
        split = [[number.setdefault(w, len(number)) for w in words_of(b" " + t)] if t else [] for t in texts]
        words = list(number)
        self.learn(words)
        known = [self.memo[w] for w in words]
        bad = {i for i, k in enumerate(known) if k is None}
        split = [[] if bad and not bad.isdisjoint(x) else x for x in split]
        sides = [[k[side] if k is not None else b"" for k in known] for side in (0, 1)]
        self.forget()
        return {
            "n_words": np.array([len(x) for x in split], np.int32), "words": np.fromiter((i for x in split for i in x), np.int32),
            **{f"{n}_ids": np.frombuffer(b"".join(side), np.int32) for n, side in zip("ab", sides)},
            **{f"{n}_count": np.array([len(x) >> 2 for x in side], np.int32) for n, side in zip("ab", sides)},
        }

    def range(self, body: bytes, begin: int, end: int) -> Fragment:
        """Fragment of begin..end of a text that begins and ends at safe places."""
        words = words_of(body)
        self.learn(list(dict.fromkeys(words)))
        out, at, kept = Fragment(), 0, {}
        for w in words:
            low, high = max(begin - at, 0), min(end - at, len(w))
            at += len(w)
            if low >= high:
                continue
            if self.memo[w] is None:
                out = out.compose(Fragment(high - low, ok=False))
            elif low == 0 and high == len(w) and out.cut and out.last == out.size:
                # A whole word behind a common end: all its groups are closed.
                if w not in kept:
                    kept[w] = finished(fragment(*self.tokenizers.tokens(self.memo[w]), 0, len(w)))
                n_a, n_b, n_groups, text, links = kept[w]
                out.size, out.last = out.size + len(w), out.size + len(w)
                out.n_a, out.n_b, out.n_groups = out.n_a + n_a, out.n_b + n_b, out.n_groups + n_groups
                out.groups.append(text)
                out.links += links
            else:
                out = out.compose(fragment(*self.tokenizers.tokens(self.memo[w]), low, high))
        self.forget()
        return out


@dataclass
class Words:
    """Fragments of all different words of a pack at once. A word begins and ends at safe places, so it consists of closed groups."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    links: np.ndarray  # pair codes of all words, one after the other
    first_link: np.ndarray  # where the links of each word begin, and the end
    text: bytes  # groups of all words
    first_byte: np.ndarray


def word_fragments(pack: dict[str, np.ndarray], a_length: np.ndarray, b_length: np.ndarray, with_text: bool = True) -> Words:
    a, b = pack["a_ids"].astype(np.int64), pack["b_ids"].astype(np.int64)
    end_a, end_b = np.cumsum(a_length[a]), np.cumsum(b_length[b])  # both sides of a word have the same bytes, so both agree
    total_a = np.cumsum(pack["a_count"])
    word_end = np.concatenate([[0], end_a])[total_a]
    both = np.sort(np.concatenate([end_a, end_b]), kind="stable")  # two sorted runs, merged in one go
    every = both[np.append(both[1:] != both[:-1], True)] if len(both) else both
    common = both[1:][both[1:] == both[:-1]]
    # Between two neighbouring ends lies one link: the tokens of both sides that cover this place.
    links = (a[np.searchsorted(end_a, every)] << 32) | b[np.searchsorted(end_b, every)]
    first_link = np.concatenate([[0], np.searchsorted(every, word_end, "right")])
    groups_to = np.searchsorted(common, word_end, "right")
    if not with_text:
        return Words(pack["a_count"], pack["b_count"], np.diff(groups_to, prepend=0), links, first_link, b"", np.zeros(0, np.int64))
    side = np.concatenate([2 * np.searchsorted(common, end_a), 2 * np.searchsorted(common, end_b) + 1])
    order = np.argsort(side, kind="stable")
    side, ids = side[order], np.concatenate([a, b])[order]
    last = np.append(side[1:] != side[:-1], True) if len(side) else np.zeros(0, bool)
    mark = np.where(last, np.where(side % 2 == 0, ord("|"), ord(";")), ord(",")).astype(np.uint8)
    powers = 10 ** np.arange(1, 11)
    digits = np.searchsorted(powers, ids, "right") + 1
    ends = np.cumsum(digits + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = mark
    place, left, rest = ends - 2, digits.copy(), ids
    while len(left):  # the last digit of every number, then the one before it
        out[place] = (rest % 10 + 48).astype(np.uint8)
        more = left > 1
        place, left, rest = place[more] - 1, left[more] - 1, rest[more] // 10
    tokens_to = np.cumsum(pack["a_count"] + pack["b_count"])
    first_byte = np.concatenate([[0], ends])[np.concatenate([[0], tokens_to])] if len(tokens_to) else np.zeros(1, np.int64)
    return Words(pack["a_count"], pack["b_count"], np.diff(groups_to, prepend=0), links, first_link, out.tobytes(), first_byte)


def per_document(pack: dict[str, np.ndarray], of_word: np.ndarray) -> np.ndarray:
    """Sum of a number per word over the words of each document."""
    total = np.concatenate([[0], np.cumsum(of_word[pack["words"]].astype(np.int64))])
    to = np.cumsum(pack["n_words"])
    return total[to] - total[to - pack["n_words"]]


def pairs_of(pack: dict[str, np.ndarray], w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(pair codes, number of documents of the pack that hold them)."""
    codes, link_pair = np.unique(w.links, return_inverse=True)
    doc = np.repeat(np.arange(len(pack["n_words"])), pack["n_words"])
    held = np.unique(doc * len(w.n_a) + pack["words"]) if len(w.n_a) else np.zeros(0, np.int64)
    doc, word = held // max(len(w.n_a), 1), held % max(len(w.n_a), 1)
    size = np.diff(w.first_link)[word]
    at = np.repeat(w.first_link[word] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    found = np.unique(np.repeat(doc, size) * max(len(codes), 1) + link_pair[at])
    return codes, np.bincount(found % max(len(codes), 1), minlength=len(codes))


def words_of(text: bytes) -> list[bytes]:
    cut = [0, *safe_places(np.frombuffer(text, np.uint8)).tolist(), len(text)]
    return [text[a:b] for a, b in zip(cut[:-1], cut[1:])]


def byte_ranges(text: bytes, size: int) -> list[tuple[bytes, int, int]]:
    """(body, begin, end): the text cut every ``size`` bytes; body reaches to the safe places around. A cut inside a word longer than ``size`` is left out."""
    places = np.concatenate([[0], safe_places(np.frombuffer(text, np.uint8)), [len(text)]])
    cuts = [0]
    for p in range(size, len(text), size):
        k = np.searchsorted(places, p, "right")
        if places[k] - places[k - 1] <= size and p > cuts[-1]:
            cuts.append(p)
    cuts.append(len(text))
    out = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        low, high = int(places[np.searchsorted(places, a, "right") - 1]), int(places[np.searchsorted(places, b, "left")])
        out.append((text[low:high], a - low, b - low))
    return out


FRAGMENT = "size long, ok boolean, cut boolean, last long, n_a long, n_b long, n_groups long, groups string, links binary, open binary"


def to_row(f: Fragment) -> tuple:
    sides = [*f.prefix, *f.suffix]
    lengths = [len(s) for s in sides]
    flat = np.array(lengths + [x for s in sides for t in s for x in t], np.int64)
    return f.size, f.ok, f.cut, f.last, f.n_a, f.n_b, f.n_groups, ";".join(f.groups), np.array(f.links, np.int64).tobytes(), flat.tobytes()


def from_row(r: dict) -> Fragment:
    flat = np.frombuffer(r["open"], np.int64).tolist()
    sides, at = [], 4
    for n in flat[:4]:
        sides.append(list(zip(flat[at: at + 2 * n: 2], flat[at + 1: at + 2 * n: 2])))
        at += 2 * n
    links = [tuple(x) for x in np.frombuffer(r["links"], np.int64).reshape(-1, 2).tolist()]
    return Fragment(
        r["size"], r["ok"], (sides[0], sides[1]), r["cut"], [r["groups"]] if r["n_groups"] else [], links, (sides[2], sides[3]), r["last"], r["n_a"], r["n_b"], r["n_groups"],
    )


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "int": pa.int32()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[f for f, _ in fields])


def long_documents(docs: DataFrame, shared, chunk_bytes: int) -> DataFrame:
    """(doc, doc_id, fragment columns) of the documents given, each composed from its byte ranges by a tree."""
    parts = "doc long, doc_id long, place long, body binary, begin long, end long"

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        doc = TaskContext.get().partitionId() << 32
        for batch in batches:
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for k, (body, begin, end) in enumerate(byte_ranges(b" " + text.encode(), chunk_bytes)):
                    yield _batch([(doc, key, k, body, begin, end)], parts)
                doc += 1

    def lift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*shared.value)
        for batch in batches:
            for r in (x for k in range(batch.num_rows) for x in batch.slice(k, 1).to_pylist()):
                yield _batch([(r["doc"], r["doc_id"], r["place"], *to_row(aligner.range(r["body"], r["begin"], r["end"])))], level)

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["place"])
        out = from_row(rows[0])
        for r in rows[1:]:
            out = out.compose(from_row(r))
        return pa.Table.from_batches([_batch([(rows[0]["doc"], rows[0]["doc_id"], rows[0]["place"] // FAN, *to_row(out))], level)])

    level = f"doc long, doc_id long, place long, {FRAGMENT}"
    ranges = stored(docs.select("doc_id", "text").mapInArrow(split, parts), "align-ranges", compression="zstd")
    now = stored(ranges.repartition("doc", "place").mapInArrow(lift, level), "align-fragments", compression="zstd")
    most = now.agg(F.max("place")).first()[0] or 0
    while most:
        now = stored(now.groupBy("doc", (F.col("place") / FAN).cast("long").alias("next")).applyInArrow(join, level), "align-fragments", compression="zstd")
        most //= FAN
    return now.drop("place")


def pair_counts(questions: DataFrame) -> DataFrame:
    """(a, b, n, best) from rows (a, b, n): sums per pair, and whether a pair has the highest sum of its a."""
    summed = stored(questions.groupBy("a", "b").agg(F.sum("n").alias("n")), "align-pairs")
    highest = summed.groupBy("a").agg(F.max("n").alias("highest"))  # one row per id of the first tokenizer
    return summed.join(F.broadcast(highest), "a").select("a", "b", "n", (F.col("n") == F.col("highest")).alias("best"))


OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
QUESTION = "pack long, a int, b int, n long"
ARRAYS = ("ids", "n_words", "words", "a_ids", "a_count", "b_ids", "b_count")
PACK = "pack_id long, sizes binary, body binary"


def packed(docs: DataFrame, shared) -> DataFrame:
    """Stored packs of about ``PACK_BYTES`` of text: doc ids, and texts as word numbers with the tokens of the words. Every text is tokenized once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, pack_id = Aligner(*shared.value), TaskContext.get().partitionId() << 32
        ids: list[int] = []
        texts: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal pack_id, size
            arrays = {"ids": np.array(ids, np.int64), **aligner.pack(texts)}
            sizes = np.array([len(arrays[n]) for n in ARRAYS], np.int64)
            body = zstandard.ZstdCompressor(level=3).compress(b"".join(planes(arrays[n]) for n in ARRAYS))
            out = _batch([(pack_id, sizes.tobytes(), body)], PACK)
            pack_id, size = pack_id + 1, 0
            ids.clear()
            texts.clear()
            return out

        for batch, parts in groups(batches):
            for key, text in zip(batch.column("doc_id").to_pylist(), parts):
                ids.append(NULL_ID if key is None else key)
                texts.append(text)
                size += len(text) + 8
            if size >= PACK_BYTES:
                yield flush()
                give_back()
        if ids:
            yield flush()
        aligner = None
        give_back()

    return stored(docs.select("doc_id", "text").mapInArrow(run, PACK), "align-packs")


def planes(x: np.ndarray) -> bytes:
    """All lowest bytes, then all second ones, and so on: the upper bytes of small numbers compress away."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes()


def unpacked(row: dict) -> dict[str, np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(row["body"]), 0, {}
    for n, size in zip(ARRAYS, np.frombuffer(row["sizes"], np.int64).tolist()):
        kind = np.int64 if n == "ids" else np.int32
        width = np.dtype(kind).itemsize
        wide = np.frombuffer(data, np.uint8, size * width, at).reshape(width, size)
        out[n] = np.ascontiguousarray(wide.T).view(kind).ravel()
        at += size * width
    return out


def asked(pack: int, codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(codes), pack), pa.int64()), pa.array((codes >> 32).astype(np.int32)), pa.array((codes & 0xFFFFFFFF).astype(np.int32)), pa.array(n, pa.int64())],
        names=["pack", "a", "b", "n"],
    )


def answer_of(replies: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted pair codes of a pack with their count and whether it is the best of its first id."""
    code, n, best = (replies[f].to_numpy().astype(np.int64) for f in ("code", "n", "best"))
    order = np.argsort(code)
    return code[order], n[order], best[order]


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def align(docs: DataFrame, first: str, second: str, chunk_bytes: int = 64 << 10) -> DataFrame:
    """Per document: tokens of both sides, groups, links, links of best count, sum of counts, and the groups as text."""
    files = tuple(open(p, "rb").read() for p in (first, second))
    shared = docs.sparkSession.sparkContext.broadcast(files)
    lengths = docs.sparkSession.sparkContext.broadcast((lambda t: (t.a_length, t.b_length))(Tokenizers(*files)))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    is_long = F.coalesce(F.octet_length("text") > chunk_bytes, F.lit(False))
    packs = packed(plain.filter(~is_long), shared)
    finals = long_documents(plain.filter(is_long), shared, chunk_bytes)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            pack = unpacked(row)
            yield asked(row["pack_id"], *pairs_of(pack, word_fragments(pack, *lengths.value, with_text=False)))
            give_back()

    def ask_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            told = finished(from_row(row))
            codes = np.unique(pair_codes(told[4])) if told else np.zeros(0, np.int64)
            yield asked(-1 - row["doc"], codes, np.ones(len(codes), np.int64))

    questions = stored(packs.mapInArrow(ask, QUESTION).unionByName(finals.mapInArrow(ask_long, QUESTION)), "align-questions", compression="zstd")
    counts = pair_counts(questions.select("a", "b", "n"))
    code = F.shiftleft(F.col("a").cast("long"), 32).bitwiseOR(F.col("b").cast("long"))
    replied = questions.select("pack", "a", "b").join(counts, ["a", "b"]).select("pack", code.alias("code"), "n", "best")
    replies = stored(replied, "align-replies", compression="zstd")

    def score(packs: pa.Table, replies: pa.Table) -> pa.Table:
        give_back()
        found = []
        for row in packs.to_pylist():
            pack = unpacked(row)
            w = word_fragments(pack, *lengths.value)
            codes, n, best = answer_of(replies)
            at = np.searchsorted(codes, w.links)
            total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[at])])[w.first_link])
            sums = [w.n_a, w.n_b, w.n_groups, np.diff(w.first_link), total(best), total(n)]
            text = [w.text[i: j - 1] for i, j in zip(w.first_byte[:-1].tolist(), w.first_byte[1:].tolist())]
            words, to = pack["words"].tolist(), np.cumsum(pack["n_words"]).tolist()
            whole = [b";".join([text[i] for i in words[e - size: e]]) for e, size in zip(to, pack["n_words"].tolist())]
            columns = [pa.array(pack["ids"], pa.int64(), mask=pack["ids"] == NULL_ID), *(pa.array(per_document(pack, x)) for x in sums)]
            out = pa.RecordBatch.from_arrays([*columns, pa.array(whole, pa.binary()).cast(pa.string())], names=[x.split()[0] for x in OUT.split(", ")])
            found += [out.slice(begin, 64) for begin in range(0, out.num_rows, 64)]
        return pa.Table.from_batches(found or [_batch([], OUT)])

    def score_long(documents: pa.Table, replies: pa.Table) -> pa.Table:
        rows = []
        for row in documents.to_pylist():
            told = finished(from_row(row))
            if told is None:
                rows.append((row["doc_id"], 0, 0, 0, 0, 0, 0, ""))
                continue
            n_a, n_b, n_groups, text, links = told
            codes, n, best = answer_of(replies)
            at = np.searchsorted(codes, pair_codes(links))
            rows.append((row["doc_id"], n_a, n_b, n_groups, len(links), int(best[at].sum()), int(n[at].sum()), text))
        return pa.Table.from_batches([_batch(rows, OUT)])

    def answered(rows: DataFrame, replies: DataFrame, run, per_task: int) -> DataFrame:
        """Every row meets its replies in a group of its own, so that a task holds one pack or document at a time, however many it is dealt."""
        tasks = max(1, rows.count() // per_task)
        return rows.repartition(tasks, "pack").groupBy("pack").cogroup(replies.repartition(tasks, "pack").groupBy("pack")).applyInArrow(run, OUT)

    short = answered(packs.withColumn("pack", F.col("pack_id")), replies.filter("pack >= 0"), score, PACKS_PER_TASK)
    long_ = answered(finals.withColumn("pack", F.lit(-1) - F.col("doc")), replies.filter("pack < 0"), score_long, LONG_PER_TASK)
    return short.unionByName(long_)


def pair_codes(links: list[tuple[int, int]]) -> np.ndarray:
    x = np.array(links, np.int64).reshape(-1, 2)
    return (x[:, 0] << 32) | x[:, 1]

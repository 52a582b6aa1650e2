"""Alignment against whole-text tokenization by both libraries, and the fragment monoid on random cuts."""
import random
from collections import defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from creditecho.llm import token_alignment as ta

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
ODD = [
    " ", "  ", "\n", " \n ", "\t", "\r\n", " ", "　", " ", "\u0085", "\x1c", "\x00", "a", "the", "don't", "I'LL", "Ünïcødé", "中文字", "\U0001F600", "é", "​", "123", "…",
    "“q”", "<s>", "</s>", "<unk>", "<|endoftext|>", "<0x41>", "x" * 40, ".", "!!", "-" * 9, "à", "﻿", "�", " ", "᠎",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def plain(text, libraries):
    """(A ids, B ids, groups, links) of one text, from whole-text calls; None without tokens."""
    a, b = libraries
    if not text:
        return None
    letters = ta.byte_letters()
    want = b" " + text.encode()
    tokens_a = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    tokens_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        tokens_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    if b"".join(t for _, t in tokens_a) != want or b"".join(t for _, t in tokens_b) != want:
        return None

    def spans(tokens):
        at, out = 0, []
        for i, t in tokens:
            out.append((i, at, at + len(t)))
            at += len(t)
        return out

    sa, sb = spans(tokens_a), spans(tokens_b)
    ends = sorted({e for _, _, e in sa} & {e for _, _, e in sb})
    groups, low = [], 0
    for high in ends:
        ids = [",".join(str(i) for i, _, e in side if low < e <= high) for side in (sa, sb)]
        groups.append("|".join(ids))
        low = high
    links = [(i, j) for i, s, e in sa for j, t, f in sb if s < f and t < e]
    return len(sa), len(sb), len(groups), ";".join(groups), links


def expected(rows, libraries):
    told = [plain(t, libraries) for _, t in rows]
    count, best = defaultdict(int), defaultdict(int)
    for t in told:
        for pair in set(t[4]) if t else ():
            count[pair] += 1
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for (key, _), t in zip(rows, told):
        if t is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((key, *t[:3], len(t[4]), sum(count[p] == best[p[0]] for p in t[4]), sum(count[p] for p in t[4]), t[3]))
    return sorted(out, key=repr)


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) + rng.choice(["", " ", ""]) for _ in range(rng.randint(1, 25))) for _ in range(n)]


def whole(aligner, texts):
    """Numbers, text and links of whole texts by the fragments of their words."""
    pack = aligner.pack([t.encode() for t in texts])
    w = ta.word_fragments(pack, aligner.tokenizers.a_length, aligner.tokenizers.b_length)
    out, at = [], 0
    for size in pack["n_words"].tolist():
        words = pack["words"][at: at + size].tolist()
        at += size
        text = b";".join(w.text[w.first_byte[i]: w.first_byte[i + 1] - 1] for i in words).decode()
        links = [(int(c) >> 32, int(c) & 0xFFFFFFFF) for i in words for c in w.links[w.first_link[i]: w.first_link[i + 1]]]
        out.append((int(w.n_a[words].sum()), int(w.n_b[words].sum()), int(w.n_groups[words].sum()), text, links) if words else None)
    return out


def test_words_stand_alone(libraries):
    aligner = ta.Aligner(*(open(p, "rb").read() for p in PATHS))
    assert aligner.tokenizers.quick is not None
    cases = texts(1500, 1) + ["a ▁b", "▁", "word", " lead", "trail ", "a  b", "x" * 3000, "lots of  words " * 9]
    for text, got in zip(cases, whole(aligner, cases)):
        want = plain(text, libraries)
        assert (got is None) == (want is None), repr(text)
        if want:
            assert got[:4] == want[:4] and sorted(got[4]) == sorted(want[4]), repr(text)


def test_monoid(libraries):
    aligner, rng = ta.Aligner(*(open(p, "rb").read() for p in PATHS)), random.Random(2)
    for text in texts(150, 3) + ["many short words in one line " * 8]:
        body = b" " + text.encode()
        size = rng.choice([1, 2, 3, 7, 20, 60])
        parts = [aligner.range(*r) for r in ta.byte_ranges(body, size)]
        parts = [ta.from_row(dict(zip([x.split()[0] for x in ta.FRAGMENT.split(", ")], ta.to_row(p)))) for p in parts]
        while len(parts) > 1:  # neighbours in random order
            k = rng.randrange(len(parts) - 1)
            parts[k: k + 2] = [parts[k].compose(parts[k + 1])]
        assert ta.finished(parts[0]) == whole(aligner, [text])[0], repr(text)


def got(df):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_documents(spark, frame, libraries):
    rows = [(i, t) for i, t in enumerate(texts(120, 4))]
    rows += [(1, rows[1][1]), (None, rows[2][1]), (None, None), (500, None), (501, ""), (502, "  \n"), (503, "no▁such"), (504, "word and more words, " * 300), (505, "x" * 1500)]
    docs = frame(rows)
    want = expected(rows, libraries)
    assert got(ta.align(docs, *PATHS)) == want
    assert got(ta.align(docs, *PATHS, chunk_bytes=50)) == want  # most documents are cut, up to 120 ranges and three levels
    assert ta.align(docs.filter("doc_id = -1"), *PATHS).count() == 0


def test_words_are_learned_in_small_lists():
    aligner = ta.Aligner(*(open(p, "rb").read() for p in PATHS))
    asked, words = [], aligner.tokenizers.words
    aligner.tokenizers.words = lambda some: asked.append(len(some)) or words(some)
    new = [f" w{i}é".encode() for i in range(ta.LEARN_WORDS + 700)]
    aligner.learn(new[:50] + new)
    aligner.learn(new)
    assert max(asked) <= ta.LEARN_WORDS and sum(asked) >= len(new)
    assert [aligner.memo[w] for w in new] == words(new)


def test_packs_are_answered_one_at_a_time(spark, capsys):
    """A task that is dealt many packs must not hold them in one batch."""
    rows = spark.createDataFrame([(i, f"some words {i % 7} of a text") for i in range(60)] + [(99, "w " * 300)], "doc_id long, text string")
    out = ta.align(rows, *PATHS, chunk_bytes=200)
    out.explain()
    plan = capsys.readouterr().out
    assert plan.count("FlatMapCoGroupsInArrow") == 2 and "MapInArrow" not in plan.replace("FlatMapCoGroupsInArrow", "") and "collect_list" not in plan
    assert out.count() == 61

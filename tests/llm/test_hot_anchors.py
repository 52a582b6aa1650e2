"""An anchor in very many different surroundings: no task may hold all its segments, and equal windows still meet."""
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from creditecho.llm import segments, substring_dedup, suffix_array_dedup
from creditecho.llm.chunks import Chunk

PHRASE = "this footer stands below every page of ours"


def footers(seed, n, copies=True):
    """Rows with a common phrase between different words; with copies, some surroundings occur twice and some ids too."""
    draw, rows = random.Random(seed), []
    word = lambda: "".join(draw.choices("abcdefghij", k=7))
    for i in range(n):
        text = " ".join([*(word() for _ in range(30)), PHRASE, *(word() for _ in range(30))])
        if copies and i % 4 == 0 and rows:
            text = rows[-1][1]
        if copies and i % 4 == 1 and rows:
            text = " ".join(rows[-1][1].split()[20:])
        rows.append((i if not copies or i % 7 else i // 2, text))
    return rows


VIEWS = {
    "op3": (lambda c: substring_dedup.word_view(c, 20, 3), 20), "op7": (lambda c: suffix_array_dedup.byte_view(c, 120, 16), 120),
}


@pytest.mark.parametrize("name", VIEWS)
def test_different_surroundings_of_a_hot_anchor_part(name):
    view, window = VIEWS[name]
    rows = footers(1, 200, copies=False)
    body = [t.encode() for _, t in rows]
    chunk = Chunk(0, np.arange(200), np.array([len(b) for b in body]), b"".join(body))
    keys, counts = view(chunk).segments.counted()
    level = np.log2(counts).astype(np.uint8)
    assert level.max() >= 5
    sent = segments._rows(chunk, view(chunk), level, 5)
    together = Counter(zip(sent.column("key").to_pylist(), sent.column("single").to_pylist()))
    assert max(together.values()) < 32  # all 200 rows of the phrase had one key before
    assert len(pa.compute.unique(sent.filter(sent.column("single")).column("content"))) > 1000


@pytest.mark.parametrize("module,window,anchor", [(substring_dedup, 20, 3), (substring_dedup, 6, 2), (suffix_array_dedup, 120, 16), (suffix_array_dedup, 30, 8)])
def test_hot_routing_finds_the_same_windows(frame, module, window, anchor):
    rows = [*footers(2, 60), (None, PHRASE * 3), (None, PHRASE * 3), (900, "-" * 300), (901, "-" * 250), (902, "ab " * 90), (5, None)]
    get = lambda hot: sorted((str(r.doc_id), bytes(r.kept), r.n_removed, str(r.spans)) for r in module.repeats_removed(frame(rows), window, anchor, hot).collect())
    plain = get(16)
    assert sum(r[2] for r in plain) > 0
    assert get(1) == plain == get(4)

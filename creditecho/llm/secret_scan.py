"""Secret scans with one combined deterministic automaton over bytes.

Rules are regular expressions of literals, classes, repeats, groups and alternatives. Each is turned into a nondeterministic automaton,
all together into one deterministic one by subset construction over byte classes, minimised by partition refinement, and stored as a
transition array. The combined automaton is that of the reversed rules: it passes once over a batch of texts, joined into one byte buffer,
from the last byte to the first, and so marks, for all rules at once, every byte where a match begins. The pass runs in many lanes side by
side: each lane starts in the root state, and lanes whose true start state turns out to differ are passed again from it.

Spans are leftmost, longest and non-overlapping within a kind. From the first mark that no earlier match covers, the rule's own anchored
automaton reads on to the end of the longest match. A pair of place and state that led to no longer match is remembered, so no byte is read
twice in one state and the whole scan takes time in proportion to the bytes. A rule has a pattern for the match and a least length of its
last part; matches that fail the length are dropped after they have used up their text, as the rule says.

Kinds ``assign``, ``access`` and ``hex`` are the base rules; the others find key headers and tokens with a known beginning.

Defined cases: a null text is empty; empty texts have no spans; repeated rows are scanned each on its own; offsets count code points; an empty
table gives an empty result; ``masked_documents`` keeps all columns of its input and changes only ``text`` (null stays null).
"""
from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from creditecho.llm.textbatch import groups

LANE = 1024
ROUNDS = 3  # of all lanes with a wrong start side by side; what is left is passed one by one, each lane once
EDGE = b"\xff"  # between documents: no UTF-8 text holds it and no rule reads it


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_WORDS = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _any_case("api") + "_?" + _any_case("key")
_HEAD = rf"""(?:{_WORDS})["']?\x20*[:=]\x20*["']?"""


class Rule:
    """``head`` then a run of ``body`` characters; the run must have ``least`` characters for the match to be kept."""

    def __init__(self, kind: str, head: str, body: str, least: int):
        self.kind, self.head, self.body, self.least = kind, head, body, least
        self.pattern = f"{head}{body}+"
        # Holds wherever a kept match lies. Counting inside several rules at once would multiply the states, so only a rule
        # without a head counts its run; a head is rare enough.
        self.told = f"{head}{body}" if head else f"{body}{{{least}}}"


BASE = (
    Rule("assign", _HEAD, "[A-Za-z0-9+/_.=-]", 12),
    Rule("access", "AKIA", "[A-Z0-9]", 14),
    Rule("hex", "", "[0-9a-f]", 16),
)
MORE = (
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]", 30),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]", 20),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.]", "[A-Za-z0-9_-]", 10),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "[A-Za-z0-9+/=\n\r]", 16),
)
RULES = BASE + MORE


class Nfa:
    """Thompson construction; edges carry byte sets, None is the empty move. ``backward`` reads the pattern from its last item to its first."""

    def __init__(self, backward: bool = False) -> None:
        self.backward = backward
        self.edges: list[list[tuple[frozenset[int] | None, int]]] = []

    def state(self) -> int:
        self.edges.append([])
        return len(self.edges) - 1

    def _set(self, items) -> frozenset[int]:
        out: set[int] = set()
        for op, arg in items:
            if op is sre.LITERAL:
                out.add(arg)
            elif op is sre.RANGE:
                out |= set(range(arg[0], arg[1] + 1))
            else:
                raise ValueError(f"not supported in a class: {op}")
        return frozenset(out)

    def add(self, tree, start: int) -> int:
        for op, arg in reversed(list(tree)) if self.backward else tree:
            if op is sre.LITERAL:
                start = self._step(start, frozenset([arg]))
            elif op is sre.IN:
                start = self._step(start, self._set(arg))
            elif op is sre.SUBPATTERN:
                start = self.add(arg[-1], start)
            elif op is sre.BRANCH:
                end = self.state()
                for branch in arg[1]:
                    self.edges[self.add(branch, start)].append((None, end))
                start = end
            elif op is sre.MAX_REPEAT:
                low, high, inner = arg
                for _ in range(low):
                    start = self.add(inner, start)
                if high is sre.MAXREPEAT:
                    loop = self.state()
                    self.edges[start].append((None, loop))
                    self.edges[self.add(inner, loop)].append((None, loop))
                    start = loop
                else:
                    end = self.state()
                    for _ in range(high - low):
                        self.edges[start].append((None, end))
                        start = self.add(inner, start)
                    self.edges[start].append((None, end))
                    start = end
            else:
                raise ValueError(f"not supported in a rule: {op}")
        return start

    def _step(self, start: int, chars: frozenset[int]) -> int:
        end = self.state()
        self.edges[start].append((chars, end))
        return end

    def closure(self, states: frozenset[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for chars, to in self.edges[todo.pop()]:
                if chars is None and to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)


class Dfa:
    """``step[state, byte class]`` and ``accepts[state]``, a bit per rule. State 0 is the start."""

    def __init__(self, patterns: list[str], searching: bool, backward: bool = False):
        nfa, ends = Nfa(backward), {}
        root = nfa.state()
        for i, p in enumerate(patterns):
            ends[nfa.add(sre_parser.parse(p), root)] = 1 << i
        # bytes that no rule tells apart share a class
        sets = {chars for edges in nfa.edges for chars, _ in edges if chars is not None}
        marks: dict[tuple, int] = {}
        self.classes = np.array([marks.setdefault(tuple(b in s for s in sets), len(marks)) for b in range(256)], np.uint8)
        sample = [int(np.flatnonzero(self.classes == c)[0]) for c in range(len(marks))]
        first = nfa.closure(frozenset([root]))
        numbers, table, todo = {first: 0}, [], [first]
        for now in todo:
            row = []
            for b in sample:
                to = frozenset(t for s in now for chars, t in nfa.edges[s] if chars is not None and b in chars)
                to = nfa.closure(to | ({root} if searching else frozenset()))
                if to not in numbers:
                    numbers[to] = len(numbers)
                    todo.append(to)
                row.append(numbers[to])
            table.append(row)
        step = np.array(table, np.int64)
        accepts = np.array([sum({ends[s] for s in states if s in ends}) for states in todo], np.int64)
        self.step, self.accepts = self._minimised(step, accepts)

    @staticmethod
    def _minimised(step: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Partition refinement: states stay together while they accept alike and step to the same parts."""
        part = np.unique(accepts, return_inverse=True)[1].ravel()
        while True:
            finer = np.unique(np.column_stack([part, part[step]]), axis=0, return_inverse=True)[1].ravel()
            if finer.max() == part.max():
                break
            part = finer
        _, one = np.unique(part, return_index=True)
        order = np.argsort(one, kind="stable")  # the part of the start state gets number 0
        number = np.empty_like(order)
        number[order] = np.arange(len(order))
        part, one = number[part], one[order]
        return part[step[one]].astype(np.int32), accepts[one]


class Walk:
    """One rule's anchored automaton in plain lists, for the few bytes that matches hold."""

    def __init__(self, pattern: str):
        dfa = Dfa([pattern], False)
        self.classes, self.width = dfa.classes.tobytes(), dfa.step.shape[1]
        self.step, self.final = dfa.step.ravel().tolist(), [bool(a) for a in dfa.accepts]
        n, width = len(self.final), self.width
        self.dead = [not self.final[s] and all(t == s for t in self.step[s * width: (s + 1) * width]) for s in range(n)]

    def longest(self, data: bytes, start: int, stop: int, failed: set[int] | None = None) -> int:
        """End of the longest match from ``start``, at most ``stop``; -1 without one. ``data`` holds byte classes."""
        step, width, final, dead = self.step, self.width, self.final, self.dead
        state, end, behind = 0, start if final[0] else -1, []
        for i in range(start, stop):
            state = step[state * width + data[i]]
            if dead[state]:
                break
            if final[state]:
                end = i + 1
                behind.clear()
            elif failed is not None:
                mark = i * len(final) + state
                if mark in failed:
                    break
                behind.append(mark)
        if failed is not None:
            failed.update(behind)
        return end


class Scanner:
    """The combined automaton of the reversed rules, and per rule an anchored automaton of the whole pattern and of its head."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.begins = Dfa([r.told for r in rules], True, True)
        self.whole = [Walk(r.pattern) for r in rules]
        self.heads = [Walk(r.head) if r.head else None for r in rules]

    def spans(self, parts: list[bytes]) -> list[list[tuple[str, int, int]]]:
        """Per document (kind, start, end) in code points, ordered by start, then kind as listed."""
        data = EDGE.join([*parts, b""])
        places, bits = marks(np.frombuffer(data, np.uint8), self.begins)
        found: list[tuple[int, int, int]] = []
        for k in range(len(self.rules)):
            at = places[bits >> k & 1 == 1].tolist()
            found += [(s, k, e) for s, e in self._kept(data, k, at)] if at else []
        out: list[list[tuple[str, int, int]]] = [[] for _ in parts]
        first = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])]).astype(np.int64)
        held, base, points = -1, 0, np.zeros(1, np.int64)
        for s, k, e in sorted(found):
            if held < 0 or s >= first[held + 1]:
                held = int(np.searchsorted(first, s, side="right")) - 1
                base = int(first[held])
                points = np.concatenate([[0], np.cumsum((np.frombuffer(parts[held], np.uint8) & 0xC0) != 0x80)])
            out[held].append((self.rules[k].kind, int(points[s - base]), int(points[e - base])))
        return out

    def _kept(self, data: bytes, k: int, at: list[int]) -> Iterator[tuple[int, int]]:
        """Kept matches of one rule, as byte places, from the sorted places where its matches begin.

        No optional part of a head can also be read as body, so the longest head before the body is the one that the pattern takes.
        """
        whole, head, least = self.whole[k], self.heads[k], self.rules[k].least
        classes, failed, i = data.translate(whole.classes), set(), 0
        head_classes = data.translate(head.classes) if head else b""
        while i < len(at):
            start = at[i]
            end = whole.longest(classes, start, len(classes), failed)
            body = head.longest(head_classes, start, end) if head else start
            if end - body >= least:
                yield start, end
            i = bisect_left(at, max(end, start + 1), i)


def marks(buf: np.ndarray, dfa: Dfa) -> tuple[np.ndarray, np.ndarray]:
    """(places, rule bits) where a match of some rule begins, in rising order, from one pass over the bytes from last to first."""
    n = len(buf)
    lanes = -(-n // LANE)
    wide = np.full(lanes * LANE, dfa.classes[EDGE[0]], np.uint8)
    wide[:n] = dfa.classes[buf[::-1]]
    wide = np.ascontiguousarray(wide.reshape(lanes, LANE).T)
    width = dfa.step.shape[1]
    flat, hits = dfa.step.ravel() * width, dfa.accepts.astype(np.int64)
    notes: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []  # lane, place in reading order, bits, round
    last = np.zeros(lanes, np.int64)  # the round that counts, per lane

    def run(lane: np.ndarray, state: np.ndarray, turn: int) -> np.ndarray:
        last[lane] = turn
        for i in range(LANE):
            state = flat[state + wide[i, lane]]
            bits = hits[state // width]
            if bits.any():
                at = np.flatnonzero(bits)
                notes.append((lane[at], lane[at] * LANE + i, bits[at], turn))
        return state

    begin = np.zeros(lanes, np.int64)
    end = run(np.arange(lanes), begin, 0)
    wrong, turn = np.zeros(0, np.int64), 0
    while lanes:  # lanes whose true start state is not the one they were passed from
        want = np.concatenate([[0], end[:-1]])
        wrong = np.flatnonzero(want != begin)
        if not len(wrong) or turn == ROUNDS:
            break
        turn += 1
        begin[wrong] = want[wrong]
        end[wrong] = run(wrong, want[wrong], turn)
    if len(wrong):  # a state that lasts over many lanes: from here on each lane is passed at most once more, in order
        steps, accepts = flat.tolist(), hits.tolist()
        for la in range(int(wrong[0]), lanes):
            state = int(end[la - 1])
            if state == begin[la]:
                continue
            last[la], found, told = turn + 1, [], []
            for i, c in enumerate(wide[:, la].tolist()):
                state = steps[state + c]
                if accepts[state // width]:
                    found.append(la * LANE + i)
                    told.append(accepts[state // width])
            end[la] = state
            if found:
                notes.append((np.full(len(found), la), np.array(found), np.array(told), turn + 1))
    if not notes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lane, place, bits = (np.concatenate([x[j] for x in notes]) for j in range(3))
    counts = np.repeat([x[3] for x in notes], [len(x[0]) for x in notes]) == last[lane]
    place, bits = n - 1 - place[counts], bits[counts]
    inside = place >= 0
    order = np.argsort(place[inside])
    return place[inside][order], bits[inside][order]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and ``spans``, an array of (kind, start, end) in code points, for every document."""
    scanner = Scanner(rules)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, parts in groups(batches):
            rows = [[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in scanner.spans(parts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(rows, kind)], names=["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each run of overlapping spans is replaced by the kind of its first one in brackets."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def masked_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows and columns of ``docs``; secrets in ``text`` are masked and ``n_chars``, where present, follows the new text."""
    scanner, names = Scanner(rules), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, parts in groups(batches):
            spans = scanner.spans(parts)
            hit = {i for i, s in enumerate(spans) if s}
            if hit:
                text = batch.column("text").to_pylist()
                text = [masked(t, spans[i]) if i in hit else t for i, t in enumerate(text)]
                columns = list(batch.columns)
                at = names.index("text")
                columns[at] = pa.array(text, batch.schema.field(at).type)
                if "n_chars" in names:
                    at = names.index("n_chars")
                    kind = batch.schema.field(at).type
                    n = [len(text[i]) if i in hit else x for i, x in enumerate(columns[at].to_pylist())]
                    columns[at] = pa.array(n, kind)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    return docs.mapInArrow(run, docs.schema)

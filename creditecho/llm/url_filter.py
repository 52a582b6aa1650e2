"""URL filters with Bloom filter cascades: exact membership of every key that the corpus can ask for, without a join.

A rule is a host and a path prefix. A page asks for the keys ``host suffix + path prefix`` whose label count and path length occur among
the rules; all keys of all pages are the key universe. Level 0 of a cascade encodes the listed keys, level 1 the keys of the universe
that level 0 lets through although they are not listed, level 2 the listed keys that level 1 lets through, and so on until a level lets
nothing wrong through. A key is listed exactly if the first level that rejects it is an odd one (or none does and the last is even).

The false positives of level 0 are found by one pass over the corpus. Level 0 is sized for ``listed / sqrt(2)`` of them, so what the driver
collects and the cascade itself are bounded by the rule list, not by the corpus; a level 0 that lets more through is built larger.

The longest rule wins (host + path; of equal length the longer host). Where no rule fits, the verdict is ``default``.

Defined cases: a null url, or one without ``://``, has empty host and path and fits no rule; hosts are lower-cased in A-Z only; repeated
rows are judged each on its own; without rules everything gets the default; an empty table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LATER_RATE = 0.5
HARD_BOUND = 1000
_LOWER = {c: c + 32 for c in range(65, 91)}
_REST = re.compile(r"[/?#]")
_TAIL = re.compile(r"[?#]")


class Rules:
    """Rules as ``{host + path: verdict}``; a host holds no slash, so the key tells both parts."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.verdicts = {host + path: verdict for verdict, host, path in rules}
        self.labels = sorted({host.count(".") + 1 for _, host, _ in rules})
        self.lengths = sorted({len(path) for _, _, path in rules})

    def of(self, verdict: str) -> set[bytes]:
        return {k.encode() for k, v in self.verdicts.items() if v == verdict}

    def keys(self, host: str, path: str) -> list[str]:
        """Keys a url asks for, longest first."""
        labels = host.split(".")
        hosts = [".".join(labels[-n:]) for n in self.labels if n <= len(labels)]
        found = [(len(h) + n, len(h), h + path[:n]) for h in hosts for n in self.lengths if n <= len(path)]
        return [k for _, _, k in sorted(found, reverse=True)]


def split_url(url: str | None) -> tuple[str, str]:
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3:]
    cut = m.start() if (m := _REST.search(rest)) else len(rest)
    host, path = rest[:cut].translate(_LOWER), rest[cut:]
    return host, path[: m.start()] if (m := _TAIL.search(path)) else path


def _hash(key: bytes, level: int) -> tuple[int, int]:
    d = hashlib.blake2b(key, digest_size=16, salt=level.to_bytes(8, "little")).digest()
    return int.from_bytes(d[:8], "little"), int.from_bytes(d[8:], "little") | 1


class Bloom:
    def __init__(self, keys: set[bytes], rate: float, level: int):
        self.level = level
        self.bits = max(8, math.ceil(-max(1, len(keys)) * math.log(rate) / math.log(2) ** 2))
        self.hashes = max(1, round(-math.log2(rate)))
        self.data = np.zeros((self.bits + 7) // 8, np.uint8)
        for k in keys:
            for p in self._places(k):
                self.data[p >> 3] |= 1 << (p & 7)

    def _places(self, key: bytes) -> list[int]:
        a, b = _hash(key, self.level)
        return [(a + i * b) % self.bits for i in range(self.hashes)]

    def __contains__(self, key: bytes) -> bool:
        return all(self.data[p >> 3] >> (p & 7) & 1 for p in self._places(key))


class Cascade:
    def __init__(self, listed: set[bytes], first: Bloom, wrong: set[bytes]):
        self.levels, inside, outside = [first], listed, wrong
        while outside:
            level = Bloom(outside, LATER_RATE, len(self.levels))
            self.levels.append(level)
            inside, outside = outside, {k for k in inside if k in level}

    def __contains__(self, key: bytes) -> bool:
        for i, level in enumerate(self.levels):
            if key not in level:
                return i % 2 == 1
        return len(self.levels) % 2 == 1


def build_cascades(pages: DataFrame, rules: Rules, verdicts: tuple[str, ...]) -> dict[str, Cascade]:
    """One cascade per verdict, exact for every key that the pages ask for."""
    universe = max(1, pages.count() * len(rules.labels) * len(rules.lengths))
    listed = {v: rules.of(v) for v in verdicts}
    rates = {v: min(0.5, max(1, len(keys)) / (math.sqrt(2) * universe)) for v, keys in listed.items()}
    bound = HARD_BOUND + 10 * sum(map(len, listed.values()))
    while True:
        first = {v: Bloom(keys, rates[v], 0) for v, keys in listed.items() if keys}

        def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = set()
                for url in set(batch.column("url").to_pylist()):
                    for key in map(str.encode, rules.keys(*split_url(url))):
                        hit |= {(v, key) for v, bloom in first.items() if key not in listed[v] and key in bloom}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v for v, _ in hit], pa.string()), pa.array([k for _, k in hit], pa.binary())], names=["v", "k"]
                )

        wrong = pages.select("url").mapInArrow(passing, "v string, k binary").distinct().limit(bound + 1).collect()
        if len(wrong) <= bound:
            break
        rates = {v: r / 16 for v, r in rates.items()}
    return {v: Cascade(listed[v], first[v], {bytes(r.k) for r in wrong if r.v == v}) for v in first}


def judge(
    pages: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow", verdicts: tuple[str, ...] = ("block", "allow")
) -> DataFrame:
    """page_id, host, path, rule and verdict of every page; rules are (verdict, host, path)."""
    table = Rules(rules)
    cascades = build_cascades(pages, table, verdicts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url in batch.column("url").to_pylist():
                host, path = split_url(url)
                rule, verdict = None, default
                for key in table.keys(host, path):
                    encoded = key.encode()
                    found = next((v for v, c in cascades.items() if encoded in c), None)
                    if found:
                        rule, verdict = key, found
                        break
                rows.append((host, path, rule, verdict))
            columns = [pa.array([r[i] for r in rows], pa.string()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id").cast(pa.int64()), *columns], names=["page_id", "host", "path", "rule", "verdict"])

    return pages.select("page_id", F.col("url").cast("string")).mapInArrow(
        run, "page_id long, host string, path string, rule string, verdict string"
    )

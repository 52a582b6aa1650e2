"""Secret scans against the re module for every kind, states that last over many lanes, and time in proportion to the bytes."""
import random
import re
import time

import pytest

from creditecho.llm import secret_scan

PATTERNS = {
    "assign": (re.compile(r"""((?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 12),
    "access": (re.compile("(AKIA)([A-Z0-9]+)"), 14),
    "hex": (re.compile("()([0-9a-f]+)"), 16),
    "github": (re.compile("(gh[pousr]_)([A-Za-z0-9]+)"), 30),
    "slack": (re.compile("(xox[abprs]-)([A-Za-z0-9-]+)"), 20),
    "jwt": (re.compile("(eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.])([A-Za-z0-9_-]+)"), 10),
    "pem": (re.compile("(-----BEGIN [A-Z ]*PRIVATE KEY-----)([A-Za-z0-9+/=\n\r]+)"), 16),
}
BITS = [
    "token", "secret=", "api_key", " ", "'", ":", "=", "abcdef0123456789", "AKIA", "ABCDEFGH12345678", "é", "\n", ".", "-", "_", "password = ",
    "ghp_", "gho_", "xoxb-", "xoxp-12", "eyJ", "eyJab.", "eyJhbGciOi.eyJzdWIiOi.", "0123456789ab", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "A" * 31, "\U0001F600",
]


def wanted(text):
    kinds = list(PATTERNS)
    rows = [(m.start(), k, m.end()) for k, (p, least) in enumerate(PATTERNS.values()) for m in p.finditer(text) if len(m[2]) >= least]
    return [(kinds[k], a, b) for a, k, b in sorted(rows)]


def test_every_kind_equals_the_regex():
    pick = random.Random(3)
    rows = ["".join(pick.choice(BITS) for _ in range(pick.randint(0, 40))) for _ in range(6000)] + [""]
    got = secret_scan.Scanner().spans([r.encode() for r in rows])
    assert got == [wanted(r) for r in rows]
    assert {s[0] for spans in got for s in spans} == set(PATTERNS)


@pytest.mark.parametrize("lane, rounds", [(8, 0), (16, 1), (64, 3)])
def test_states_that_last_over_many_lanes(monkeypatch, lane, rounds):
    monkeypatch.setattr(secret_scan, "LANE", lane)
    monkeypatch.setattr(secret_scan, "ROUNDS", rounds)
    pick = random.Random(lane)
    rows = ["".join(pick.choice(BITS) for _ in range(60)) for _ in range(40)]
    rows += ["-----BEGIN " + "A " * 200 + "PRIVATE KEY-----" + "ab" * 9, "eyJ" * 300 + ".eyJx.0123456789", "f" * 500 + " token: " + " " * 300 + "'" + "f" * 12]
    assert secret_scan.Scanner().spans([r.encode() for r in rows]) == [wanted(r) for r in rows]


def test_no_match_crosses_documents():
    parts = [b"-----BEGIN PRIVATE KEY-----", b"ABCDEFGHABCDEFGHABCDEFGH", b"token=", b"abcdefghijklmnop", b"", b"01234567", b"89abcdef"]
    assert secret_scan.Scanner().spans(parts) == [[] for _ in parts]
    assert secret_scan.Scanner().spans([]) == []


def test_an_ambiguous_tail_is_read_once():
    """After each short match the rule reads on to the end of the text in vain; that reading is not repeated."""
    scanner = secret_scan.Scanner((secret_scan.Rule("tail", "(?:a|a[ab]*c)", "x", 0), secret_scan.Rule("one", "", "z", 1)))
    walk = secret_scan.Walk("a|a*b")
    failed, at, text = set(), 0, b"a" * 3000
    data = text.translate(walk.classes)
    while at < len(text):
        at = walk.longest(data, at, len(data), failed)
    assert len(failed) <= len(text) * len(walk.final)
    assert scanner.spans([b"abacx zz"]) == [[("tail", 0, 5), ("one", 6, 8)]]


def test_time_follows_the_bytes():
    scanner, taken = secret_scan.Scanner(), []
    for n in (100_000, 800_000):
        text = b"eyJ" * n + b".eyJdef.0123456789ab end"
        start = time.perf_counter()
        assert scanner.spans([text]) == [[("jwt", 0, len(text) - 4)]]
        taken.append(time.perf_counter() - start)
    assert taken[1] < 40 * taken[0]  # eight times the bytes; the square would be 64

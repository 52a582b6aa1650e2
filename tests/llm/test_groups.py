"""Runs of documents are cut without holding the texts of a whole Arrow batch, and a task returns what it freed."""
from __future__ import annotations

import pyarrow as pa

from creditecho.llm import textbatch


def test_only_one_run_is_held_and_memory_is_given_back(monkeypatch):
    texts = ["äb" * 40, None, "", "c" * 300] * 25
    seen, calls, whole = [], [], textbatch.byte_lists
    monkeypatch.setattr(textbatch, "byte_lists", lambda column: seen.append(len(column)) or whole(column))
    monkeypatch.setattr(textbatch, "give_back", lambda: calls.append(1), raising=False)
    batch = pa.RecordBatch.from_arrays([pa.array(range(100)), pa.array(texts)], names=["doc_id", "text"])
    runs = list(textbatch.groups(iter([batch]), size=1000))
    assert max(seen) <= 12 and calls == [1]
    assert [p for _, parts in runs for p in parts] == [(t or "").encode() for t in texts]
    assert [i for part, _ in runs for i in part.column("doc_id").to_pylist()] == list(range(100))
    assert all(len(b"\n".join(parts)) <= 1001 for _, parts in runs)

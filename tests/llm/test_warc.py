"""The archive writer against a plain re-computation, its determinism, its commit and its checks on reading."""
import gzip
import hashlib

import numpy as np
import pytest

from creditecho.llm import warc

SCHEMA = "page_id long, url string, html string, row long, shard string"
BIG = "x" * 1200


def expected(rows):
    best = {}
    for i, (key, url, html) in enumerate(rows):
        b = (html or "").encode()
        place = (key is not None, key or 0, url is not None, url or "", i)
        if len(b) >= 1000 and (b not in best or place > best[b][0]):
            best[b] = (place, key, i)
    size = {b: sum((h or "").encode() == b for _, _, h in rows) for b in best}
    out = []
    for i, (key, url, html) in enumerate(rows):
        b = (html or "").encode()
        revisit = size.get(b, 1) > 1 and best[b][2] != i
        out.append((key, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", best[b][1] if revisit else None))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "s") for r in rows], SCHEMA).repartition(3)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


ROWS = [
    (1, "http://a/ \r\nX: y", BIG), (2, None, BIG), (3, "http://c/", BIG + "é"), (4, "http://d/", None), (5, "http://e/", ""), (6, "u", "small"), (7, "u", "small"),
    (8, "u", "y" * 999), (9, "u", "y" * 999), (10, "u", "z" * 1000), (11, "u", "z" * 1000), (11, "u", "z" * 1000), (11, "v", "z" * 1000), (None, "n", BIG), (None, "n", "q" * 2000),
    (None, None, "q" * 2000), (12, "long", "é\r\n\r\n" * 200_000),
]


def test_equals_plain_computation(spark, tmp_path):
    out = warc.write(frame(spark, ROWS), str(tmp_path / "a"), shard_bytes=100_000, roll_bytes=2_000)
    files = out.collect()
    assert len(files) > 3 and len({f.shard for f in files}) > 1
    assert all(f.bytes < 2_000 + 20_000 for f in files)
    back = warc.read(spark, str(tmp_path / "a"), payload=True)
    assert got(back) == expected(ROWS)
    whole = {r.page_id: bytes(r.payload) for r in back.filter("record_type = 'response' and page_id is not null").collect()}
    assert whole[12] == ("é\r\n\r\n" * 200_000).encode() and whole[4] == b""
    assert back.filter("page_id = 1").first().target_uri == "http://a/%20%0D%0AX:%20y"
    assert sorted(p.name for p in (tmp_path / "a").iterdir() if p.name.endswith(".gz")) == sorted(f.name for f in files)
    assert not (tmp_path / "a" / "_temporary").exists()


def test_links_and_order(spark, tmp_path):
    files = warc.write(frame(spark, ROWS), f"file://{tmp_path}/a", shard_bytes=100_000, roll_bytes=2_000).orderBy("shard", "seq").collect()
    back = warc.read(spark, str(tmp_path / "a")).collect()
    ids = {r.record_id: r.page_id for r in back}
    assert len(ids) == len(back) == len(ROWS)
    assert all(ids[r.refers_to_id] == r.refers_to for r in back if r.record_type == "revisit")
    keys = []
    for f in files:
        text = gzip.decompress((tmp_path / "a" / f.name).read_bytes())
        keys += [int(x.split(b": ")[1]) for x in text.split(b"\r\n") if x.startswith(b"X-Record-Key")]
    assert keys == sorted(keys)


def test_equal_tables_give_equal_files(spark, tmp_path):
    rows = [(i % 50, f"http://h/{i}", chr(97 + i % 5) * 1500 + str(i // 10)) for i in range(300)]
    once = warc.write(frame(spark, rows), str(tmp_path / "a"), shard_bytes=50_000, roll_bytes=3_000)
    twice = warc.write(frame(spark, rows[::-1]).repartition(7), str(tmp_path / "b"), shard_bytes=50_000, roll_bytes=3_000)
    assert {(r.name, r.sha256) for r in once.collect()} == {(r.name, r.sha256) for r in twice.collect()}
    assert got(warc.read(spark, str(tmp_path / "a"))) == expected(rows)


def test_hot_key_and_hot_payload(spark, tmp_path):
    rows = [(5 if i % 3 else i, f"u{i}", BIG if i % 2 else BIG + str(i)) for i in range(3000)]
    files = warc.write(frame(spark, rows), str(tmp_path / "a"), shard_bytes=100_000, roll_bytes=1 << 20)
    assert files.count() > 20 and max(r.records for r in files.collect()) < 400
    assert got(warc.read(spark, str(tmp_path / "a"))) == expected(rows)


def test_shard_limits():
    keys, limits = np.array([1, 5, 6, 9]), np.array([5, 5, 5, 9])
    assert warc.shard_of(keys, np.array([0, 4, 0, 0]), limits).tolist() == [0, 2, 3, 4]
    assert warc.shard_of(keys, np.array([0, 0, 0, 0]), np.zeros(0, np.int64)).tolist() == [0] * 4


def test_empty_table(spark, tmp_path):
    assert warc.write(frame(spark, ROWS).filter("page_id = -1"), str(tmp_path / "a")).count() == 0
    assert warc.read(spark, str(tmp_path / "a")).count() == 0


def test_commit_twice_and_damage(spark, tmp_path):
    folder = str(tmp_path / "a")
    files = warc.write(frame(spark, ROWS), folder)
    warc.commit(files.selectExpr("name", "concat('_temporary/', name) as temporary", "bytes"), folder)  # a repeated task
    with pytest.raises(ValueError):
        warc.write(frame(spark, ROWS), folder)
    path = tmp_path / "a" / files.first().name
    data = bytearray(path.read_bytes())
    path.write_bytes(bytes(data[:-5]))
    with pytest.raises(Exception):
        warc.read(spark, folder).count()
    with pytest.raises(Exception):
        warc.commit(files.selectExpr("name", "concat('_temporary/', name) as temporary", "bytes"), folder)


def test_members_and_parse():
    record = warc.member([("WARC-Type", "response"), ("WARC-Block-Digest", warc.sha1_label(hashlib.sha1(b"ab").digest())), ("WARC-Record-ID", "<r>")], b"ab")
    data = record * 3
    assert [warc.parse(r)[1] for r in warc.members(data[i: i + 7] for i in range(0, len(data), 7))] == [b"ab"] * 3
    with pytest.raises(ValueError):
        warc.parse(next(warc.members([record])).replace(b"ab\r\n\r\n", b"ac\r\n\r\n"))

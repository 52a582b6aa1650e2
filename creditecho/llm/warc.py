"""A deterministic, sharded WARC writer and the reader of its archives.

Digests come first: one narrow pass finds, among equal payloads of ``min_revisit`` bytes or more, the one that stays a ``response``; the
others become ``revisit`` records without their payload. Then every record travels once, to the shard of its key range, is sorted there and
appended as a gzip member of its own; a file is closed once its compressed size reaches ``roll_bytes``. Headers and digests are made anew
from the payload. Files get temporary names that carry the attempt; a task's list of files counts only if the task ends, so lost or
repeated attempts leave nothing behind that is read. Listed files are renamed by a second job, which may run twice, and the manifest is
written last: without it there is no archive.

Shards: range limits come from a hash-chosen sample of about ``SAMPLE`` keys a shard, so equal tables give equal shards and equal
bytes, however they are partitioned (only of rows equal in every value on a key with several shards may another number lie in each). The sample grows by 16 numbers a shard; at 100 TB ``shard_bytes`` of 1 GB makes 1.6 million. A key that holds several limits owns
several shards and is dealt over them by a hash. Payloads that very many records share are joined by broadcast: a group is hot from 1/2,000
of all rows on, so there are at most 2,000.

Defined cases: a null payload is empty; a null key is written without a key header, ordered last, and read back as null; among equal payloads
the largest key (nulls least, then url, nulls least) is the response, so among repeated rows one is; if it has no key, ``refers_to`` is
null. A null url has no target header. Spaces and control characters of a url are percent-encoded, so no url can end a header. An empty
table gives an archive without files. Very long payloads stream through one record at a time. Other columns are ignored.
"""
from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditecho.llm.store import stored

SAMPLE = 16
HOT_GROUPS = 2000
LAST = 2**63 - 1  # a null key is ordered behind all others
MANIFEST = "shard long, seq long, name string, temporary string, records long, bytes long, sha256 string"
RECORDS = "page_id long, target_uri string, record_type string, record_id string, payload_bytes long, payload_digest string, refers_to long, refers_to_id string"
# Fixed value: the profile that the WARC standard names for a revisit of an equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and plain path of a folder given as URI or local path."""
    if re.match(r"^file:/(?!//)", uri):
        uri = "file:///" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def safe_uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record_id(seed: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(seed.encode()).digest())}>"


def payload_record_id(sha1: bytes, size: int) -> str:
    """The one response of a payload is known to its revisits by the payload alone."""
    return record_id(f"payload:{sha1.hex()}:{size}")


def sha1_label(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member; the gzip header holds no time, so equal records are equal bytes."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    zip_ = zlib.compressobj(6, zlib.DEFLATED, 31)
    return zip_.compress(head.encode()) + zip_.compress(block) + zip_.compress(b"\r\n\r\n") + zip_.flush()


class Roller:
    """Appends records of one shard to files under temporary names and closes each at ``roll_bytes``."""

    def __init__(self, fs: pafs.FileSystem, root: str, prefix: str, shard: int, attempt: str, roll_bytes: int, date: str):
        self.fs, self.root, self.prefix, self.shard, self.attempt = fs, root, prefix, shard, attempt
        self.roll_bytes, self.date = roll_bytes, date
        self.seq, self.out, self.done = 0, None, []

    def _open(self) -> None:
        self.name = f"{self.prefix}-{self.shard:06d}-{self.seq:05d}.warc.gz"
        self.temporary = f"_temporary/{self.attempt}-{self.name}"
        self.out = self.fs.open_output_stream(f"{self.root}/{self.temporary}", compression=None)
        self.size, self.records, self.sum = 0, 0, hashlib.sha256()
        block = b"software: creditecho\r\nformat: WARC File Format 1.1\r\n"
        self._put(member([
            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(f"info:{self.name}")), ("WARC-Date", self.date),
            ("WARC-Filename", self.name), ("WARC-Block-Digest", sha1_label(hashlib.sha1(block).digest())),
            ("Content-Type", "application/warc-fields"),
        ], block))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sum.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.shard, self.seq, self.name, self.temporary, self.records, self.size, self.sum.hexdigest()))
            self.out, self.seq = None, self.seq + 1

    def add(self, key: int | None, url: str | None, payload: bytes, digest: bytes, group: dict | None, first: bool) -> None:
        """``group``: key and url of the response of this payload, if it is a shared one; ``first``: this record is that response."""
        if self.out is None:
            self._open()
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        revisit = group is not None and not first
        block = http if revisit else http + payload
        own = payload_record_id(digest, len(payload)) if first else record_id(f"record:{self.name}:{self.records}")
        headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", own), ("WARC-Date", self.date)]
        if url is not None:
            headers.append(("WARC-Target-URI", safe_uri(url)))
        if key is not None:
            headers.append(("X-Record-Key", str(key)))
        headers += [("WARC-Payload-Digest", sha1_label(digest)), ("WARC-Block-Digest", sha1_label(hashlib.sha1(block).digest()))]
        if revisit:
            headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", payload_record_id(digest, len(payload))), ("WARC-Refers-To-Date", self.date)]
            if group["url"] is not None:
                headers.append(("WARC-Refers-To-Target-URI", safe_uri(group["url"])))
            if group["key"] is not None:
                headers.append(("X-Refers-To-Key", str(group["key"])))
        headers.append(("Content-Type", "application/http; msgtype=response"))
        self._put(member(headers, block))
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()


def shard_limits(rows: DataFrame, shard_bytes: int) -> np.ndarray:
    """Sorted keys where a new shard begins; a key may stand there more than once."""
    n, total = rows.agg(F.count("*"), F.sum("size")).first()
    shards = max(1, -(-(total or 0) // shard_bytes))
    one_in = max(1, n // (SAMPLE * shards))
    chosen = rows.filter(F.pmod(F.xxhash64("key", "sha1"), F.lit(one_in)) == 0)
    sample = chosen.select("key", (F.col("size") + 512).alias("w")).toArrow()
    key, weight = (np.asarray(sample.column(c), np.int64) for c in ("key", "w"))
    order = np.lexsort((weight, key))
    total_to = np.cumsum(weight[order])
    if not len(key):
        return np.zeros(0, np.int64)
    at = np.searchsorted(total_to, total_to[-1] * np.arange(1, shards) / shards)
    return key[order][np.minimum(at, len(key) - 1)]


def shard_of(key: np.ndarray, spread: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Shard of each key; a key that is a limit several times is dealt over its shards by ``spread``."""
    low, high = np.searchsorted(limits, key, "left"), np.searchsorted(limits, key, "right")
    return np.where(high - low > 1, low + 1 + spread % np.maximum(high - low, 1), high)


def shared_payloads(rows: DataFrame, min_revisit: int) -> DataFrame:
    """(row, key, url, sha1, group): for each row of a payload that others share, the key, url and row of the response."""
    large = rows.filter(F.col("size") >= min_revisit)
    same = ["sha1", "size", "check"]
    group = F.max(F.struct("page_id", "url", "row")).alias("group")
    groups = stored(large.groupBy(*same).agg(F.count("*").alias("c"), group).filter("c > 1"), "warc-groups")
    limit = rows.count() // HOT_GROUPS + 1
    named = groups.select(*(F.col(c).alias(f"g_{c}") for c in same), "c", "group")
    on = [F.col(c) == F.col(f"g_{c}") for c in same]
    kept = ["row", "key", "url", "sha1", "group"]
    hot, rest = F.broadcast(named.filter(F.col("c") >= limit)), named.filter(F.col("c") < limit)
    return large.join(hot, on).select(*kept).unionByName(large.join(rest, on).select(*kept))


def write(
    pages: DataFrame, folder: str, *, key: str = "page_id", url: str = "url", payload: str = "html", prefix: str = "pages",
    shard_bytes: int = 32 << 20, roll_bytes: int = 8 << 20, min_revisit: int = 1000, date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Writes one record per row into ``folder`` and returns the manifest (one row per file). ``date`` is written into every record."""
    spark = pages.sparkSession
    fs, root = open_folder(folder)
    if fs.get_file_info(f"{root}/manifest").type != pafs.FileType.NotFound:
        raise ValueError(f"{folder} holds an archive already")
    fs.create_dir(f"{root}/_temporary", recursive=True)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = stored(
        pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload")).select(
            "*", F.coalesce("page_id", F.lit(LAST)).alias("key"), F.sha1("payload").alias("sha1"), F.xxhash64("payload").alias("check"),
            F.octet_length("payload").cast("long").alias("size"), F.monotonically_increasing_id().alias("row"),
        ), "warc-rows", compression="zstd",
    )
    limits = shard_limits(rows, shard_bytes)
    shards = len(limits) + 1

    @F.pandas_udf("long")
    def shard(keys, spread):
        import pandas as pd

        return pd.Series(shard_of(keys.to_numpy(), spread.to_numpy(), limits))

    placed = shard(F.col("key"), F.pmod(F.xxhash64("url", "sha1", "row"), F.lit(1 << 30))).alias("shard")
    none = F.lit(None)
    records = rows.select(placed, "key", "row", F.lit(1).alias("kind"), "page_id", "url", "sha1", "payload", none.cast("struct<page_id:long,url:string,row:long>").alias("group"))
    verdicts = shared_payloads(rows, min_revisit).select(
        placed, "key", "row", F.lit(0).alias("kind"), none.cast("long").alias("page_id"), "url", "sha1",
        none.cast("binary").alias("payload"), "group",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        attempt, at, known, group = uuid.uuid4().hex, None, None, None
        done: list[tuple] = []
        for batch in batches:
            for r in (x for part in range(0, batch.num_rows, 256) for x in batch.slice(part, 256).to_pylist()):
                if at is None or at.shard != r["shard"]:
                    if at is not None:
                        at.close()
                        done += at.done
                    at = Roller(fs, root, prefix, r["shard"], attempt, roll_bytes, date)
                if r["kind"] == 0:
                    known, group = r["row"], r["group"]
                    continue
                shared = {"key": group["page_id"], "url": group["url"]} if known == r["row"] else None
                first = shared is not None and group["row"] == r["row"]
                at.add(r["page_id"], r["url"], r["payload"], bytes.fromhex(r["sha1"]), shared, first)
        if at is not None:
            at.close()
            done += at.done
        names = [f.split()[0] for f in MANIFEST.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string()}
        columns = list(zip(*done)) if done else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, kinds[f.split()[1]]) for c, f in zip(columns, MANIFEST.split(", "))], names=names)

    # A row's verdict is sorted right before the row. Inside a shard the order follows from the values; only rows equal in all of them keep their order in the table.
    sorted_ = records.unionByName(verdicts).repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "key", "url", "sha1", "row", "kind")
    written = stored(sorted_.mapInArrow(run, MANIFEST), "warc-files")
    commit(written, folder)
    written.drop("temporary").orderBy("shard", "seq").write.parquet(f"{folder.rstrip('/')}/manifest")
    fs.delete_dir(f"{root}/_temporary")
    return manifest(spark, folder)


def commit(written: DataFrame, folder: str) -> None:
    """Gives listed files their final names. A repeated task finds its files renamed already; a lost one is run again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        for batch in batches:
            for r in batch.to_pylist():
                final = f"{root}/{r['name']}"
                try:
                    fs.move(f"{root}/{r['temporary']}", final)
                except OSError:
                    if fs.get_file_info(final).size != r["bytes"]:
                        raise
            yield batch.select(["bytes"])

    files, total = written.select("name", "temporary", "bytes").mapInArrow(run, "bytes long").agg(F.count("*"), F.sum("bytes")).first()
    if (files, total) != tuple(written.agg(F.count("*"), F.sum("bytes")).first()):
        raise RuntimeError(f"{folder}: not all files were committed")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/manifest")


def members(stream: Iterator[bytes]) -> Iterator[bytes]:
    """The gzip members of a byte stream, each unpacked."""
    unzip, parts, fed = zlib.decompressobj(31), [], False
    for data in stream:
        while data:
            parts.append(unzip.decompress(data))
            fed = True
            data = unzip.unused_data
            if unzip.eof:
                yield b"".join(parts)
                unzip, parts, fed = zlib.decompressobj(31), [], False
            else:
                break
    if fed:
        raise ValueError("the last record is cut off")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record; length and block digest must fit."""
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    size = int(headers["content-length"])
    block = rest[:size]
    if not first.startswith("WARC/") or len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    if sha1_label(hashlib.sha1(block).digest()) != headers["warc-block-digest"]:
        raise ValueError(f"block digest of {headers['warc-record-id']} does not fit")
    return headers, block


def read(spark: SparkSession, folder: str, payload: bool = False) -> DataFrame:
    """One row per response or revisit of the listed files, checked against digests, sizes and the manifest. A revisit's payload is null."""
    files = manifest(spark, folder).select("name", "records", "bytes", "sha256")
    schema = RECORDS + (", payload binary" if payload else "")
    fields = [x.split() for x in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def rows_of(fs: pafs.FileSystem, root: str, file: dict) -> Iterator[tuple]:
        seen, size = hashlib.sha256(), 0

        def blocks(stream) -> Iterator[bytes]:
            nonlocal size
            while data := stream.read(1 << 20):
                seen.update(data)
                size += len(data)
                yield data

        count = 0
        with fs.open_input_stream(f"{root}/{file['name']}", compression=None) as stream:
            for record in members(blocks(stream)):
                headers, block = parse(record)
                if headers["warc-type"] == "warcinfo":
                    continue
                count += 1
                http, _, body = block.partition(b"\r\n\r\n")
                length = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])
                digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:"))
                if headers["warc-type"] == "response" and (len(body) != length or hashlib.sha1(body).digest() != digest):
                    raise ValueError(f"payload of {headers['warc-record-id']} does not fit")
                key, refers = headers.get("x-record-key"), headers.get("x-refers-to-key")
                row = (
                    None if key is None else int(key), headers.get("warc-target-uri"), headers["warc-type"], headers["warc-record-id"], length, digest.hex(),
                    None if refers is None else int(refers), headers.get("warc-refers-to"), body if headers["warc-type"] == "response" else None,
                )
                yield row[: len(fields)]
        if (count, size, seen.hexdigest()) != (file["records"], file["bytes"], file["sha256"]):
            raise ValueError(f"{file['name']} is not the file of the manifest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*held), fields)], names=[f for f, _ in fields])
            held.clear()
            return out

        for batch in batches:
            for file in batch.to_pylist():
                weight = 0
                for row in rows_of(fs, root, file):
                    held.append(row)
                    weight += 256 + (row[4] if payload else 0)
                    if weight > 4 << 20:
                        yield flush()
                        weight = 0
                if held:
                    yield flush()

    return files.repartition(max(1, files.count())).mapInArrow(run, schema)

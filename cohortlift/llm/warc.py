"""WARC archives: a deterministic sharded writer with revisit records, and its reader."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlift.llm.common import columns, own_folder, stored
from cohortlift.operators.running import running_totals

#: Fixed values of the format.
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{page_id}/{payload_digest}')}>"


def payloads(pages: DataFrame) -> DataFrame:
    """pages -> (page_id, url, payload, sha), one row each; null html is an empty payload."""
    rows = columns(pages, page_id="page_id", url="url", html="html").select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    return rows.withColumn("sha", F.sha2("payload", 256))


def rulings(slim: DataFrame) -> DataFrame:
    """(page_id, sha, first_id) of the pages that repeat the payload of another. Of equal payloads the smallest page_id answers (rows that share it
    all do), the others revisit it; payloads whose ids are all null are all responses. Only ids and hashes are shuffled, never payloads, and the
    answers are stored before the join, so that a payload which many pages share is split there."""
    firsts = stored(slim.groupBy("sha").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first_id IS NOT NULL"))
    return slim.select("page_id", "sha").join(firsts.drop("n"), "sha").where("NOT page_id <=> first_id").distinct()


def _key() -> Column:
    """A text that sorts as (page_id, sha) does, null ids first."""
    number = F.lpad(F.hex(F.col("page_id").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.concat(F.coalesce(F.concat(F.lit("1"), number), F.lit("0" * 17)), F.substring("sha", 1, 16))


def shard_starts(slim: DataFrame, shard_bytes: int) -> np.ndarray:
    """The first key of each shard: exact quantiles of the bytes in the order of (page_id, sha), so neither the spread of the ids nor the layout
    of the table tells where shards are cut. A shard has less than shard_bytes before its last key. Running totals go over ranges of rows side by
    side; one key of 33 bytes a shard reaches the driver and the tasks, 53 MB for 100 TB in shards of 64 MB."""
    keys = slim.groupBy("page_id", "sha").agg(F.sum(F.col("bytes") + 600).alias("n"))
    upto = running_totals(keys, ["page_id", "sha"], {"upto": "n"})
    firsts = upto.groupBy(F.floor((F.col("upto") - F.col("n")) / shard_bytes)).agg(F.min(_key()).alias("first")).select("first")
    return np.sort(np.array([r["first"] for r in firsts.toLocalIterator()], "S33"))


def sharding(starts: np.ndarray) -> Callable[[DataFrame], DataFrame]:
    """What adds shard, the last one that starts at the key of a row or before it, to rows with page_id and sha."""

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts[1:], keys.to_numpy().astype("S33"), side="right").astype(np.int32))

    return lambda rows: rows.withColumn("shard", place(_key()))


def _record(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool, date: str) -> bytes:
    payload_digest = digest(payload)
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, payload_digest)), ("WARC-Date", date),
        ("WARC-Target-URI", quote(url or "", safe="!#$%&'()*+,/:;=?@[]~") or None), ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(first, payload_digest) if revisit else None), ("X-Page-Id", page_id), ("X-Payload-Length", len(payload)),
        ("X-Refers-To-Page", first if revisit else None), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    lines = [VERSION, *(f"{k}: {v}" for k, v in fields if v is not None), "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", 6, mtime=0)


class _Rolled:
    """The files of one shard, one after another, each under a temporary name of this attempt."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.fs, self.path = pafs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        self.attempt = f"{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}" if context else uuid.uuid4().hex
        self.shard, self.roll, self.n, self.out, self.done = shard, roll_bytes, 0, None, []

    def add(self, member: bytes) -> None:
        if self.out is not None and self.bytes + len(member) > self.roll:
            self.close()
        if self.out is None:
            self.name = f"{self.shard:06d}-{self.n:05d}.warc.gz"
            self.temporary = f"tmp-{self.attempt}-{self.name}"
            self.out, self.bytes, self.records, self.sha = self.fs.open_output_stream(f"{self.path}/{self.temporary}", compression=None), 0, 0, hashlib.sha256()
            self.n += 1
        self.out.write(member)
        self.sha.update(member)
        self.bytes += len(member)
        self.records += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.temporary, self.name, self.bytes, self.records, self.sha.hexdigest()))
            self.out = None


def write(pages: DataFrame, folder: str, least: int = 0, shard_bytes: int = 64 << 20, roll_bytes: int = 64 << 20, date: str = "2024-01-01T00:00:00Z") -> list[dict]:
    """Writes pages as .warc.gz files under `folder` (a URI that all executors reach) and returns the manifest.

    Rows are sorted by page_id (null first), payload hash and url, and so are the shards, a task each; rows equal in page_id and payload share one,
    through which they stream. A file is closed before its compressed size passes roll_bytes (a larger record has its own). A task writes under temporary names and reports them when it ends; only what
    a finished task reported gets its final name and its line in manifest.json, which is put in place last. Null html is an empty payload, a
    null url has no target, repeated rows are records each; no rows: a manifest of no files. Nothing in a record depends on time or place.
    """
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    rows = payloads(pages)
    slim = stored(rows.select("page_id", "sha", F.octet_length("payload").alias("bytes")))
    starts = shard_starts(slim, shard_bytes)
    placed = sharding(starts)
    # a ruling is a row of its own that sorts right before the records of its page and payload; so payloads are shuffled once
    ruled = placed(rulings(slim)).select("shard", "page_id", "sha", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "first_id")
    kept = placed(rows).select("shard", "page_id", "sha", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("long").alias("first_id"))
    ordered = ruled.unionByName(kept).repartitionById(max(1, len(starts)), "shard").sortWithinPartitions("shard", "page_id", "sha", "kind", "url")

    ordered_columns = ordered.columns

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ruling, done = None, None, []
        for batch in batches:
            for shard, page_id, sha, kind, url, payload, first in zip(*(batch.column(c) for c in ordered_columns), strict=True):
                key = (page_id.as_py(), sha.as_py())
                if kind.as_py() == 0:
                    ruling = (key, first.as_py())
                    continue
                if current is None or current.shard != shard.as_py():
                    if current is not None:
                        current.close()
                        done += current.done
                    current = _Rolled(folder, shard.as_py(), roll_bytes)
                data = payload.as_py()
                revisit = ruling is not None and ruling[0] == key and len(data) >= least
                current.add(_record(key[0], url.as_py(), data, ruling[1] if revisit else None, revisit, date))
        if current is not None:
            current.close()
            done += current.done
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["temporary", "name", "bytes", "records", "sha256"])

    files = ordered.mapInArrow(store, "temporary string, name string, bytes long, records long, sha256 string").collect()
    manifest = sorted((f.asDict() for f in files), key=lambda f: f["name"])
    for f in manifest:
        fs.move(f"{path}/{f.pop('temporary')}", f"{path}/{f['name']}")
    with fs.open_output_stream(f"{path}/tmp-manifest.json") as out:
        out.write(json.dumps(manifest, indent=0).encode())
    fs.move(f"{path}/tmp-manifest.json", f"{path}/manifest.json")
    for left in fs.get_file_info(pafs.FileSelector(path)):
        if left.base_name.startswith("tmp-"):
            fs.delete_file(left.path)
    return manifest


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of a decompressed stream, one by one."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(": ")
            headers[name.lower()] = value
        yield headers, stream.read(int(headers["content-length"]))


def _row(headers: dict[str, str], block: bytes) -> tuple:
    kind = headers["warc-type"]
    payload = block.partition(b"\r\n\r\n")[2]
    told = headers["warc-payload-digest"].removeprefix("sha1:")
    if headers["warc-block-digest"] != f"sha1:{digest(block)}" or kind == "response" and told != digest(payload):
        raise ValueError(f"{headers['warc-record-id']} does not match its digest")
    number = lambda name: int(headers[name]) if name in headers else None
    return number("x-page-id"), len(payload) if kind == "response" else number("x-payload-length"), told, kind, number("x-refers-to-page")


def read_back(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all files in the manifest as (page_id, payload_bytes, payload_digest, record_type, refers_to); digests are checked. A task
    reads whole files record by record, and one record is all it holds."""
    fs, path = pafs.FileSystem.from_uri(folder)
    with fs.open_input_stream(f"{path}/manifest.json") as f:
        names = [x["name"] for x in json.loads(f.read())]

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with fs.open_input_stream(f"{path}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    rows = []
                    for headers, block in records(stream):
                        rows.append(_row(headers, block))
                        if len(rows) == 5000:
                            yield _rows(rows)
                            rows = []
                    if rows:
                        yield _rows(rows)

    files = spark.createDataFrame([(n,) for n in names], "name string")
    return files.repartition(max(1, len(names)), "name").mapInArrow(load, SCHEMA)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in SCHEMA.split(", ")])


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """pages written to a new folder beside the checkpoints, which goes when the driver ends, and read back."""
    folder = own_folder(pages.sparkSession, "warc")
    write(pages, folder, least)
    return read_back(pages.sparkSession, folder)

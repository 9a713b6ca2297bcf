"""Operator 2, WARC: a deterministic sharded writer, and a reader.

Writer:

1. digests of all payloads; the largest page_id of each repeated payload
   is its response, the others become revisits;
2. shard limits from exact running sums of payload bytes over the sorted
   page_ids, so the same pages always give the same shards; a page_id (or
   null) whose rows fill several shards is split over them by payload;
3. one shuffle of the payloads by shard, sorted by page_id; the links of
   revisits travel in the same shuffle as small rows sorted just before
   their page, so payloads are never joined;
4. each task streams its shard into gzip members, regenerates headers and
   digests, and rolls to a new file by compressed size, under names that
   belong to the attempt alone;
5. the names of the attempts that succeeded are committed by Spark as a
   manifest table, and the files in it are renamed to their final names
   (a rename that already happened is left).  Files of lost or repeated
   attempts are never in the manifest.

Reader: the manifest's files are read by tasks, member by member.

Defined results: a null payload is empty; a null page_id sorts first and
can be a response only if no page of equal payload has an id (then the
first record is, and the revisits refer to null); rows with the same
page_id and payload: one is the response, the others revisit it; a null
url is written as a name made of the page_id; extra columns are ignored;
an empty table gives an archive without files.  The driver and the writing
tasks hold 24 bytes a shard; rows equal in page_id and payload are written
by one task.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop, written

ROLL_BYTES = 16 << 20
SHARD_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder: local, or any store that pyarrow knows by URI."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def shard_starts(sizes: DataFrame, shard_bytes: int = SHARD_BYTES) -> list[tuple[int, int, int]]:
    """(first id, shard, parts) rows, by id, from (id, bytes) rows without null ids.

    An id begins in the shard that the bytes before it fill up to; the ids
    that begin in one shard stay together.  An id that reaches over
    ``parts`` > 1 whole shards has a row of its own and may be split over
    that many.  Byte sums run over the ids sorted by Spark, in a fixed
    number of jobs, so that the same rows give the same shards however
    they are partitioned; at most two rows a shard come back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("bytes").to_numpy(zero_copy_only=False)
            ends = held + np.cumsum(n)
            if len(n):
                held = int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("bytes"), pa.array(ends - n), pa.array(np.full(len(n), task, np.int64))],
                ["id", "bytes", "at", "task"])

    ids = sizes.groupBy("id").agg(F.sum("bytes").alias("bytes")).repartitionByRange("id").sortWithinPartitions("id")
    held = written(ids.mapInArrow(run, "id long, bytes long, at long, task long"), "warc-sizes")
    before = Window.partitionBy(F.lit(0)).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    base = (held.groupBy("task").agg(F.sum("bytes").alias("n"))
            .select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    shard, after = F.expr(f"(base + at) div {shard_bytes}"), F.expr(f"(base + at + bytes) div {shard_bytes}")
    rows = (held.join(base, "task").select("id", shard.alias("shard"), F.greatest(after - shard, F.lit(1)).alias("parts"))
            .groupBy("shard").agg(F.min("id").alias("first"), F.max(F.struct("parts", "id")).alias("long")).collect())
    drop(held)
    starts = {r["first"]: (r["first"], r["shard"], 1) for r in rows}
    starts |= {r["long"].id: (r["long"].id, r["shard"], r["long"].parts) for r in rows if r["long"].parts > 1}
    return sorted(starts.values())


def _url(url: str | None, page_id: int | None) -> str:
    name = url if url is not None else f"urn:page:{page_id}"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", name)


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers: int | None, revisit: bool) -> bytes:
    """One WARC record.  A revisit keeps the HTTP header but not the payload."""
    digest = base32_sha1(payload)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, digest + ('/revisit' if revisit else ''))}",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {_url(url, page_id)}",
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers, digest)}"]
        if refers is not None:
            head.append(f"X-Refers-To-Page-ID: {refers}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member whose bytes depend on the data alone."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class _Roller:
    """Files of one shard: rolls by compressed size."""

    def __init__(self, folder: str, shard: int, roll: int) -> None:
        self.fs, self.path = open_folder(folder)
        self.shard, self.roll, self.number = shard, roll, 0
        self.attempt = uuid.uuid4().hex
        self.out = None

    def add(self, data: bytes) -> Iterator[tuple]:
        if self.out is not None and self.size + len(data) > self.roll:
            yield self.close()
        if self.out is None:
            self.temp = f"_tmp/{self.shard:06d}-{self.number:05d}-{self.attempt}"
            self.fs.create_dir(f"{self.path}/_tmp", recursive=True)
            self.out = self.fs.open_output_stream(f"{self.path}/{self.temp}", compression=None)
            self.size, self.records, self.sha = 0, 0, hashlib.sha1()
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)
        self.records += 1

    def close(self) -> tuple:
        self.out.close()
        self.out = None
        self.number += 1
        return (self.shard, self.number - 1, self.temp, f"part-{self.shard:06d}-{self.number - 1:05d}.warc.gz",
                self.records, self.size, self.sha.hexdigest())


MANIFEST = "shard long, number long, temp string, file string, records long, bytes long, sha1 string"


def write_archive(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES,
                  min_bytes: int = 0, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Write ``pages`` as WARC files to ``folder`` (shared by all executors); returns the manifest."""
    payload = F.coalesce(F.col(body).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).alias("url"), payload.alias("payload"))
    # digests once: narrow rows for links and histogram
    narrow = written(rows.select("id", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("bytes")),
                     "warc-narrow")
    repeated = written(narrow.where(F.col("bytes") >= min_bytes).groupBy("digest")
                       .agg(F.max("id").alias("refers"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-repeated")
    links = narrow.where(F.col("bytes") >= min_bytes).select("id", "digest").join(repeated, "digest")
    # the response's own copies too: all rows of that id and payload after the first are revisits
    links = links.distinct()
    place = F.coalesce("id", F.lit(-1 << 63))  # null ids sort first
    sizes = narrow.select(place.alias("id"), (F.col("bytes") + 512).alias("bytes"))
    first, shard, parts = np.array(shard_starts(sizes, shard_bytes) or [(0, 0, 1)], dtype=np.int64).T

    @F.pandas_udf("long")
    def shard_of(ids: pd.Series, payloads: pd.Series) -> pd.Series:
        ids = ids.to_numpy()
        at = np.searchsorted(first, ids, "right") - 1
        split = np.where(first[at] == ids, parts[at], 1)
        return pd.Series(shard[at] + payloads.to_numpy() % split)

    both = (rows.select("id", F.sha1("payload").alias("digest"), F.lit(1).alias("kind"), "url", "payload",
                        F.lit(None).cast("long").alias("refers"))
            .unionByName(links.select("id", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
                                      F.lit(None).cast("binary").alias("payload"), "refers"))
            .withColumn("shard", shard_of(place, F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"))))
    spread = (both.repartitionById(int((shard + parts).max()), F.col("shard").cast("int"))  # a shard is a task
              .sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "digest", "kind", F.col("url").asc_nulls_first()))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in MANIFEST.split(", ")]
        roller, link, used = None, None, None
        files: list[tuple] = []

        def out() -> pa.RecordBatch:
            cols = list(zip(*files, strict=True))
            files.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)

        for batch in batches:
            cols = {c: batch.column(c) for c in ("id", "digest", "kind", "url", "payload", "refers", "shard")}
            for i in range(batch.num_rows):
                row = {c: v[i].as_py() for c, v in cols.items()}
                if row["kind"] == 0:
                    link, used = (row["id"], row["digest"], row["refers"]), False
                    continue
                if roller is None or roller.shard != row["shard"]:
                    if roller is not None and roller.out is not None:
                        files.append(roller.close())
                    roller = _Roller(folder, row["shard"], roll_bytes)
                revisit, refers = False, None
                if link and link[:2] == (row["id"], row["digest"]):
                    refers = link[2]
                    revisit = refers != row["id"] or used  # the first row of the response's id is the response
                    used = True
                data = member(record(row["id"], row["url"], row["payload"], refers, revisit))
                files.extend(roller.add(data))
            if files:
                yield out()
        if roller is not None and roller.out is not None:
            files.append(roller.close())
        if files:
            yield out()

    path = f"{folder}/_manifest"
    spread.mapInArrow(write, MANIFEST).write.parquet(path)
    manifest = pages.sparkSession.read.parquet(path)
    commit(manifest, folder)
    return manifest


def commit(manifest: DataFrame, folder: str) -> int:
    """Rename the manifest's files to their final names; may be repeated.  Returns how many are in place."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(folder)
        for batch in batches:
            for temp, file in zip(batch.column("temp").to_pylist(), batch.column("file").to_pylist(), strict=True):
                if fs.get_file_info(f"{path}/{temp}").type != pafs.FileType.NotFound:
                    fs.move(f"{path}/{temp}", f"{path}/{file}")
                elif fs.get_file_info(f"{path}/{file}").type == pafs.FileType.NotFound:
                    raise FileNotFoundError(f"{folder}/{temp}")
            yield pa.RecordBatch.from_arrays([batch.column("file")], ["file"])

    return manifest.select("temp", "file").mapInArrow(rename, "file string").count()


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of a file, each decompressed."""
    view, at, step = memoryview(data), 0, 1 << 14
    while at < len(data):
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            chunk = view[at:at + step]
            if not len(chunk):
                raise ValueError("truncated member")
            parts.append(z.decompress(chunk))
            at += len(chunk)
        at -= len(z.unused_data)
        yield b"".join(parts)


def parse(rec: bytes) -> tuple:
    """(page_id, url, record type, digest, payload bytes, payload, refers_to) of a record; digests are checked."""
    head, _, rest = rec.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(re.search(rb"Content-Length: (\d+)", http)[1])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if base32_sha1(block) != fields["WARC-Block-Digest"].removeprefix("sha1:"):
        raise ValueError("block digest differs")
    if kind == "response" and (base32_sha1(payload) != digest or len(payload) != stated):
        raise ValueError("payload digest differs")
    own, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
    return (None if own is None else int(own), fields["WARC-Target-URI"], kind, digest, stated,
            payload if kind == "response" else None, None if refers is None else int(refers))


RECORD = ("page_id long, url string, record_type string, payload_digest string, payload_bytes long, payload binary, "
          "refers_to long")


def read_archive(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """All records of an archive; ``payloads``: with the payload of responses."""
    manifest = spark.read.parquet(f"{folder}/_manifest").select("file", "bytes", "sha1")
    schema = RECORD if payloads else RECORD.replace("payload binary, ", "")
    names = [x.split()[0] for x in schema.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = dict(zip([x.split()[0] for x in RECORD.split(", ")], zip(*rows, strict=True), strict=True))
        return pa.RecordBatch.from_arrays([_typed(n, list(cols[n])) for n in names], names)

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(folder)
        for batch in batches:
            for file, sha in zip(batch.column("file").to_pylist(), batch.column("sha1").to_pylist(), strict=True):
                with fs.open_input_stream(f"{path}/{file}", compression=None) as f:
                    data = f.read()
                if hashlib.sha1(data).hexdigest() != sha:
                    raise ValueError(f"{file} differs from the manifest")
                held, size = [], 0
                for m in members(data):
                    held.append(parse(m))
                    size += len(m)
                    if size > 8 << 20:
                        yield batch_of(held)
                        held, size = [], 0
                if held:
                    yield batch_of(held)

    # a number of partitions that AQE does not reduce: the rows are small, what they name is not
    return manifest.repartition(max(1, manifest.count()), "file").mapInArrow(load, schema)


def _typed(name: str, values: list) -> pa.Array:
    kind = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
    return pa.array(values, kind.get(name, pa.string()))


"""WARC archives: a deterministic sharded writer with a manifest, and the reader back.

Records are dealt in shards of neighbouring page ids and sorted; a new file begins with each shard and when
the compressed size reaches a bound. Where shards begin follows from the rows alone: their number from all payload bytes,
their first ids from the rows whose hash is below a threshold. So equal input gives equal files, whatever
partitions, sessions and settings it comes through. Of records with equal payloads the one with the
smallest page id is a response and the others revisit it; who that is travels to the writer as a row of
its own, sorted before its page, so payloads are shuffled once. Every record is a gzip member without a
time stamp; ids, dates and digests follow from the rows.

Tasks write under temporary names that hold the attempt. The manifest, which Spark's own commit
makes appear whole, names the files of the attempts that count; only these are renamed, and a rename
that was done already is left, so a commit can be repeated. What lost attempts have left is deleted then. Readers go by the
manifest, and take a file that has not got its name yet by its temporary one.

Null html is an empty payload, a null url gives no target. Rows with a null id are never a response
when a payload has another id. Equal rows give one response; the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import shared_folder

ROLL = 64 << 20
#: payload bytes of a shard, the most shards, and rows of the sample for each
SHARD, MOST, SAMPLED = 32 << 20, 16_384, 32
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"
MANIFEST = "temporary string, name string, records long, bytes long, sha256 string"


class Record(NamedTuple):
    page_id: int | None
    url: str | None
    payload: bytes
    refers_to: int | None
    digest: str


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def header(url: str) -> str:
    """The url without the characters that would end a header line."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url)


def member(r: Record, revisit: bool) -> bytes:
    """One record as a gzip member."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(r.payload)}\r\n\r\n"
    block = head.encode() if revisit else head.encode() + r.payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(r.page_id, r.digest)}", f"WARC-Date: {DATE}"]
    if r.url is not None:
        lines.append(f"WARC-Target-URI: {header(r.url)}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(r.refers_to, r.digest)}"]
    lines += [f"WARC-Payload-Digest: sha1:{r.digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}"]
    if r.page_id is not None:
        lines.append(f"X-Page-Id: {r.page_id}")
    if revisit and r.refers_to is not None:
        lines.append(f"X-Refers-To-Page-Id: {r.refers_to}")
    lines += [f"X-Payload-Length: {len(r.payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    data = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Roll:
    """The files of one task: a new one for a new shard, and when the open one holds ``size`` bytes."""

    def __init__(self, folder: str, size: int):
        self.files, self.folder = fs.FileSystem.from_uri(folder)
        self.size, self.count, self.part = size, 0, -1
        self.attempt = TaskContext.get().taskAttemptId()
        self.out = None

    def add(self, data: bytes, shard: int) -> Iterator[dict]:
        if shard != self.part:
            if self.out is not None:
                yield self.end()
            self.part, self.count = shard, 0
        if self.out is None:
            self.name = f"part-{self.part:06d}-{self.count:05d}.warc.gz"
            self.temporary = f"temporary-{self.attempt}-{self.name}"
            self.out = self.files.open_output_stream(f"{self.folder}/{self.temporary}", compression=None)
            self.records, self.bytes, self.sha = 0, 0, hashlib.sha256()
        self.out.write(data)
        self.sha.update(data)
        self.records += 1
        self.bytes += len(data)
        if self.bytes >= self.size:
            yield self.end()

    def end(self) -> dict:
        self.out.close()
        self.out, self.count = None, self.count + 1
        return {"temporary": self.temporary, "name": self.name, "records": self.records, "bytes": self.bytes, "sha256": self.sha.hexdigest()}


def splitters(rows: DataFrame, shard_bytes: int) -> list[tuple[int | None, str]]:
    """The (page id, payload's hash) with which each shard but the first begins, of rows (page_id, sha, size)."""
    total = rows.agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).first()  # one row
    shards = min(MOST, -(-(total["bytes"] or 0) // shard_bytes), total["rows"])
    if shards < 2:
        return []
    share = min(1.0, SAMPLED * shards / total["rows"])
    place = F.pmod(F.xxhash64("page_id", "sha"), F.lit(1 << 31))
    sample = rows.where(place < int(share * (1 << 31))).select("page_id", "sha").distinct().collect()  # some SAMPLED rows a shard
    order = sorted(((r.page_id, r.sha) for r in sample), key=lambda k: (k[0] is not None, k[0] or 0, k[1]))
    return list(dict.fromkeys(order[len(order) * n // shards] for n in range(1, shards))) if order else []


def shard_of(starts: list[tuple[int | None, str]]) -> Column:
    """How many of the starts are not beyond a row's (page_id, sha), by binary search."""
    if not starts:
        return F.lit(0)
    listed = F.from_json(F.lit(json.dumps([{"page_id": i, "sha": s} for i, s in starts])), "array<struct<page_id: long, sha: string>>")
    key = F.struct("page_id", "sha")

    def halved(found: Column, _: Column) -> Column:
        middle = ((found["low"] + found["high"]) / 2).cast("int")
        beyond = F.get(listed, middle) > key
        step = F.struct(F.when(beyond, found["low"]).otherwise(middle + 1).alias("low"), F.when(beyond, middle).otherwise(found["high"]).alias("high"))
        return F.when(found["low"] < found["high"], step).otherwise(found)

    whole = F.struct(F.lit(0).alias("low"), F.lit(len(starts)).alias("high"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(len(starts).bit_length())), whole, halved, lambda found: found["low"])


def write_warc(pages: DataFrame, folder: str, least: int = 0, roll: int = ROLL, shard_bytes: int = SHARD) -> str:
    """Writes (page_id, url, html) as archives under ``folder``; gives the manifest's path.

    Payloads of fewer than ``least`` bytes are all responses.
    """
    spark = pages.sparkSession
    files, path = fs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    html = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html")).withColumn("sha", F.sha1("html"))
    measured = rows.select("page_id", "sha", F.length("html").alias("size"))
    starts = splitters(measured, shard_bytes)
    sized = measured.distinct()
    first = sized.groupBy("sha").agg(F.min("page_id").alias("first"))
    told = sized.join(first, "sha").where((F.col("size") >= least) & F.col("first").isNotNull())
    none = F.lit(None)
    union = told.select("page_id", "sha", F.lit(0).alias("kind"), "first", none.cast("string").alias("url"), none.cast("binary").alias("html")).unionByName(
        rows.select("page_id", "sha", F.lit(1).alias("kind"), none.cast("long").alias("first"), "url", "html")
    )
    order = ["page_id", "sha", "kind", "url"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = union.withColumn("shard", shard_of(starts)).repartition(max(parts, len(starts) + 1), "shard").sortWithinPartitions("shard", *order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, known, before = Roll(folder, roll), None, None
        done: list[dict] = []
        for b in batches:
            for page_id, sha, kind, low, url, payload, shard in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not kind:
                    known = (page_id, sha, low)
                    continue
                told = known is not None and known[:2] == (page_id, sha)
                refers_to = known[2] if told else None
                revisit = told and (page_id != refers_to or before == (page_id, sha))
                before = (page_id, sha)
                r = Record(page_id, url, payload, refers_to, base32_sha1(payload))
                done.extend(out.add(member(r, revisit), shard))
        if out.out is not None:
            done.append(out.end())
        if done:
            yield pa.RecordBatch.from_pylist(done)

    manifest = f"{folder}/manifest.parquet"
    dealt.mapInArrow(write, MANIFEST).write.parquet(manifest)
    commit(spark, folder)
    return manifest


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest's rows, one task for a few files."""
    rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest.parquet")
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "name")


def commit(spark: SparkSession, folder: str) -> None:
    """Gives the files that the manifest lists their names, and deletes other temporary ones; may be run again."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = fs.FileSystem.from_uri(folder)
        for b in batches:
            for temporary, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if files.get_file_info(f"{path}/{name}").type == fs.FileType.NotFound:
                    files.move(f"{path}/{temporary}", f"{path}/{name}")
            yield pa.RecordBatch.from_arrays([b.column(1)], ["name"])

    listed(spark, folder).mapInArrow(rename, "name string").write.format("noop").mode("overwrite").save()
    files, path = fs.FileSystem.from_uri(folder)
    for left in files.get_file_info(fs.FileSelector(path)):
        if left.base_name.startswith("temporary-"):
            files.delete_file(left.path)


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[: int(fields["content-length"])]
    if base32_sha1(block) != fields["warc-block-digest"].removeprefix("sha1:"):
        raise ValueError(f"block of {fields['warc-record-id']} does not match its digest")
    return fields, block


def members(stream) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    packed = zlib.decompressobj(31)
    out: list[bytes] = []
    while chunk := stream.read(1 << 20):
        while chunk:
            out.append(packed.decompress(chunk))
            chunk = packed.unused_data
            if packed.eof:
                yield b"".join(out)
                packed, out = zlib.decompressobj(31), []
    if out and not packed.eof:
        raise ValueError("the file ends within a record")


def opened(files: fs.FileSystem, path: str, temporary: str, name: str):
    """A file of the manifest, by its temporary name as long as the commit has not come to it."""
    try:
        return files.open_input_stream(f"{path}/{name}", compression=None)
    except FileNotFoundError:
        try:
            return files.open_input_stream(f"{path}/{temporary}", compression=None)
        except FileNotFoundError:  # renamed in between
            return files.open_input_stream(f"{path}/{name}", compression=None)


RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of a committed folder; a revisit's payload is null, its size and digest are those it refers to."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = fs.FileSystem.from_uri(folder)
        for b in batches:
            for temporary, name, records in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                rows, count, size = [], 0, 0
                with opened(files, path, temporary, name) as stream:
                    for data in members(stream):
                        fields, block = parsed(data)
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        payload = None
                        if fields["warc-type"] == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            if base32_sha1(payload) != digest:
                                raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
                        number = {k: int(fields[k]) if k in fields else None for k in ("x-page-id", "x-refers-to-page-id")}
                        rows.append(
                            {
                                "page_id": number["x-page-id"], "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"],
                                "refers_to": number["x-refers-to-page-id"], "payload_bytes": int(fields["x-payload-length"]),
                                "payload_digest": digest, "payload": payload if payloads else None,
                            }
                        )
                        count, size = count + 1, size + len(payload or b"")
                        if len(rows) >= 1000 or size >= 16 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)
                if count != records:
                    raise ValueError(f"{name} has {count} records, the manifest {records}")

    return listed(spark, folder).mapInArrow(read, RECORDS)


def batch_of(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in RECORDS.split(", ")])
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def warc_query(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(pages, folder)
    found = read_warc(spark, folder, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS low FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substr(x, (i // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> low THEN low END AS refers_to
FROM d
"""

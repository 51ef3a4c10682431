"""WARC archives: writing, reading, and resolving revisits into deduplicated archives.

Pages are written as response records, one gzip member each. Headers are read back and shuffled
by payload digest; of records with equal payloads the one with the largest id stays a response and
the others become revisits of it. The archives are then written anew, record by record, with fresh
headers. Each attempt of a task writes files of its own names, and only names that a finished task
returned are ever read, so what a lost attempt leaves behind is no part of an archive.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tessera.llm.shared import scratch_path, write_table

#: A payload of fewer bytes is never a revisit.
MIN_REVISIT_BYTES = 1000
SHARD_BYTES = 32 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def now() -> str:
    return datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(page_id: int | None, place: str = "") -> str:
    """A URN that holds the page id, if there is one, and 63 bits of the place where the record was first
    written, so that rows that share an id, or have none, get ids of their own."""
    high = int.from_bytes(hashlib.blake2b(place.encode(), digest_size=8).digest(), "big") & ~1
    low = 0 if page_id is None else page_id & (1 << 64) - 1
    return f"<urn:uuid:{uuid.UUID(int=(high | (page_id is not None)) << 64 | low)}>"


def page_of(record: str) -> int | None:
    value = uuid.UUID(record.strip("<>").removeprefix("urn:uuid:")).int
    if not value >> 64 & 1:
        return None
    low = value & (1 << 64) - 1
    return low - (1 << 64) if low >> 63 else low


def http_head(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()


def record(kind: str, ident: str, date: str, url: str | None, digest: str, block: bytes, more: dict | None = None) -> bytes:
    """A compressed record. ident: its record id. date: of the capture. digest: hex SHA-1 of the whole payload."""
    fields = {"WARC-Type": kind, "WARC-Record-ID": ident, "WARC-Date": date}
    if url is not None:
        fields["WARC-Target-URI"] = "".join(c for c in url if c not in "\r\n")
    fields["WARC-Payload-Digest"] = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    fields |= more or {}
    fields |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, bytes) of the gzip members of an archive."""
    at, view = 0, memoryview(content)
    while at < len(content):
        unpack, start, parts = zlib.decompressobj(31), at, []
        while not unpack.eof:
            if at >= len(content):
                raise ValueError("an archive ends inside a record")
            parts.append(unpack.decompress(view[at : at + 65536]))
            at += min(65536, len(content) - at)
        at -= len(unpack.unused_data)
        yield start, at - start, b"".join(parts)


def parse(raw: bytes) -> tuple[dict[str, str], int, bytes]:
    """(WARC fields, payload bytes by the HTTP header, payload as stored) of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/1."):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [x.split(b":", 1)[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    return fields, int(sizes[0]), payload


def digest_of(fields: dict[str, str]) -> str:
    return base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()


def put(folder: str, name: str, content: bytes) -> str:
    """Writes a file of the shared folder under a name of its own that begins as given; returns the name."""
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}.warc.gz"
    with fs.open_output_stream(f"{path}/{name}", compression=None) as out:
        out.write(content)
    return name


def get(folder: str, name: str) -> bytes:
    """A file of the shared folder."""
    fs, path = pafs.FileSystem.from_uri(folder)
    with fs.open_input_stream(f"{path}/{name}", compression=None) as file:
        return file.read()


_WRITTEN = pa.schema([("file", pa.string()), ("records", pa.int64())])


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """A response record for each row, in shards; returns (file, records). Nulls: no id, no URI, empty payload.

    The date of all records is that of the call.
    """
    date = now()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close():
            nonlocal shard, held, size
            name = put(folder, f"part-{part:06d}-{shard:05d}", b"".join(held))
            row = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(held)], pa.int64())], schema=_WRITTEN)
            shard, held, size = shard + 1, [], 0
            return row

        for batch in batches:
            for page, url, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                payload = html or b""
                digest = hashlib.sha1(payload, usedforsecurity=False).hexdigest()
                ident = record_id(page, f"{folder} {part} {shard} {len(held)}")
                held.append(record("response", ident, date, url, digest, http_head(len(payload)) + payload))
                size += len(held[-1])
                if size >= SHARD_BYTES:
                    yield close()
        if held:
            yield close()

    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(payload_col).cast("string").cast("binary"))
    return write_table(rows.mapInArrow(run, from_arrow_schema(_WRITTEN)), "archives")


_HEADERS = pa.schema(
    [("file", pa.string()), ("at", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()),
     ("payload_bytes", pa.int64()), ("kind", pa.string()), ("refers_to", pa.int64()), ("record", pa.string()), ("date", pa.string())]
)


#: Archives that a task reads one after the other.
FILES_A_TASK = 4


def read_headers(files: DataFrame, folder: str) -> DataFrame:
    """What the records of the named archives say; digests of stored payloads are computed anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows = []
                for at, _, raw in members(get(folder, file)):
                    fields, size, payload = parse(raw)
                    digest, kind, ident = digest_of(fields), fields["WARC-Type"], fields["WARC-Record-ID"]
                    if kind == "response" and hashlib.sha1(payload, usedforsecurity=False).hexdigest() != digest:
                        raise ValueError(f"{file} at {at}: the payload doesn't have its digest")
                    refers = page_of(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None
                    rows.append((file, at, page_of(ident), fields.get("WARC-Target-URI"), digest, size, kind, refers, ident, fields["WARC-Date"]))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_HEADERS)], schema=_HEADERS)

    names = files.select("file")
    return names.repartition(max(1, -(-names.count() // FILES_A_TASK)), "file").mapInArrow(run, from_arrow_schema(_HEADERS))


def resolve(headers: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Revisits among the headers: (file, at, to_record, to_url, to_date). All other records stay responses.

    Of equal payloads the largest page id is the response; of rows that share it, the one in the
    last place. Digests are counted before the shuffle, and only rows of digests that occur twice
    are joined, so a payload that a third of all pages have is split like any skewed join key.
    """
    long = headers.filter(F.col("payload_bytes") >= min_bytes)
    last = F.max(F.struct("page_id", "file", "at", "url", "record", "date")).alias("response")
    several = long.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), last).filter("n > 1")
    found = long.select("file", "at", "digest").join(several, "digest")
    found = found.filter((F.col("file") != F.col("response.file")) | (F.col("at") != F.col("response.at")))
    return found.select("file", "at", *[F.col(f"response.{c}").alias(f"to_{c}") for c in ("record", "url", "date")])


def rewrite_archives(files: DataFrame, folder: str, revisits: DataFrame, target: str) -> DataFrame:
    """Writes each archive anew, revisits without their payload; returns (file, records).

    Only names and decisions are shuffled: a task reads its archives from the shared folder.
    """

    def run(names: pa.Table, changes: pa.Table) -> pa.Table:
        to = {r["at"]: r for r in changes.to_pylist()}
        done, counts = [], []
        for file in names.column("file").to_pylist():
            out = []
            for at, _, raw in members(get(folder, file)):
                fields, size, payload = parse(raw)
                same = (fields["WARC-Record-ID"], fields["WARC-Date"], fields.get("WARC-Target-URI"), digest_of(fields))
                if at not in to:
                    out.append(record("response", *same, http_head(size) + payload))
                    continue
                more = {"WARC-Profile": PROFILE, "WARC-Refers-To": to[at]["to_record"], "WARC-Refers-To-Date": to[at]["to_date"]}
                if to[at]["to_url"] is not None:
                    more["WARC-Refers-To-Target-URI"] = to[at]["to_url"]
                out.append(record("revisit", *same, http_head(size), more))
            done.append(put(target, file.removesuffix(".warc.gz"), b"".join(out)))
            counts.append(len(out))
        return pa.table([pa.array(done, pa.string()), pa.array(counts, pa.int64())], schema=_WRITTEN)

    both = files.select("file").groupBy("file").cogroup(revisits.groupBy("file"))
    return write_table(both.applyInArrow(run, from_arrow_schema(_WRITTEN)), "rewritten")


def deduplicate(pages: DataFrame, **columns: str) -> tuple[str, DataFrame]:
    """(folder of the deduplicated archives, their headers read back).

    Extra columns are ignored. Rows that share an id give a record each. A table without rows
    gives no archive and no headers.
    """
    spark = pages.sparkSession
    raw, target = scratch_path(spark, "warc"), scratch_path(spark, "warc-dedup")
    files = write_archives(pages, raw, **columns)
    if files.isEmpty():
        return target, spark.createDataFrame([], from_arrow_schema(_HEADERS))
    headers = write_table(read_headers(files, raw), "headers")
    written = rewrite_archives(files, raw, write_table(resolve(headers), "revisits"), target)
    return target, read_headers(written, target)


def resolved_pages(pages: DataFrame, **columns: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to, from the deduplicated archives."""
    headers = deduplicate(pages, **columns)[1]
    return headers.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")


def oracle(min_bytes: int = MIN_REVISIT_BYTES) -> str:
    """DuckDB: the same rows."""
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {min_bytes} AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {min_bytes} AND page_id < last THEN last END AS refers_to
FROM r"""

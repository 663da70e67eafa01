"""WARC archives: one gzip member per record, read back sequentially.

``write_archives`` turns rows (id, uri, payload) into ``.warc.gz`` files on
the shared file system; ``read_archives`` streams each file through an
incremental zlib decompressor, frames every record by its Content-Length and
verifies block and payload digests.

Defined results: a null payload is the empty payload; a null uri leaves the
WARC-Target-URI header out; a null id is written as an empty record id and
read back as null; rows with the same id and the same payload are the same
record, so each of them is a response if the id is the smallest of its
payload; an empty table makes no archive and no record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_table_path
from .common import persist, small_side

ARCHIVE_BYTES = 64 << 20   # compressed bytes after which a writer starts the next archive
READ_BLOCK = 1 << 20
REVISITS_BROADCAST = 200_000
ID_PREFIX = "urn:x-page:"
IDENTICAL = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)

MANIFEST = "path string, records long, bytes long"
RECORDS = ("page_id long, record_type string, uri string, payload_bytes long, payload_digest string, "
           "refers_to long, payload binary")


class WarcError(ValueError):
    """A record that breaks framing or a digest."""


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^s3a://", "s3://", re.sub(r"^file:/+", "/", path)))


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id, uri, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC record; a revisit keeps the HTTP headers and drops the body."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <{ID_PREFIX}{'' if page_id is None else page_id}>",
            f"WARC-Date: {EPOCH:%Y-%m-%dT%H:%M:%SZ}"]
    if uri is not None:
        clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", uri)
        head.append(f"WARC-Target-URI: {clean}")
    if revisit:
        head += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(record: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def members(stream, block: int = READ_BLOCK) -> Iterator[bytes]:
    """The decompressed members of a gzip stream, one at a time."""
    data, z, parts = stream.read(block), None, []
    while data:
        if z is None:
            z = zlib.decompressobj(31)
        parts.append(z.decompress(data))
        if z.eof:
            yield b"".join(parts)
            data, z, parts = z.unused_data or stream.read(block), None, []
        else:
            data = stream.read(block)
    if z is not None:
        raise WarcError("truncated gzip member")


def parse_record(raw: bytes) -> dict:
    """Headers, framed block and verified payload of one record."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not sep or not lines[0].startswith("WARC/"):
        raise WarcError("no WARC header")
    h = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(h["content-length"])
    block, tail = rest[:n], rest[n:]
    if len(block) != n or tail != b"\r\n\r\n":
        raise WarcError(f"content length {n} does not frame the record")
    if h["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        raise WarcError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])
    digest = h["warc-payload-digest"].removeprefix("sha1:")
    if h["warc-type"] == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise WarcError("payload digest or length differs")
    ident = lambda v: int(v) if (v := v.strip("<>").removeprefix(ID_PREFIX)) else None
    return {"page_id": ident(h["warc-record-id"]), "record_type": h["warc-type"],
            "uri": h.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest,
            "refers_to": ident(h["warc-refers-to"]) if "warc-refers-to" in h else None,
            "payload": payload if h["warc-type"] == "response" else None}


def _writer(folder: str, limit: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_fs(folder)
        store.create_dir(base, recursive=True)
        out = path = None
        done, n, size = [], 0, 0

        def close():
            out.close()
            done.append((path, n, size))

        for batch in batches:
            cols = batch.to_pydict()
            for page, uri, payload, digest, ref, revisit in zip(*(cols[c] for c in (
                    "page_id", "uri", "payload", "digest", "refers_to", "revisit"))):
                if out is None:  # a name of its own for each attempt: only committed ones reach the manifest
                    path, n, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(path, compression=None)
                member = gzip_member(record_bytes(
                    page, uri, payload or b"", base64.b32encode(bytes.fromhex(digest)).decode(), ref, revisit))
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= limit:
                    close()
                    out = None
        if out is not None:
            close()
        full = lambda p: folder.rstrip("/") + p[len(base):]
        yield pa.RecordBatch.from_pydict(
            {"path": pa.array([full(p) for p, _, _ in done], pa.string()),
             "records": pa.array([r for _, r, _ in done], pa.int64()),
             "bytes": pa.array([s for _, _, s in done], pa.int64())})

    return write


def write_archives(spark: SparkSession, pages: DataFrame, folder: str | None = None,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of rows (page_id, url, html); returns the manifest (path,
    records, bytes).  Of equal payloads the smallest page_id is a response,
    the others are revisits that refer to it."""
    folder = folder or new_table_path(spark, "warc")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("uri"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    first = rows.groupBy("digest").agg(F.min("page_id").alias("first"))
    # Only the revisits travel back to the pages: ids and digests, no payloads.
    revisits = persist(spark, rows.select("page_id", "digest").distinct().join(first, "digest")
                       .where(F.col("first") < F.col("page_id"))
                       .select(F.col("page_id").alias("p"), F.col("digest").alias("d"),
                               F.col("first").alias("refers_to")), "revisits")
    joined = rows.join(small_side(revisits, REVISITS_BROADCAST),
                       F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left")
    out = joined.select("page_id", "uri", "payload", "digest", "refers_to",
                        F.col("refers_to").isNotNull().alias("revisit"))
    return persist(spark, out.mapInArrow(_writer(folder, archive_bytes), MANIFEST), "warc-manifest")


def _reader(keep_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "record_type", "uri", "payload_bytes", "payload_digest", "refers_to", "payload"]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

        def pack(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names=names)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, name = open_fs(path)
                rows, held = [], 0
                with store.open_input_stream(name, compression=None) as stream:
                    for raw in members(stream):
                        r = parse_record(raw)
                        if not keep_payload:
                            r["payload"] = None
                        rows.append(r)
                        held += 200 + len(r["payload"] or b"")
                        if held > (4 << 20):
                            yield pack(rows)
                            rows, held = [], 0
                if rows:
                    yield pack(rows)

    return read


def read_archives(spark: SparkSession, manifest: DataFrame, keep_payload: bool = True) -> DataFrame:
    """Every record of the listed archives (a column ``path``), verified; a
    damaged record raises ``WarcError``.  One archive is read by one task."""
    n = max(1, manifest.count())
    return manifest.select("path").repartition(n).mapInArrow(_reader(keep_payload), RECORDS)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import table

    manifest = write_archives(spark, table(spark, sf_dir, "pages"))
    return read_archives(spark, manifest, keep_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS d FROM pages
), f AS (SELECT d, min(page_id) AS first_id FROM p GROUP BY d),
g AS (
  SELECT p.page_id, p.html, p.d, f.first_id,
         list_transform(range(8), lambda i: ('0x' || substr(p.d, CAST(5 * i + 1 AS INTEGER), 5))::INTEGER) AS v
  FROM p JOIN f ON p.d = f.d
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(v, lambda x:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x >> 15) % 32 + 1, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x >> 10) % 32 + 1, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x >> 5) % 32 + 1, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x % 32 + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id < page_id THEN first_id END AS refers_to
FROM g
"""

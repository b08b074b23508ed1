"""WARC archives: one gzip member per record, identical payloads as revisits.

Writing deduplicates payloads by digest over the whole table, then each task writes its rows
to archives of bounded size in the given folder. Only archives named by a finished task are in
the manifest, so files of lost attempts are never read. Reading opens the archives one by one,
decompresses them in small steps and checks every digest.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacus.llm._store import bounded_batches, grouped, released

# Payloads below this many bytes are always written out.
MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20
STEP = 1 << 16
# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class ArchiveError(ValueError):
    """An archive is cut short or a digest does not match."""


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One record as a gzip member. A revisit carries the headers alone."""
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
              ("WARC-Date", "1970-01-01T00:00:00Z"),
              ("Content-Type", "application/http;msgtype=response"),
              ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}")]
    if page_id is not None:
        fields.append(("Page-ID", str(page_id)))
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("Refers-To-Page-ID", str(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    head = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def members(source: BinaryIO, step: int = STEP) -> Iterator[bytes]:
    """The contents of each gzip member, decompressed ``step`` compressed bytes at a time."""
    rest = b""
    while True:
        data = rest or source.read(step)
        if not data:
            return
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not data:
                raise ArchiveError("the last record is cut short")
            parts.append(unpacker.decompress(data))
            rest = unpacker.unused_data
            data = b"" if unpacker.eof else source.read(step)
        yield b"".join(parts)


def headers(data: bytes) -> tuple[str, dict[str, str], bytes]:
    """First line, fields by lower-case name, and what follows the empty line."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, rest


def parse(member: bytes) -> dict:
    """A record's fields and payload; raises ArchiveError if a length or digest is wrong."""
    first, fields, rest = headers(member)
    if first != VERSION:
        raise ArchiveError(f"not a record: {first[:40]!r}")
    size = int(fields["content-length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ArchiveError("a record's length does not match its content")
    if fields["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ArchiveError("a block's digest does not match")
    _, http, payload = headers(block)
    digest, kind = fields["warc-payload-digest"].removeprefix("sha256:"), fields["warc-type"]
    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(http["content-length"])):
        raise ArchiveError("a payload's digest or length does not match")
    number = lambda name: int(fields[name]) if name in fields else None
    return {"page_id": number("page-id"), "url": fields.get("warc-target-uri"), "payload_bytes": int(http["content-length"]),
            "payload_digest": digest, "record_type": kind, "refers_to": number("refers-to-page-id"),
            "payload": payload if kind == "response" else None}


_RECORDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                      ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                      ("payload", pa.binary())])


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record per row of (page_id, url, html) to archives under ``path``.

    Null html is an empty payload. Of equal payloads of at least MIN_REVISIT_BYTES, the rows
    with the smallest page_id are responses (each, if the row is repeated) and the others
    revisit that id. Rows without a page_id revisit as well, and are responses where no row of
    that payload has an id. Other columns are not written.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    first = (grouped(rows.where(F.length("payload") >= MIN_REVISIT_BYTES), "digest")
             .agg(F.min("page_id").alias("first_id")).where("first_id is not null").drop("__deal"))
    rows = rows.join(first, "digest", "left").select(
        "page_id", "url", "payload", F.when(F.col("page_id").eqNullSafe(F.col("first_id")), None)
        .otherwise(F.col("first_id")).alias("refers_to"))

    def run(batches):
        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(f"{folder}/archives")
        out, name, size, count = None, None, 0, 0
        done = lambda: pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count])], names=["archive", "records"])
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(batch[c] for c in range(4)), strict=True):
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{folder}/archives/{name}", compression=None)
                data = record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py())
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield done()
        if out is not None:
            out.close()
            yield done()

    rows.mapInArrow(released(run), "archive string, records long").write.parquet(f"{path}/manifest")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives in the manifest: page_id, url, payload_bytes,
    payload_digest, record_type, refers_to and payload (null for revisits)."""

    def run(batches):
        store, folder = fs.FileSystem.from_uri(path)
        for batch in batches:
            for name in batch["archive"].to_pylist():
                with store.open_input_stream(f"{folder}/archives/{name}", compression=None) as source:
                    rows, size = [], 0
                    for member in members(source):
                        rows.append(parse(member))
                        size += len(member)
                        if size >= 4 << 20 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, _RECORDS)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, _RECORDS)

    manifest = spark.read.schema("archive string, records long").parquet(f"{path}/manifest")
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(spread, "archive").mapInArrow(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
             "refers_to long, payload binary")

"""WARC archives: a writer and a sequential reader, one gzip member per record.

Archives are written and read inside tasks through pyarrow's file systems, so any folder that all executors reach will do. A task
writes to a name of its own attempt and renames when it is done; a task that is run again writes the same file again.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtab.llm.common import saved
from streamtab.session import scratch_path

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 16
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header(value: object) -> str:
    """A header value on one line: control characters as %XX."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", "" if value is None else str(value))


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str, revisit: bool) -> bytes:
    """One WARC record. A revisit has the HTTP header, which states the payload's length, but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{_header(page_id)}>",
            f"WARC-Date: {date}", f"WARC-Target-URI: {_header(url)}", f"WARC-Payload-Digest: sha1:{digest(payload)}",
            f"WARC-Block-Digest: sha1:{digest(block)}", "Content-Type: application/http;msgtype=response"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def members(stream, chunk: int = CHUNK) -> Iterator[bytes]:
    """The content of each gzip member, inflated chunk by chunk; raises when the file ends inside one."""
    data = stream.read(chunk)
    while data:
        inflate, parts = zlib.decompressobj(wbits=31), []
        while not inflate.eof:
            if not data:
                raise ValueError("archive ends inside a record")
            parts.append(inflate.decompress(data))
            data = inflate.unused_data if inflate.eof else stream.read(chunk)
        yield b"".join(parts)
        data = data or stream.read(chunk)


def parse(raw: bytes) -> dict:
    """The record in a member: framing by Content-Length, block and payload digests verified; raises on any mismatch."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    length = int(fields["Content-Length"])
    block = rest[:length]
    if not lines[0].startswith("WARC/1.") or len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError("bad record framing")
    if digest(block) != fields["WARC-Block-Digest"].removeprefix("sha1:"):
        raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or digest(payload) != stated):
        raise ValueError("payload digest differs")
    page, other = (re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(k, "")) for k in ("WARC-Record-ID", "WARC-Refers-To"))
    return {"page_id": int(page[1]) if page else None, "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"],
            "refers_to": int(other[1]) if other else None, "payload_bytes": size, "payload_digest": stated,
            "payload": None if revisit else payload}


def mark_revisits(spark: SparkSession, pages: DataFrame, least: int = 0, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """(page_id, url, payload, refers_to): `refers_to` is the smallest page with an equal payload of at least `least` bytes.

    Null html is an empty payload. Pages with that smallest id refer to nothing, and neither does a page without an id; repeated
    rows of the smallest id all stay whole. Payloads are compared by SHA-1 and length. Counts are combined before the shuffle,
    and only pages that do revisit another are joined back, so a payload that a third of all pages share stays split.
    """
    rows = pages.select(
        F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary").alias("payload")
    )
    narrow = rows.select("page_id", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("bytes"))
    groups = narrow.groupBy("sha", "bytes").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    groups = groups.where((F.col("n") > 1) & (F.col("bytes") >= least)).select("sha", "bytes", "first")
    back = narrow.join(groups, ["sha", "bytes"]).where("first < page_id").select("page_id", "sha", F.col("first").alias("refers_to"))
    back = saved(spark, back.distinct(), "warc-revisits")
    return rows.withColumn("sha", F.sha1("payload")).join(back, ["page_id", "sha"], "left").drop("sha")


def write_archives(
    spark: SparkSession, marked: DataFrame, date: str = "1970-01-01T00:00:00Z", max_bytes: int = 1 << 30, level: int = 6
) -> DataFrame:
    """Archives of (page_id, url, payload, refers_to) rows in the shared folder; (path, records) of each as the manifest.

    A task writes one archive after another, each closed when it passes `max_bytes`. An empty table has no archive.
    """
    root = scratch_path(spark, "warc")

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = fs.FileSystem.from_uri(root)
        where.create_dir(base, recursive=True)
        task = TaskContext.get().partitionId()
        rows = itertools.chain.from_iterable(zip(*(b[c].to_pylist() for c in ("page_id", "url", "payload", "refers_to"))) for b in parts)
        for number in itertools.count():
            row = next(rows, None)
            if row is None:
                return
            name = posixpath.join(base, f"part-{task:06d}-{number:05d}.warc.gz")
            attempt, n, size = f"{name}.{uuid.uuid4().hex}", 0, 0
            with where.open_output_stream(attempt, compression=None) as out:
                while row is not None:
                    page, url, payload, first = row
                    pack = zlib.compressobj(level, wbits=31)
                    data = pack.compress(record(page, url, payload, first, date, first is not None)) + pack.flush()
                    out.write(data)
                    n, size = n + 1, size + len(data)
                    row = next(rows, None) if size < max_bytes else None
            where.move(attempt, name)
            yield pa.RecordBatch.from_pydict({"path": [f"{root}/{posixpath.basename(name)}"], "records": [n]})

    return saved(spark, marked.mapInArrow(write, "path string, records long"), "warc-manifest")


def read_archives(manifest: DataFrame, payload: bool = True) -> DataFrame:
    """The records of the archives that `manifest` lists, in columns; `payload` false leaves out the payloads once verified.

    Raises when a record is cut off, is framed wrongly, fails a digest, or when an archive holds another number of records.
    """

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
        for path, records in itertools.chain.from_iterable(zip(b["path"].to_pylist(), b["records"].to_pylist()) for b in parts):
            where, name = fs.FileSystem.from_uri(path)
            seen, found, held = 0, [], 0
            with where.open_input_stream(name, compression=None) as stream:
                for raw in members(stream):
                    row = parse(raw)
                    if not payload:
                        row["payload"] = None
                    seen, held = seen + 1, held + (len(raw) if payload else 0)
                    found.append(row)
                    if len(found) >= 2000 or held > 1 << 24:
                        yield pa.RecordBatch.from_pylist(found, schema=schema)
                        found, held = [], 0
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=schema)
            if seen != records:
                raise ValueError(f"{path} holds {seen} records, not {records}")

    tasks = max(2, manifest.count())
    return manifest.repartition(tasks).mapInArrow(read, RECORD)

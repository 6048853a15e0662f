"""WARC archives, with a converter for legacy ARC archives.

An ARC file begins with a version block that names its header fields: version 1 has URL, IP address, date,
content type and length, version 2 also status, checksum, location, offset and file name. Each record is one
header line and exactly the declared number of bytes. The converter reads both, and synthesises
what WARC asks for: record identifiers from file and offset, ISO dates, record types, block
and payload digests, and revisit records for payloads seen before.

Archives are written by Spark's text writer, so they land in any storage Spark writes to, under its commit
protocol: a task that is lost and run again leaves no half file. Files are read back whole as binary and
decompressed as a stream, one record in memory at a time; lengths, never separators, end a record.

Edge cases: a null payload is empty; a null URL becomes ``urn:page:<id>``, a null id stays null; white space in URLs
is escaped for ARC's space-separated header; equal payloads make one response and revisits, the response
being that of the smallest id (an id before none, then the smaller record id); a block that is not
UTF-8 is carried in base64 under a header that says so; a record cut off by the end of its
file is kept and marked truncated; an empty table gives archives without records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import shared_dir

from ledgerlake.llm.common import store

# Fixed values of the two formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE, IP = "20240101000000", "0.0.0.0"
ID_FIELD = "X-Page-Id"


# ---- legacy archives ----

class ArcRecord(NamedTuple):
    version: int
    offset: int
    url: str
    ip: str
    date: str
    content_type: str
    status: str | None
    block: bytes
    truncated: bool


def arc_header(name: str, version: int) -> bytes:
    body = f"{version} 0 ledgerlake\n{ARC_FIELDS[version]}\n"
    fields = {1: f"text/plain {len(body)}", 2: f"text/plain 200 - - 0 {name} {len(body)}"}[version]
    return f"filedesc://{name} {IP} {DATE} {fields}\n{body}".encode()


def http_block(page_id: int | None, payload: bytes) -> bytes:
    ident = "" if page_id is None else f"{ID_FIELD}: {page_id}\r\n"
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{ident}"
            f"Content-Length: {len(payload)}\r\n\r\n").encode() + payload


def arc_record(version: int, name: str, offset: int, url: str, block: bytes) -> bytes:
    url = re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", url) or "-"
    fields = {1: f"text/html {len(block)}", 2: f"text/html 200 - - {offset} {name} {len(block)}"}[version]
    return f"{url} {IP} {DATE} {fields}\n".encode() + block


def parse_arc(stream: io.BufferedIOBase) -> Iterator[ArcRecord]:
    """Records of an ARC file, the version block apart. Raises on a header line of the wrong form."""
    version, at = 0, 0
    while line := stream.readline():
        start, at = at, at + len(line)
        if not line.strip():
            continue
        fields = line.decode("utf-8", "replace").split()
        expected = len(ARC_FIELDS[version].split()) if version else None
        if not fields[-1].isdigit() or expected and len(fields) != expected:
            raise ValueError(f"no ARC header line at {start}: {line[:200]!r}")
        length = int(fields[-1])
        block = stream.read(length)
        at += len(block)
        if not version:
            if not fields[0].startswith("filedesc:"):
                raise ValueError("an ARC file begins with its version block")
            version = int(block.split(None, 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version} is unknown")
            continue
        yield ArcRecord(version, start, *fields[:4], fields[4] if version == 2 else None, block, len(block) < length)


# ---- WARC records ----

def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def iso_date(digits: str) -> str:
    """ARC's 14 digits (or 12, or 8) as WARC's date."""
    d = digits.ljust(14, "0") if len(digits) >= 8 else DATE
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """(head with its blank line, payload); a block that is no HTTP message is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = re.search(rb"\r?\n\r?\n", block)
    return (block[: end.end()], block[end.end():]) if end else (block, b"")


def http_field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace").strip() if found else None


def warc_record(headers: list[tuple[str, str]], block: bytes) -> str:
    """The record without its last line feed, which the text writer adds."""
    headers = [*headers, ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}")]
    try:
        body = block.decode()
    except UnicodeDecodeError:
        body = base64.b64encode(block).decode()
        headers.append(("X-Block-Transfer", "base64"))
    length = len(body.encode())
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(length))])
    return f"WARC/1.1\r\n{lines}\r\n{body}\r\n\r"


def parse_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of every record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:80]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        yield headers, base64.b64decode(block) if headers.get("x-block-transfer") == "base64" else block


def opened(content: bytes) -> io.BufferedIOBase:
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else raw


# ---- jobs ----

def _write(records: DataFrame, path: str) -> None:
    records.write.option("compression", "gzip").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def write_arc(pages: DataFrame, path: str, payload: str = "html") -> None:
    """ARC files of ``pages (page_id, url, payload)``, one per partition, of either version in turn."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        version = name = None
        at = 0
        for batch in batches:
            out = []
            for part, page_id, url, text in batch.itertuples(index=False):
                if version is None:
                    version, name = 1 + part % 2, f"part-{part}.arc"
                    out.append(arc_header(name, version).decode())
                    at = len(out[0].encode()) + 1
                page_id = None if pd.isna(page_id) else int(page_id)
                block = http_block(page_id, (text or "").encode())
                record = arc_record(version, name, at, url or f"urn:page:{'' if page_id is None else page_id}", block)
                out.append(record.decode())
                at += len(record) + 1
            yield pd.DataFrame({"value": out})

    rows = pages.select(F.spark_partition_id().alias("part"), F.col("page_id").cast("string").alias("page_id"), "url",
                        payload)
    _write(rows.mapInPandas(run, "value string"), path)


def arc_records(spark: SparkSession, path: str, with_block: bool = True) -> DataFrame:
    """One row per ARC record, with what WARC needs of it."""
    columns = ["record_id", "page_id", "url", "ip", "date", "head", "digest", "size", "truncated", "payload"]
    schema = ("record_id string, page_id bigint, url string, ip string, date string, head binary, digest string, "
              "size bigint, truncated boolean" + ", payload binary" * with_block)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in batch.itertuples(index=False):
                out, held = [], 0
                for r in parse_arc(opened(content)):
                    head, payload = split_http(r.block)
                    ident = http_field(head, ID_FIELD)
                    record = uuid.uuid5(uuid.NAMESPACE_URL, f"{file}#{r.offset}")
                    out.append((f"<urn:uuid:{record}>", int(ident) if ident else None, r.url, r.ip, iso_date(r.date), head,
                                sha1_base32(payload), len(payload), r.truncated, *([payload] * with_block)))
                    held += len(payload) * with_block + 500
                    if held > 4 << 20:
                        yield _frame(out, columns, ["page_id"])
                        out, held = [], 0
                if out:
                    yield _frame(out, columns, ["page_id"])

    return _files(spark, path).mapInPandas(run, schema)


def _frame(rows: list[tuple], columns: list[str], longs: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns[: len(rows[0])])
    return frame.assign(**{c: pd.array([None if pd.isna(x) else int(x) for x in frame[c]], "Int64") for c in longs})


def convert_arc(spark: SparkSession, arc_path: str, warc_path: str, min_revisit_bytes: int = 0) -> None:
    """WARC files with a record for every ARC record; payloads of at least ``min_revisit_bytes`` bytes
    met under a smaller id become revisits."""
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id", "url", "date")
    firsts = store(
        arc_records(spark, arc_path, with_block=False).where(F.col("size") >= min_revisit_bytes)
        .groupBy("digest", "size").agg(F.min(rank).alias("first"))
        .select("digest", "size", F.col("first.record_id").alias("first_id"), F.col("first.url").alias("first_url"),
                F.col("first.date").alias("first_date")), "first-records")
    rows = arc_records(spark, arc_path).join(firsts, ["digest", "size"], "left")
    again = F.col("first_id").isNotNull() & (F.col("first_id") != F.col("record_id"))
    rows = rows.select("record_id", "url", "ip", "date", "head", "digest", "size", "truncated",
                       F.when(again, F.col("first_id")).alias("refers_to"), "first_url", "first_date",
                       F.when(~again, F.col("payload")).alias("payload"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                http = len(r.head) > 0
                headers = [("WARC-Type", ("revisit" if r.refers_to else "response" if http else "resource")),
                           ("WARC-Record-ID", r.record_id), ("WARC-Date", r.date), ("WARC-Target-URI", r.url),
                           ("WARC-IP-Address", r.ip), ("WARC-Payload-Digest", f"sha1:{r.digest}")]
                if r.truncated:
                    headers.append(("WARC-Truncated", "unspecified"))
                if r.refers_to:
                    headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", r.refers_to),
                                ("WARC-Refers-To-Target-URI", r.first_url), ("WARC-Refers-To-Date", r.first_date),
                                ("X-Payload-Bytes", str(r.size))]
                headers.append(("Content-Type", "application/http;msgtype=response" if http else "text/html"))
                out.append(warc_record(headers, bytes(r.head) + (b"" if r.payload is None else bytes(r.payload))))
            yield pd.DataFrame({"value": out})

    _write(rows.mapInPandas(run, "value string"), warc_path)


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per WARC record. ``payload_bytes`` and ``payload_digest`` are of the full payload, for revisits from
    what their headers say; a response whose payload differs from its digest raises."""
    columns = ["record_id", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to_id", "url", "date",
               "payload"]
    schema = ("record_id string, page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
              "refers_to_id string, url string, date string" + ", payload binary" * with_payload)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in batch.itertuples(index=False):
                out, held = [], 0
                for headers, block in parse_warc(opened(content)):
                    head, payload = split_http(block)
                    kind, ident = headers["warc-type"], http_field(head, ID_FIELD)
                    digest = headers["warc-payload-digest"].partition(":")[2]
                    if kind == "revisit":
                        size = int(headers["x-payload-bytes"])
                    else:
                        size = len(payload)
                        if sha1_base32(payload) != digest:
                            raise ValueError(f"{file}: payload of {headers['warc-record-id']} differs from its digest")
                    out.append((headers["warc-record-id"], int(ident) if ident else None, size, digest, kind,
                                headers.get("warc-refers-to"), headers["warc-target-uri"], headers["warc-date"],
                                *([payload] * with_payload)))
                    held += len(payload) * with_payload + 500
                    if held > 4 << 20:
                        yield _frame(out, columns, ["page_id"])
                        out, held = [], 0
                if out:
                    yield _frame(out, columns, ["page_id"])

    return _files(spark, path).mapInPandas(run, schema)


def archive_pages(pages: DataFrame, payload: str = "html") -> str:
    """Write ``pages`` to legacy archives, convert them, and return the folder of the WARC files."""
    spark = pages.sparkSession
    arc, warc = shared_dir(spark, "arc"), shared_dir(spark, "warc")
    write_arc(pages, arc, payload)
    convert_arc(spark, arc, warc)
    return warc


def page_records(pages: DataFrame, payload: str = "html") -> DataFrame:
    """Per page what its archive record says, with the page that a revisit refers to."""
    records = store(read_warc(pages.sparkSession, archive_pages(pages, payload)), "warc-records")
    named = records.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    return records.join(named, "refers_to_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "record_id")

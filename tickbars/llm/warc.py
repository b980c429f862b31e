"""WARC archives of web pages: a writer, and a reader that salvages damaged ones.

A page becomes a response record, or a revisit record where another page with
the same payload has the response. Each record is a gzip member of its own;
Spark's text writer puts them on whatever file system the folder is on, with
an empty gzip member as separator, so that the files are ordinary .warc.gz.

The reader takes an archive apart record by record. Where a member does not
inflate, a length is wrong or a digest differs, it searches for the next gzip
member or version line that starts a valid record, goes on from there and
reports the bytes in between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the formats: gzip magic, version line, white space between records, HTTP header.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
END = b"\r\n\r\n"
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
CHUNK = 1 << 16
PAGE = re.compile(rb"<urn:x-page:(-?\d+)>")

RECORD = "archive string, offset long, page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


@dataclass(frozen=True)
class WarcSpec:
    """``revisit_from``: payload bytes from which equal payloads are stored once; ``records``: records per archive."""

    revisit_from: int = 1000
    records: int = 2000
    date: str = "2024-01-01T00:00:00Z"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, spec: WarcSpec) -> bytes:
    """One record as it stands in an archive before compression."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'none' if page_id is None else page_id}>",
        f"WARC-Date: {spec.date}",
        f"WARC-Payload-Digest: {_sha1(payload)}",
        f"WARC-Block-Digest: {_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=":/?#[]@!$&'()*+,;=%~-._")}")
        if re.search(r"[^\x21-\x7e]", url):
            lines.append(f"X-Target-Text: {base64.b64encode(url.encode()).decode()}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode() + END + block + END


def _member(record: bytes) -> bytes:
    packer = zlib.compressobj(wbits=31)
    return packer.compress(record) + packer.flush()


def write_archives(pages: DataFrame, folder: str, spec: WarcSpec = WarcSpec()) -> None:
    """Writes (page_id, url, html) as gzipped archives into ``folder``.

    Of equal payloads of ``revisit_from`` bytes or more the record of the
    largest page_id is the response. Rows with that page_id, or all of them
    where none has one, are responses. A null html is an empty payload.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    digests = rows.where(F.length("payload") >= spec.revisit_from).select("page_id", F.sha1("payload").alias("digest"), F.length("payload").alias("n"))
    heads = digests.groupBy("digest", "n").agg(F.max("page_id").alias("head"), F.count("*").alias("copies")).where("copies > 1 AND head IS NOT NULL")
    known = digests.join(heads.hint("merge"), ["digest", "n"]).where("page_id <> head").select("page_id", "digest", F.col("head").alias("refers_to")).distinct()
    # A page without an id has nothing to be joined by; its revisits are found by digest below.
    lone = rows.where("page_id IS NULL").withColumn("digest", F.sha1("payload")).withColumn("n", F.length("payload"))
    lone = lone.join(heads.hint("merge"), ["digest", "n"], "left").select("page_id", "url", "payload", F.col("head").alias("refers_to"))
    given = rows.where("page_id IS NOT NULL").withColumn("digest", F.sha1("payload"))
    given = given.join(known.hint("merge"), ["page_id", "digest"], "left").select("page_id", "url", "payload", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = [_member(record_bytes(*row, spec)) for row in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], names=["member"])

    members = given.union(lone).mapInArrow(run, "member binary").select(F.col("member").cast("string").alias("value"))
    separator = EMPTY_MEMBER.decode("latin-1")
    writer = members.write.option("encoding", "ISO-8859-1").option("lineSep", separator).option("maxRecordsPerFile", spec.records)
    writer.text(folder)


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    block: bytes


@dataclass
class Gap:
    start: int
    end: int
    reason: str


def _inflate(data: bytes, at: int) -> tuple[bytes, int] | None:
    """(content, end) of the gzip member at ``at``; None where it is damaged."""
    unpacker, parts = zlib.decompressobj(31), []
    try:
        while not unpacker.eof:
            if at >= len(data):
                return None
            piece = data[at : at + CHUNK]
            parts.append(unpacker.decompress(piece))
            at += len(piece)
    except zlib.error:
        return None
    return b"".join(parts), at - len(unpacker.unused_data)


def _plain(data: bytes, at: int) -> tuple[dict[str, str], bytes, int] | str:
    """(headers, block, end) of the record at ``at``, or what is wrong with it."""
    stop = data.find(END, at)
    if not data.startswith(VERSION, at) or stop < 0:
        return "no header"
    headers = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "broken header"
        headers[name.decode("latin-1").strip().lower()] = value.decode("latin-1").strip()
    size = headers.get("content-length", "")
    if not size.isdigit() or "warc-type" not in headers or "warc-record-id" not in headers:
        return "missing header"
    start, end = stop + 4, stop + 4 + int(size)
    if end > len(data) or data[end : end + 4] != END:
        return "wrong length"
    block = data[start:end]
    if headers.get("warc-block-digest", "sha1:").startswith("sha1:") and headers.get("warc-block-digest", _sha1(block)) != _sha1(block):
        return "wrong digest"
    return headers, block, end + 4


def _at(data: bytes, at: int) -> tuple[list[Record], int] | str:
    """The records of the member or the record at ``at`` and where it ends, or what is wrong."""
    if not data.startswith(MAGIC, at):
        found = _plain(data, at)
        return found if isinstance(found, str) else ([Record(at, *found[:2])], found[2])
    member = _inflate(data, at)
    if member is None:
        return "broken member"
    content, end = member
    records, inner = [], 0
    while inner < len(content):
        found = _plain(content, inner)
        if isinstance(found, str):
            return found
        records.append(Record(at, *found[:2]))
        inner = found[2]
    return records, end


def read_archive(data: bytes) -> Iterator[Record | Gap]:
    """Records of an archive, plain or gzipped or both, and the gaps where none can be read."""
    at, lost, why = 0, None, ""
    while at < len(data):
        if lost is None and data[at : at + 1] in b"\r\n":
            at += 1
            continue
        found = _at(data, at)
        if isinstance(found, str):
            if lost is None:
                lost, why = at, found
            places = [p for p in (data.find(MAGIC, at + 1), data.find(VERSION, at + 1)) if p >= 0]
            at = min(places, default=len(data))
            continue
        if lost is not None:
            yield Gap(lost, at, why)
            lost = None
        yield from found[0]
        at = found[1]
    if lost is not None:
        yield Gap(lost, len(data), why)


def _page(value: str | None) -> int | None:
    found = PAGE.fullmatch((value or "").encode())
    return int(found[1]) if found else None


def _hex_digest(stated: str) -> str | None:
    """SHA-1 in hex of a stated digest, in base 32 or in hex; null if it is neither."""
    name, _, value = stated.partition(":")
    if name.lower() != "sha1":
        return None
    if re.fullmatch(r"[0-9a-fA-F]{40}", value):
        return value.lower()
    return base64.b32decode(value.upper()).hex() if re.fullmatch(r"[A-Za-z2-7]{32}", value) else None


def _target(headers: dict[str, str]) -> str | None:
    try:
        return base64.b64decode(headers["x-target-text"], validate=True).decode()
    except (KeyError, ValueError):
        return headers.get("warc-target-uri")


def _row(record: Record) -> tuple:
    head, _, body = record.block.partition(END)
    kind = record.headers["warc-type"]
    length = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    revisit = kind == "revisit"
    stated = record.headers.get("warc-payload-digest", "")
    digest = _hex_digest(stated) if revisit and stated else hashlib.sha1(body).hexdigest()
    url = _target(record.headers)
    size = int(length[1]) if revisit and length else len(body)
    return _page(record.headers["warc-record-id"]), url, kind, _page(record.headers.get("warc-refers-to")), digest, size, None if revisit else body


def read_archives(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(records, gaps) of every archive in ``folder``.

    gaps: archive, start, end and reason of the bytes that were quarantined.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")

    def records(batches):
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows = [(path, r.offset, *_row(r)) for r in read_archive(data.as_py()) if isinstance(r, Record)]
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
                names = [part.split()[0] for part in RECORD.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names=names)

    def gaps(batches):
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows = [(path, g.start, g.end, g.reason) for g in read_archive(data.as_py()) if isinstance(g, Gap)]
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, kinds)], names=["archive", "start", "end", "reason"])

    return files.mapInArrow(records, RECORD), files.mapInArrow(gaps, "archive string, start long, end long, reason string")

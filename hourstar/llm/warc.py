"""Writing WARC archives, and reading them back, damaged ones too.

**Writing.** Every row becomes a record in a gzip member of its own. Of rows with equal payloads those with the
smallest id are responses, the others revisits without a payload; the smallest ids are found by payload
digest before any payload moves, and the join on the digest is one that Spark may split where many rows have
one payload. Archives are written by Spark's text writer, which commits whole files only: a lost
executor leaves no half archive. The writer ends each row with a line separator; here that is the zero byte
that ends every gzip member of less than 16 MB (the top byte of its size). Longer records end with an empty
member, as gzip allows, whose last byte is zero too.

An archive ends when its members reach ``archive_bytes`` (a longer record has one to itself) or ``records_per_file``:
each task numbers its archives as it goes, and the writer gives each number a folder.

**Reading.** Archives are read whole, one at a time, which those bounds allow; records leave one by one. A member must decompress with its
checksum, begin with the version line, and hold as many bytes as its ``Content-Length`` says, with two line
ends behind; a response must match its payload digest. After a failed check the reader searches for the next gzip
header that starts a member which decompresses to a version line, takes up there, and logs the bytes between as quarantined, with
the reason; a ``strict`` reader fails instead. An uncompressed archive is read likewise, by its version lines. So damage costs the records it touches, no others.

Defined results. Null or empty payloads: an empty payload, equal to all others of its kind. Null ids: revisits of the
smallest id with their payload, responses if there is none. Repeated rows of the smallest id are all
responses. Payloads of any length are stored whole. Empty table: an empty archive folder, no records. Other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourstar.llm.batches import pieces

VERSION = b"WARC/1.0"
MEMBER = b"\x1f\x8b\x08"
EMPTY_MEMBER = bytes((31, 139, 8, 0, 0, 0, 0, 0, 0, 3, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0))
SMALL = 1 << 24
ARCHIVE_BYTES = 64 << 20
BATCH_BYTES = 4 << 20  # payloads in a batch of records read, unless one is longer
SLICE = 1 << 14  # bytes of an archive that are decompressed at once
EPOCH = "1970-01-01T00:00:00Z"
_START = re.compile(rb"WARC/1\.[01]\r\n")
COLUMNS = "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_value(text: str | None) -> str:
    """A header must stay on its line."""
    return re.sub(r"[\r\n\x00]", lambda m: f"%{ord(m.group()):02X}", text or "")


def record(page: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    kind, body = ("response", payload) if refers_to is None else ("revisit", b"")
    name = digest(payload)
    lines = [
        VERSION.decode(),
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{header_value(page)}>",
        f"WARC-Date: {EPOCH}",
        f"WARC-Payload-Digest: sha1:{name}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Type: {'text/html' if kind == 'response' else 'application/http'}",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        lines.insert(3, f"WARC-Target-URI: {header_value(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member that ends with a zero byte."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    packed = packer.compress(data) + packer.flush()
    return packed if len(data) < SMALL else packed + EMPTY_MEMBER


class Found(NamedTuple):
    page_id: str | None
    url: str | None
    record_type: str
    refers_to: str | None
    payload_bytes: int
    payload_digest: str
    payload: bytes


class Gap(NamedTuple):
    start: int
    end: int
    reason: str


class Damaged(Exception):
    pass


def parse_record(data: bytes, at: int = 0) -> tuple[Found, int]:
    """The record at ``at`` and its end."""
    if not _START.match(data, at):
        raise Damaged("no version line")
    ending = data.find(b"\r\n\r\n", at)
    if ending < 0:
        raise Damaged("header without end")
    try:
        pairs = (line.split(": ", 1) for line in data[at:ending].decode().split("\r\n")[1:])
        headers = {name.lower(): value for name, value in pairs}
        length, full = int(headers["content-length"]), int(headers["x-payload-length"])
        kind, name = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
        page = headers["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")
    except (ValueError, KeyError) as error:
        raise Damaged("header cannot be read") from error
    body = data[ending + 4 : ending + 4 + length]
    end = ending + 4 + length + 4
    if length < 0 or data[end - 4 : end] != b"\r\n\r\n":
        raise Damaged("length does not fit")
    if kind == "response" and (digest(body) != name or len(body) != full):
        raise Damaged("payload digest does not fit")
    refers = headers.get("warc-refers-to")
    refers = refers.removeprefix("<urn:page:").removesuffix(">") if refers else None
    return Found(page or None, headers.get("warc-target-uri"), kind, refers, full, name, body), end


def unpack(data: bytes, at: int) -> tuple[bytes, int]:
    """The decompressed member at ``at`` and its end. Read in slices: what follows the member is not copied."""
    unpacker, parts = zlib.decompressobj(31), []
    try:
        while at < len(data) and not unpacker.eof:
            part = data[at : at + SLICE]
            parts.append(unpacker.decompress(part))
            at += len(part)
    except zlib.error as error:
        raise Damaged("member cannot be decompressed") from error
    if not unpacker.eof:
        raise Damaged("member is cut off")
    return b"".join(parts), at - len(unpacker.unused_data)


def starts_record(data: bytes, at: int) -> bool:
    """Whether a member at ``at`` begins with a version line; reads its first bytes only."""
    try:
        return bool(_START.match(zlib.decompressobj(31).decompress(data[at : at + 512], 64)))
    except zlib.error:
        return False


def scan(data: bytes) -> Iterator[Found | Gap]:
    """The records of an archive that pass their checks and the gaps between them, in order."""
    packed = starts_record(data, 0) or not _START.match(data) and MEMBER in data
    at = 0
    while at < len(data):
        try:
            if packed:
                out, end = unpack(data, at)
                if out:  # an empty member only ends a long record
                    entry, used = parse_record(out)
                    if used != len(out):
                        raise Damaged("bytes behind the record")
                    yield entry
            else:
                entry, end = parse_record(data, at)
                yield entry
            at = end
        except Damaged as damage:
            following = at + 1
            while True:
                if packed:
                    following = data.find(MEMBER, following)
                else:
                    match = _START.search(data, following)
                    following = match.start() if match else -1
                if following < 0 or not packed or starts_record(data, following):
                    break
                following += 1
            following = following if following >= 0 else len(data)
            yield Gap(at, following, str(damage))
            at = following


def salvage(data: bytes) -> tuple[list[Found], list[Gap]]:
    """All records and all gaps of an archive."""
    entries = list(scan(data))
    return [e for e in entries if isinstance(e, Found)], [e for e in entries if isinstance(e, Gap)]


def with_originals(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """``id, url, payload, refers_to``: the smallest id with an equal payload, null for that id itself."""
    rows = pages.select(
        pages[id_col].alias("id"), pages[url_col].alias("url"),
        F.coalesce(pages[payload_col], F.lit("")).cast("binary").alias("payload"),
    ).withColumn("key", F.sha1("payload"))
    # Only groups of more than one row have revisits; all others need no partner.
    first = rows.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    joined = rows.join(first.select("key", "first"), "key", "left")
    return joined.select("id", "url", "payload", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_archives(
    pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    records_per_file: int = 5000, archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write one record per row into archives below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, used = 0, 0
        for piece, _ in pieces(batches, 2):
            columns = [c.to_pylist() for c in piece.columns]
            packed = [member(record(i, url, body or b"", refers)) for i, url, body, refers in zip(*columns)]
            numbers = []
            for each in packed:
                if used and used + len(each) > archive_bytes:
                    number, used = number + 1, 0
                used += len(each)
                numbers.append(number)
            # The zero byte at the end is the writer's line separator.
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array([p[:-1] for p in packed], pa.binary())], ["archive", "value"])

    rows = with_originals(pages, id_col, url_col, payload_col)
    rows = rows.select(F.col("id").cast("string"), "url", "payload", F.col("refers_to").cast("string"))
    members = rows.mapInArrow(run, "archive int, value binary").select("archive", F.col("value").cast("string"))
    members.write.option("lineSep", "\0").option("maxRecordsPerFile", records_per_file).partitionBy("archive").text(path)


def read_archives(spark: SparkSession, path: str, *, payloads: bool = True, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """The records of all archives below ``path`` (see COLUMNS), and their gaps: ``path, start, end, reason``.

    Without ``payloads`` that column is null, and payloads do not leave the reading task. With ``strict`` a gap ends the
    job that reads the records, so that archives known to be whole need no second look at their gaps.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([(n, pa.string()) for n in ("page_id", "url", "record_type", "refers_to")]
                          + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
        held: list[dict] = []
        size = 0
        for batch in batches:
            for place, content in zip(batch.column(0), batch.column(1)):
                for entry in scan(content.as_buffer().to_pybytes()):
                    if isinstance(entry, Gap):
                        if strict:
                            raise Damaged(f"{place.as_py()}: bytes {entry.start} to {entry.end}: {entry.reason}")
                        continue
                    if not payloads:
                        entry = entry._replace(payload=None)
                    held.append(entry._asdict())
                    size += len(entry.payload or b"")
                    if size >= BATCH_BYTES or len(held) == 256:
                        yield pa.RecordBatch.from_pylist(held, kinds)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, kinds)

    def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, content in zip(batch.column(0), batch.column(1)):
                lost = [g for g in scan(content.as_buffer().to_pybytes()) if isinstance(g, Gap)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([place.as_py()] * len(lost), pa.string()), pa.array([g.start for g in lost], pa.int64()),
                     pa.array([g.end for g in lost], pa.int64()), pa.array([g.reason for g in lost], pa.string())],
                    ["path", "start", "end", "reason"],
                )

    return files.mapInArrow(records, COLUMNS), files.mapInArrow(gaps, "path string, start long, end long, reason string")

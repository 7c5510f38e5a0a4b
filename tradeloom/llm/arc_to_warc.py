"""Convert legacy ARC archives to WARC, with revisits for repeated payloads.

An ARC file begins with a version block. Its first line says how many bytes
follow, the block names the version and the fields of the record headers.
Version 1 headers have five fields, version 2 ten; both end with the declared
length of the record. A record is read by that length, never by searching.

The converter makes up what ARC lacks: record ids from the archive's own name
and the record's number, ISO timestamps from the digits, types from scheme and
body, and digests. Conversion takes three passes, so that payloads are never
shuffled: an index of all records (number, digest, length), the first record
of every repeated digest, and the writing, file by file, with the few facts
that a file's revisits need.

Archives are compressed record by record. Tasks write files under names of
their own; a file counts only through the manifest of the tasks that ended, so
lost and repeated tasks do no harm.
"""

from __future__ import annotations

import gzip
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import new_folder, one_task_each, open_for_reading, open_for_writing, stage, text_slices

FILE_BYTES = 16 << 20
LEAST_REVISIT_BYTES = 100
KEY_HEADER = "X-Page-Id"
NO_URL = "http://invalid/"
# Fixed values of the two versions of the format.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = ("http:", "https")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def _packed(data: bytes) -> bytes:
    return gzip.compress(data, compresslevel=1, mtime=0)


def _plain(path: str) -> BinaryIO:
    """The uncompressed bytes of an archive, compressed or not."""
    file = open_for_reading(path)
    magic = file.read(2)
    file.seek(0)
    return gzip.GzipFile(fileobj=file) if magic == b"\x1f\x8b" else file


def _exactly(stream: BinaryIO, size: int) -> bytes:
    data = stream.read(size)
    if len(data) != size:
        raise ValueError(f"archive ends {size - len(data)} bytes early")
    return data


def _line(stream: BinaryIO) -> bytes:
    """The next line, without its end; empty at the end of the file."""
    if isinstance(stream, gzip.GzipFile):
        return stream.readline()
    line = b""
    while not line.endswith(b"\n") and (char := stream.read(1)):
        line += char
    return line


# ---------------------------------------------------------------- ARC


@dataclass(frozen=True)
class ArcRecord:
    number: int
    url: str
    ip: str
    date: str  # digits
    mime: str
    body: bytes


def arc_head(name: str, version: int, date: str) -> bytes:
    block = f"{version} 0 tradeloom\n{ARC_FIELDS[version]}\n".encode()
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {len(block)}\n".encode() + block + b"\n"


def arc_record(version: int, url: str, ip: str, date: str, mime: str, body: bytes, at: int = 0, name: str = "-") -> bytes:
    url = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)
    more = "" if version == 1 else f" 200 {zlib.crc32(body):08x} - {at} {name}"
    return f"{url} {ip} {date} {mime}{more} {len(body)}\n".encode() + body + b"\n"


def read_arc(stream: BinaryIO) -> tuple[str, Iterator[ArcRecord]]:
    """Name of the archive and its records.

    Fields are counted from the right, since urls of old archives hold spaces.
    """
    head = _line(stream).decode("utf-8", "replace").split()
    if len(head) < 5 or not head[0].startswith("filedesc:"):
        raise ValueError("not an ARC file")
    block = _exactly(stream, int(head[-1])).decode("utf-8", "replace").splitlines()
    version = int(block[0].split()[0])
    fields = (block[1] if len(block) > 1 else ARC_FIELDS[version]).split()

    def records() -> Iterator[ArcRecord]:
        number = 0
        while line := _line(stream):
            if not line.strip():
                continue  # records are followed by an empty line
            parts = line.decode("utf-8", "replace").rstrip("\r\n").rsplit(" ", len(fields) - 1)
            if len(parts) != len(fields):
                raise ValueError(f"header line without {len(fields)} fields: {line[:200]!r}")
            own = dict(zip(fields, parts, strict=True))
            body = _exactly(stream, int(own["Archive-length"]))
            yield ArcRecord(number, own["URL"], own["IP-address"], own["Archive-date"], own["Content-type"], body)
            number += 1

    return head[0].removeprefix("filedesc://"), records()


# ---------------------------------------------------------------- WARC


def iso_date(digits: str) -> str:
    """``YYYYMMDDhhmmss`` as ISO; missing or impossible parts become the least."""
    digits = (re.sub(r"\D", "", digits) + "0" * 14)[:14]
    parts = [int(digits[:4]), *(int(digits[i : i + 2]) for i in range(4, 14, 2))]
    low, high = (1, 1, 1, 0, 0, 0), (9999, 12, 31, 23, 59, 59)
    year, month, day, hour, minute, second = (min(max(p, a), b) for p, a, b in zip(parts, low, high, strict=True))
    return f"{year:04d}-{month:02d}-{day:02d}T{hour:02d}:{minute:02d}:{second:02d}Z"


def record_id(archive: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{number}')}>"


@dataclass(frozen=True)
class Parts:
    """What a record's body consists of."""

    kind: str  # response or resource
    head: bytes  # HTTP status line and headers with the empty line
    payload: bytes
    key: int | None

    @property
    def digest(self) -> str:
        return hashlib.sha256(self.payload).hexdigest()


def parts_of(record: ArcRecord, key_header: str = KEY_HEADER) -> Parts:
    """An http record with a status line is a response, all others are resources."""
    if record.url[:5].lower() not in _HTTP or not record.body.startswith(b"HTTP/"):
        return Parts("resource", b"", record.body, None)
    head, empty_line, payload = record.body.partition(b"\r\n\r\n")
    found = re.search(rb"(?im)^%s:[ \t]*(-?\d+)[ \t]*\r?$" % re.escape(key_header.encode()), head)
    return Parts("response", head + empty_line, payload, int(found[1]) if found else None)


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def read_warc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower case) and block of each record."""
    while line := _line(stream):
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        fields: dict[str, str] = {}
        while (line := _line(stream).rstrip(b"\r\n")) != b"":
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, _exactly(stream, int(fields["content-length"]))


def _warc_fields(kind: str, record: ArcRecord, identifier: str, parts: Parts, digest: str, block: bytes) -> list[tuple[str, str]]:
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", identifier),
        ("WARC-Target-URI", record.url),
        ("WARC-Date", iso_date(record.date)),
    ]
    if record.ip not in ("-", "0.0.0.0"):
        fields.append(("WARC-IP-Address", record.ip))
    return [
        *fields,
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http;msgtype=response" if parts.head else record.mime),
        ("X-Payload-Length", str(len(parts.payload))),
    ]


class _Archive:
    """A file being written; complete when closed."""

    def __init__(self, folder: str, name: str, head: bytes):
        self.path = os.path.join(folder, f"{name}-{uuid.uuid4().hex}")
        self.out = open_for_writing(self.path)
        self.size = self.records = 0
        self.add(head)

    def add(self, record: bytes, counts: int = 0) -> None:
        self.size += self.out.write(_packed(record))
        self.records += counts

    def close(self) -> dict[str, list]:
        self.out.close()
        return {"path": [self.path], "records": [self.records]}


_FILES = "path string, records long"
_FILES_ARROW = pa.schema([("path", pa.string()), ("records", pa.int64())])


def _file_row(archive: _Archive) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(archive.close(), schema=_FILES_ARROW)


# ---------------------------------------------------------------- Spark


def write_arc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date: str = "20240101000000",
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write pages as ARC files, versions 1 and 2 in turn; returns ``(path, records)``.

    Each page is one record, an HTTP response whose header names the page's id
    if it has one. NULL html is an empty payload. A url that is not http or
    https stands behind ``http://invalid/``, NULL is that url alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, files, archive, version, name = TaskContext.get().partitionId(), 0, None, 1, ""
        for batch in text_slices(batches, "html"):
            rows = zip(*(batch.column(c).to_pylist() for c in ("id", "url", "html")), strict=True)
            for key, url, html in rows:
                if archive is None:
                    version, name = 1 + (part + files) % 2, f"part-{part:05d}-{files:05d}.arc"
                    archive = _Archive(folder, name, arc_head(name, version, date))
                if url[:5].lower() not in _HTTP:
                    url = NO_URL + url
                payload = html.encode("utf-8", "replace")
                known = "" if key is None else f"{KEY_HEADER}: {key}\r\n"
                head = (
                    f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{known}"
                    f"Content-Length: {len(payload)}\r\n\r\n"
                )
                body = head.encode() + payload
                archive.add(arc_record(version, url, "127.0.0.1", date, "text/html", body, archive.size, name), 1)
                if archive.size >= file_bytes:
                    yield _file_row(archive)
                    files, archive = files + 1, None
        if archive is not None:
            yield _file_row(archive)

    rows = pages.select(
        pages[id_col].cast("long").alias("id"),
        F.coalesce(F.trim(pages[url_col].cast("string")), F.lit("")).alias("url"),
        F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html"),
    )
    return stage(rows.mapInArrow(run, _FILES), "arc-files")


_INDEX = (
    "path string, number int, key long, kind string, payload_bytes long, digest string, record_id string, "
    "url string, date string"
)


def index_arc(files: DataFrame, key_header: str = KEY_HEADER) -> DataFrame:
    """One row per record of the ARC files; payloads stay where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                with _plain(path) as stream:
                    name, records = read_arc(stream)
                    for r in records:
                        p = parts_of(r, key_header)
                        identifier = record_id(name, r.number)
                        rows.append((path, r.number, p.key, p.kind, len(p.payload), p.digest, identifier, r.url, iso_date(r.date)))
                names = [c.split()[0] for c in _INDEX.split(", ")]
                kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 4]
                columns = zip(*rows, strict=True) if rows else [()] * len(names)
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return one_task_each(files.select("path")).mapInArrow(run, _INDEX)


_FACTS = "struct<number:int,key:long,record_id:string,url:string,date:string>"


def revisits(index: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """``(path, found)``: per ARC file, its revisits and the records they refer to.

    Of the responses with one payload of ``least_bytes`` or more, the one with
    the smallest key comes first, without a key last, then by file and number.
    Copies meet in partial sums; the join back has two shuffled sides that
    adaptive execution can split.
    """
    large = index.where((F.col("kind") == "response") & (F.col("payload_bytes") >= least_bytes))
    order = F.struct(F.col("key").isNull().alias("none"), "key", "record_id", "path", "number", "url", "date")
    first = large.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    first = stage(first.where("n > 1").drop("n"), "repeated")
    same = (F.col("path") == F.col("first.path")) & (F.col("number") == F.col("first.number"))
    later = large.select("digest", "path", "number").join(first, "digest").where(~same)
    facts = F.struct("number", *(F.col(f"first.{c}").alias(c) for c in ("key", "record_id", "url", "date")))
    # a list holds records of one file at most
    return later.groupBy("path").agg(F.collect_list(facts).alias("found"))


def convert(files: DataFrame, folder: str, key_header: str = KEY_HEADER, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Convert ARC files to WARC files; returns ``(path, records)``."""
    index = stage(index_arc(files, key_header), "arc-index")
    found = stage(revisits(index, least_bytes), "revisits")
    work = files.select("path").join(found, "path", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, listed in zip(batch.column("path").to_pylist(), batch.column("found").to_pylist(), strict=True):
                facts = {f["number"]: f for f in listed or ()}
                with _plain(path) as stream:
                    yield _file_row(_converted(stream, folder, facts, key_header))

    return stage(one_task_each(work).mapInArrow(run, _FILES), "warc-files")


def _converted(stream: BinaryIO, folder: str, facts: dict[int, dict], key_header: str) -> _Archive:
    name, records = read_arc(stream)
    info = f"software: tradeloom\r\nformat: WARC File Format 1.1\r\nsource: {name}\r\n".encode()
    head = [
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", record_id(name, -1)),
        ("WARC-Date", iso_date("")),
        ("Content-Type", "application/warc-fields"),
    ]
    archive = _Archive(folder, f"{os.path.basename(name)}.warc.gz", warc_record(head, info))
    for r in records:
        parts = parts_of(r, key_header)
        fact = facts.get(r.number)
        block = parts.head if fact else r.body
        kind = "revisit" if fact else parts.kind
        fields = _warc_fields(kind, r, record_id(name, r.number), parts, parts.digest, block)
        if fact:
            fields += [
                ("WARC-Profile", REVISIT_PROFILE),
                ("WARC-Refers-To", fact["record_id"]),
                ("WARC-Refers-To-Target-URI", fact["url"]),
                ("WARC-Refers-To-Date", fact["date"]),
            ]
            if fact["key"] is not None:
                fields.append(("X-Refers-To-Key", str(fact["key"])))
        archive.add(warc_record(fields, block), 1)
    return archive


_ROWS = "id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, url string"


def read_back(files: DataFrame, key_header: str = KEY_HEADER) -> DataFrame:
    """One row per record of the WARC files but the first of each file.

    Digests of blocks and payloads are computed again; a record that does not
    match its own raises. A revisit has the length and digest of its payload
    from its header.
    """
    pattern = re.compile(rb"(?im)^%s:[ \t]*(-?\d+)[ \t]*\r?$" % re.escape(key_header.encode()))

    def row(fields: dict[str, str], block: bytes) -> tuple:
        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
        http = fields["content-type"].startswith("application/http")
        head, _, payload = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
        size = int(fields["x-payload-length"])
        if hashlib.sha256(block).hexdigest() != fields["warc-block-digest"].removeprefix("sha256:"):
            raise ValueError(f"{fields['warc-record-id']}: the block does not match its digest")
        if kind != "revisit" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
            raise ValueError(f"{fields['warc-record-id']}: the payload does not match its digest")
        key, refers = pattern.search(head), fields.get("x-refers-to-key")
        return (
            int(key[1]) if key else None, size, digest, kind, int(refers) if refers else None,
            fields["warc-record-id"], fields["warc-target-uri"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _ROWS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with _plain(path) as stream:
                    rows = [row(f, b) for f, b in read_warc(stream) if f["warc-type"] != "warcinfo"]
                columns = zip(*rows, strict=True) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return one_task_each(files.select("path")).mapInArrow(run, _ROWS)


def pages_through_archives(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Pages to ARC files, converted to WARC files, read back; one row per page.

    Repeated rows are records of their own, so all but one revisit the first,
    and a revisit of a page without id has no ``refers_to``. An empty table
    gives no files and no rows. Other columns are not read.
    """
    arc = write_arc(pages, new_folder(pages.sparkSession, "arc"), id_col, url_col, html_col, file_bytes=file_bytes)
    return read_back(convert(arc, new_folder(pages.sparkSession, "warc")))

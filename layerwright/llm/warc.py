"""WARC archives: a writer with revisit records, and a reader that salvages what it can.

Every record is a gzip member of its own. The reader checks each member and record; where a check fails it
searches for the next place where a valid member (or, in plain archives, a valid version line) starts, goes on
from there, and reports the bytes in between as a quarantined gap.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.common import small_batches
from layerwright.llm.files import file_system, new_file
from layerwright.operators.joins import split_lookup
from layerwright.session import scratch_path, stage

VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVE_BYTES = 64 << 20
CHUNK = 256 << 10
HEADER_MOST = 1 << 20
VERSION_MOST = 16
_MEMBER = b"\x1f\x8b\x08"
_VERSION_LINE = re.compile(rb"WARC/\d{1,3}\.\d{1,3}\r\n")


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record. A revisit keeps the HTTP header, which tells the payload's length, and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = "null" if page_id is None else str(page_id)
    lines = [
        VERSION.decode(),
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += [
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        f"WARC-Block-Digest: sha1:{digest_of(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _length(header: bytes) -> bytes:
    for line in header.split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return value.strip()
    return b"0"


class BadRecord(ValueError):
    """A record that fails a check. ``stated_end``: where its block should end, as far as its header can be read."""

    def __init__(self, reason: str, stated_end: int = -1):
        super().__init__(reason)
        self.stated_end = stated_end


class _Source:
    """Random reads over an open file through a window of one chunk, or over bytes."""

    def __init__(self, file, size: int):
        self.file, self.size, self.window, self.window_start = file, size, b"", 0

    @classmethod
    def of(cls, data: bytes) -> "_Source":
        made = cls(None, len(data))
        made.window = data
        return made

    def at(self, start: int, length: int) -> bytes:
        length = max(0, min(length, self.size - start))
        if start < self.window_start or start + length > self.window_start + len(self.window):
            self.file.seek(start)
            self.window, self.window_start = self.file.read(max(length, CHUNK)), start
        place = start - self.window_start
        return self.window[place : place + length]

    def find(self, wanted: bytes, start: int) -> int:
        while start < self.size:
            chunk = self.at(start, CHUNK)
            hit = chunk.find(wanted)
            if hit >= 0:
                return start + hit
            if start + len(chunk) >= self.size:
                break
            start += len(chunk) - len(wanted) + 1
        return -1

    def find_version(self, start: int, expected: int) -> int:
        """The next version line that begins a line or stands at ``expected``; ``start`` is above 0."""
        while start < self.size:
            chunk = self.at(start - 1, CHUNK)
            for hit in _VERSION_LINE.finditer(chunk, 1):
                place = start - 1 + hit.start()
                if place == expected or chunk[hit.start() - 1] == 0x0A:
                    return place
            if start - 1 + len(chunk) >= self.size:
                break
            start += len(chunk) - 1 - VERSION_MOST
        return -1


def read_record(source: _Source, start: int) -> tuple[dict[str, str], bytes, int]:
    """Header fields (lower-case names), block and end of the record at ``start``. Raises BadRecord.

    Headers end within ``HEADER_MOST`` bytes. A block whose digest is right counts even if the blank lines after it
    are damaged; the record then ends with its block.
    """
    length = 16 << 10
    while True:
        head = source.at(start, length)
        head_end = head.find(b"\r\n\r\n")
        if not _VERSION_LINE.match(head) or (head_end < 0 and (length >= HEADER_MOST or len(head) < length)):
            raise BadRecord("no header")
        if head_end >= 0:
            break
        length *= 4
    lines = head[:head_end].split(b"\r\n")[1:]
    if any(b":" not in line for line in lines):
        raise BadRecord("broken header")
    fields = {
        name.decode("utf-8", "replace").strip().lower(): value.decode("utf-8", "replace").strip()
        for name, value in (line.split(b":", 1) for line in lines)
    }
    stated = fields.get("content-length", "")
    if not (stated.isascii() and stated.isdigit()) or "warc-type" not in fields:
        raise BadRecord("header without length or type")
    end = start + head_end + 4 + int(stated)
    if end > source.size:
        raise BadRecord("block cut short", end)
    block = source.at(start + head_end + 4, int(stated))
    digest, whole = fields.get("warc-block-digest", ""), source.at(end, 4) == b"\r\n\r\n"
    if digest.startswith("sha1:"):
        if digest[5:] != digest_of(block):
            raise BadRecord("block digest", end)
    elif not whole:
        raise BadRecord("block cut short", end)
    return fields, block, end + 4 if whole else end


@dataclass(frozen=True)
class Found:
    """A record or a gap in an archive.

    ``start`` and ``end`` are bytes of the file; ``inner`` the bytes of the unpacked member they are about, if any.
    ``doubtful``: the record stands inside the stated block of a damaged one, so it may be part of a payload, or
    its member is damaged and it states no digest that would prove it.
    """

    kind: str
    start: int
    end: int
    reason: str | None = None
    fields: dict[str, str] | None = None
    block: bytes = b""
    inner: tuple[int, int] | None = None
    doubtful: bool = False


def _records(source: _Source, fault: str = "") -> Iterator[Found]:
    """Records and gaps of plain bytes. ``fault``: what ended the bytes before their time."""
    place, bad_from, reason, stated_end, expected = 0, None, "", -1, 0
    while 0 <= place < source.size:
        try:
            fields, block, end = read_record(source, place)
        except BadRecord as error:
            if bad_from is None:
                bad_from, reason = place, str(error)
            if error.stated_end >= 0:
                stated_end, expected = max(stated_end, error.stated_end), error.stated_end + 4
            place = source.find_version(place + 1, expected)
            continue
        if bad_from is not None:
            yield Found("gap", bad_from, place, reason)
            bad_from = None
        proved = fields.get("warc-block-digest", "").startswith("sha1:")
        doubtful = place < stated_end or (bool(fault) and not proved)
        yield Found("record", place, end, None, fields, block, None, doubtful)
        place, expected = end, end + 4
    if bad_from is not None or fault:
        yield Found("gap", source.size if bad_from is None else bad_from, source.size, fault or reason)


def _gzip_member(source: _Source, start: int) -> tuple[bytes, int, str]:
    """What the member at ``start`` unpacks to, where it ends, and the fault that ended it early, if any.

    Checksum and length are verified. Before a fault all is unpacked that can be, to the byte.
    """
    unpacker, parts, place, step = zlib.decompressobj(31), [], start, 4 << 10
    while not unpacker.eof:
        chunk = source.at(place, step)
        if not chunk:
            return b"".join(parts), place, "member cut short"
        try:
            parts.append(unpacker.decompress(chunk))
        except zlib.error:
            return _until_error(source, start, place), place, "member checksum or data"
        place, step = place + len(chunk), min(2 * step, CHUNK)
    return b"".join(parts), place - len(unpacker.unused_data), ""


def _until_error(source: _Source, start: int, place: int) -> bytes:
    """What a member unpacks to before its error, which comes after ``place``: in pieces, the last one byte by byte."""
    unpacker = zlib.decompressobj(31)
    parts, step = [unpacker.decompress(source.at(start, place - start))], 1024
    while True:
        before = unpacker.copy()
        try:
            parts.append(unpacker.decompress(source.at(place, step)))
            place += step
        except zlib.error:
            if step == 1:
                return b"".join(parts)
            unpacker, step = before, 1


def _members(source: _Source) -> Iterator[Found]:
    """Records and gaps of an archive of gzip members.

    A member that gives no record, and bytes that are no member, are gaps of the file. What a damaged member
    still gives is told with its gaps inside; it reaches to the next member that gives any.
    """
    place, held_from, held = 0, None, []

    def settle(end: int) -> Iterator[Found]:
        for found in held:
            yield replace(found, start=held_from, end=end)

    while 0 <= place < source.size:
        data, end, fault = _gzip_member(source, place)
        found = [replace(f, inner=(f.start, f.end)) for f in _records(_Source.of(data), fault)]
        if any(f.kind == "record" for f in found):
            if held_from is not None:
                yield from settle(place)
            held_from, held = place, found
            if not fault:
                yield from settle(end)
                held_from = None
        elif held_from is None:
            held_from, held = place, [Found("gap", place, place, found[0].reason if found else "empty member")]
        place = source.find(_MEMBER, place + 1) if fault else end
    if held_from is not None:
        yield from settle(source.size)


def salvage(file, size: int, packed: bool) -> Iterator[Found]:
    """Records and gaps in file order; together they cover the file. ``packed``: members of gzip, else plain records.

    After a failed check the search goes on at the next member whose records can be read, or the next version line
    (``WARC/`` and a number of two parts) that begins a line or stands where the damaged record should have ended.
    Inside unpacked members, damaged ones too, the same search for version lines runs. Memory is bounded by one
    member, and in plain archives by the length a record states.
    """
    source = _Source(file, size)
    return _members(source) if packed else _records(source)


def write_archives(pages: DataFrame, folder: str | None = None, revisit_from: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) and return the archives: path, records, bytes.

    The payload is the html in UTF-8, null is empty. Among records with equal payloads of at least ``revisit_from``
    bytes the smallest page_id is a response and the others are revisits of it; all smaller ones are responses.
    Rows that repeat the smallest page_id are responses too; where all page_ids of a payload are null, all are.
    Other columns are not read. Each task writes archives of about ``ARCHIVE_BYTES`` below ``folder``.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= revisit_from
    keepers = keyed.filter(large).groupBy("digest").agg(F.min("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
    keepers = stage(keepers.filter("n > 1").drop("n"), "warc-keepers")
    named = split_lookup(keyed, keepers, ["digest"], "left").select("page_id", "url", "payload", "keeper")
    store = folder

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = file_system(store)
        system.create_dir(base, recursive=True)
        out, path, records, size = None, "", 0, 0
        for batch in batches:
            for page_id, url, payload, keeper in zip(batch.page_id, batch.url, batch.payload, batch.keeper):
                page_id, keeper = (None if pd.isna(v) else int(v) for v in (page_id, keeper))
                revisit = keeper is not None and page_id != keeper
                record = build_record(page_id, url, bytes(payload), keeper, revisit, date)
                if out is None:
                    path, records, size = new_file(base, ".warc.gz"), 0, 0
                    out = system.open_output_stream(path, compression=None)
                member = gzip.compress(record, 6, mtime=0)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    yield pd.DataFrame({"path": [f"{store}/{path.rsplit('/', 1)[1]}"], "records": [records], "bytes": [size]})
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [f"{store}/{path.rsplit('/', 1)[1]}"], "records": [records], "bytes": [size]})

    small_batches(pages.sparkSession, 128)
    # Nullable longs reach pandas as floats; ids travel as text instead.
    texted = named.withColumns({c: F.col(c).cast("string") for c in ("page_id", "keeper")})
    return stage(texted.mapInPandas(write, "path string, records long, bytes long"), "warc-archives")


RECORD_SCHEMA = (
    "path string, start long, end long, kind string, reason string, record_type string, record_id string, "
    "refers_to string, uri string, payload_digest string, payload_bytes long, payload binary, inner_start long, "
    "inner_end long, doubtful boolean"
)


def read_archives(archives: DataFrame) -> DataFrame:
    """The records and gaps of archives named by column ``path`` (``.gz``: gzip members, else plain).

    ``kind`` is "record" or "gap"; a gap has its byte range and the reason of the first failed check. Records have
    type, id, what they revisit, uri, digest and length of the full payload (for a revisit out of its HTTP header,
    which stands for the payload) and the payload (null for a revisit). ``inner_start`` and ``inner_end`` are the
    place inside the unpacked member, null in plain archives and where nothing could be unpacked. ``doubtful`` marks
    records that may be part of a damaged payload, or that nothing proves in a damaged member. Each archive is read by
    one task, in a stream; an empty archive gives no rows. Null paths are skipped.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch.path:
                rows, held = [], 0
                system, name = file_system(path)
                size = system.get_file_info(name).size
                with system.open_input_file(name) as file:
                    for found in salvage(file, size, path.endswith(".gz")):
                        rows.append(_row(path, found))
                        held += found.end - found.start + len(found.block)
                        if held > 4 << 20:
                            yield pd.DataFrame(rows, columns=_COLUMNS)
                            rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=_COLUMNS)

    paths = stage(archives.select("path").filter("path is not null").distinct(), "warc-paths")
    # A fixed number of partitions, which is not coalesced: one archive to a task, however short its name.
    dealt = paths.repartition(max(1, paths.count()), "path")
    return dealt.mapInPandas(read, RECORD_SCHEMA)


_COLUMNS = [field.split()[0] for field in RECORD_SCHEMA.split(", ")]


def _row(path: str, found: Found) -> tuple:
    inner = found.inner or (None, None)
    if found.kind == "gap":
        return (path, found.start, found.end, "gap", found.reason, *[None] * 7, *inner, False)
    fields = found.fields
    head, _, payload = found.block.partition(b"\r\n\r\n")
    revisit = fields["warc-type"] == "revisit"
    stated = _length(head)
    return (
        path,
        found.start,
        found.end,
        "record",
        None,
        fields["warc-type"],
        fields.get("warc-record-id"),
        fields.get("warc-refers-to"),
        fields.get("warc-target-uri"),
        fields.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else digest_of(payload),
        int(stated) if revisit else len(payload),
        None if revisit else payload,
        *inner,
        found.doubtful,
    )


def archive_pages(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """Write all pages and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Raises when the reader met a gap: what was just written must come back whole.
    """
    back = read_archives(write_archives(pages, revisit_from=revisit_from))
    number = lambda c: F.regexp_extract(F.col(c), r"^<urn:page:(-?\d+)>$", 1)
    whole = F.when(F.col("kind") == "gap", F.raise_error(F.concat(F.lit("gap in "), "path"))).otherwise(F.col("record_type"))
    return back.select(
        F.when(number("record_id") != "", number("record_id")).cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        whole.cast("string").alias("record_type"),
        F.when(F.col("refers_to").isNotNull(), number("refers_to")).cast("long").alias("refers_to"),
    )

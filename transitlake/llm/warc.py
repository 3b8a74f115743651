"""WARC archives: a writer with revisits, and a reader that salvages damaged archives.

**Writing.** Every row becomes one record, each in a gzip member of its own. Of the rows
with equal payloads (by SHA-256) of at least ``least`` bytes, those with the smallest id are
responses; the others revisit it, with headers and digest but no payload. The least id is
found by an aggregate of digests; payloads that make up more than a thousandth of the
repeated rows, so under a thousand of them, are broadcast with it, and all others meet it in
a join, where no key holds more than a thousandth. Tasks write archives of about
``archive_bytes`` through the path's file system and return their names. The stored list
of names is what counts: an archive of a lost or repeated task attempt is in no list, so it
is never read.

**Reading.** One task reads an archive at a time, forwards, a record in memory at once.
A member must decompress with a right checksum; a record must have a version line, a type,
an id, a length at whose end the next record's line break stands, and blocks and payloads
that match their digests. Where a check fails, the reader looks for the next place at which
a member (compressed) or a version line (plain; the name does not end in .gz) begins a
record that passes all checks, goes on there, and gives the bytes between as one row with a
``reason``. Where the end of what failed is certain (right checksum, or a line break and
another version line after the stated length), it goes on at that end, so that what a
payload contains is not taken for a record; elsewhere a sound record within a damaged one
is recovered like any other. A member of several records gives those
that pass, and its range as a gap where one does not.

Defined cases. A null payload is empty; null ids and urls are left out of the record and
read back as null; white space and controls in ids and urls are percent-encoded. Repeated rows with the
smallest id are all responses, a row with null id is one only if no equal payload has an id.
Very long payloads take a task's memory once or twice. An empty table gives no archive,
no archive gives no rows. Columns other than the three named are not written, so names
cannot clash; the result has its own fixed names. A revisit's length is that of the
HTTP header it repeats.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.llm.tables import stored

CHUNK = 1 << 16
AHEAD = 1 << 20
LONGEST_HEADER = 1 << 20
ARCHIVE_BYTES = 64 << 20
OUT_BYTES = 8 << 20
HOT_SHARE = 1000

ARCHIVES = "archive string, bytes long, records long"
RECORDS = ("archive string, offset long, length long, record_id string, record_type string, target_uri string, "
           "refers_to string, payload_bytes long, payload_digest string, payload binary, reason string")
_FIELDS = pa.schema([
    ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()),
    ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("payload", pa.binary()), ("reason", pa.string())])

VERSION = re.compile(rb"WARC/(?:0\.1[78]|1\.[01])\r\n")
ID_PREFIX = "urn:record:"
BREAK = b"\r\n\r\n"


# -- writing ---------------------------------------------------------------------------

def _clean(value: str) -> str:
    """No white space or controls, which would end a header line."""
    return quote(value, safe="!\"#$&'()*+,-./:;<=>?@[\\]^_`{|}~%")


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record with its length, block digest and closing line breaks."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in fields],
             f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + BREAK + block + BREAK


def page_record(key: str | None, url: str | None, payload: bytes, digest: str, first: str | None, date: str) -> bytes:
    """A response, or with ``first`` a revisit of that record."""
    fields = [("WARC-Record-ID", f"<{ID_PREFIX}{'' if key is None else quote(key, safe='')}>"), ("WARC-Date", date),
              ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if url is not None:
        fields.append(("WARC-Target-URI", _clean(url)))
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if first is None:
        return record("response", fields, head + payload)
    fields += [("WARC-Refers-To", f"<{ID_PREFIX}{quote(first, safe='')}>"),
               ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return record("revisit", fields, head)


def member(content: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


def _writer(folder: str, date: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        target, base = fs.FileSystem.from_uri(folder)
        out, name, size, count = None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "bytes": [size], "records": [count]})

        for batch in batches:
            for row in zip(*[c for c in batch.columns], strict=True):
                key, url, payload, digest, first = [v.as_py() for v in row]
                if out is None:
                    name, count = f"{uuid.uuid4().hex}.warc.gz", 0
                    target.create_dir(base, recursive=True)
                    out = target.open_output_stream(f"{base}/{name}", compression=None)
                    info = record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
                                               ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    size = out.write(member(info))
                size += out.write(member(page_record(key, url, payload, digest, first, date)))
                count += 1
                if size >= archive_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()
    return write


def with_first(rows: DataFrame, least: int) -> DataFrame:
    """(key, url, payload) with ``digest`` and ``first``: the id that the row revisits, else null."""
    rows = rows.select("key", "url", F.coalesce("payload", F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    repeated = stored(rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min("key").alias("least")).where("copies > 1"), "payloads")
    total = repeated.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    is_hot = F.col("copies") * HOT_SHARE > total
    hot = repeated.where(is_hot).select("digest", F.col("least").alias("hot_least"), F.lit(True).alias("hot"))
    cold = repeated.where(~is_hot).select(F.col("digest").alias("meet"), "least")
    apart = F.col("hot").isNotNull() | (F.octet_length("payload") < least)
    met = rows.join(F.broadcast(hot), "digest", "left").withColumn(
        "meet", F.when(apart, F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))).otherwise(F.col("digest")))
    met = met.join(cold, "meet", "left").withColumn("least", F.coalesce("least", "hot_least"))
    return met.select("key", "url", "payload", "digest", F.when(~F.col("key").eqNullSafe(F.col("least")), F.col("least")).alias("first"))


def write_archives(df: DataFrame, folder: str, id: str = "page_id", url: str = "url", payload: str = "html",
                   least: int = 100, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record a row below ``folder``; returns the stored list of archives.

    ``payload`` is a text (written as UTF-8) or binary; ids are compared in their own type.
    """
    rows = df.select(F.col(f"`{id}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"),
                     F.col(f"`{payload}`").cast("binary").alias("payload"))
    dealt = with_first(rows, least).select(F.col("key").cast("string"), "url", "payload", "digest", F.col("first").cast("string"))
    return stored(dealt.mapInArrow(_writer(folder.rstrip("/"), date, archive_bytes), ARCHIVES), "archives")


# -- reading ---------------------------------------------------------------------------

class Damaged(Exception):
    """What failed, and where reading may surely go on, if that is known."""

    def __init__(self, reason: str, resume: int | None = None):
        super().__init__(reason)
        self.reason, self.resume = reason, resume


class Record(NamedTuple):
    start: int
    end: int
    fields: dict[str, str]
    payload: bytes
    payload_bytes: int


class Gap(NamedTuple):
    start: int
    end: int
    reason: str


class InMemory:
    def __init__(self, data: bytes):
        self.data, self.size = data, len(data)

    def read(self, start: int, count: int) -> bytes:
        return self.data[start:start + count]


class InFile:
    """Reads ahead, as most members are far smaller than a sensible read of a remote file."""

    def __init__(self, file):
        self.file, self.size, self.begin, self.ahead = file, file.size(), 0, b""

    def read(self, start: int, count: int) -> bytes:
        count = min(count, max(self.size - start, 0))
        if not self.begin <= start <= start + count <= self.begin + len(self.ahead):
            self.begin, self.ahead = start, self.file.read_at(min(max(count, AHEAD), self.size - start), start) if count else b""
        return self.ahead[start - self.begin:start - self.begin + count]


def _agrees(stated: str, content: bytes) -> bool:
    """Whether a digest field fits; an unknown algorithm is not checked."""
    name, _, value = stated.strip().partition(":")
    name = name.strip().lower().replace("-", "")
    if name not in ("sha1", "sha256", "sha512", "md5"):
        return True
    found = hashlib.new(name, content)
    return value.strip().lower() == found.hexdigest() or \
        value.strip().upper().rstrip("=") == base64.b32encode(found.digest()).decode().rstrip("=")


def _header_fields(head: bytes) -> dict[str, str]:
    fields: dict[str, str] = {}
    last = None
    for line in head.split(b"\r\n")[1:]:
        text = line.decode("utf-8", "replace")
        if last and text[:1] in (" ", "\t"):
            fields[last] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        if not colon or not name.strip():
            raise Damaged("header")
        last = name.strip().lower()
        fields[last] = value.strip()
    return fields


def _plain(source, start: int) -> Record:
    """The record that begins at ``start``, all checks passed."""
    head = source.read(start, 4096)
    if not VERSION.match(head):
        raise Damaged("version")
    while (cut := head.find(BREAK)) < 0:
        if len(head) >= LONGEST_HEADER or len(head) >= source.size - start:
            raise Damaged("header")
        head += source.read(start + len(head), max(CHUNK, len(head)))
    fields = _header_fields(head[:cut])
    length = fields.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", length):
        raise Damaged("length")
    first = start + cut + 4
    last = first + int(length)
    if last + 4 > source.size:
        raise Damaged("truncated")
    after = source.read(last, 9)
    if after[:4] != BREAK:
        raise Damaged("length")
    end = last + 4
    sure = end if end == source.size or after[4:] == b"WARC/" else None
    if not fields.get("warc-type") or not fields.get("warc-record-id"):
        raise Damaged("fields", sure)
    block = source.read(first, last - first)
    if not _agrees(fields.get("warc-block-digest", ""), block):
        raise Damaged("block digest", sure)
    payload, size = block, len(block)
    if fields.get("content-type", "").lower().startswith("application/http"):
        http, _, payload = block.partition(BREAK)
        stated = re.search(rb"(?im)^content-length:[ \t]*([0-9]{1,18})[ \t]*\r?$", http)
        size = len(payload)
        if fields["warc-type"] == "revisit":
            size = int(stated[1]) if stated else size
    if fields["warc-type"] != "revisit" and not _agrees(fields.get("warc-payload-digest", ""), payload):
        raise Damaged("payload digest", sure)
    return Record(start, end, fields, payload, size)


def _unpacked(source, start: int) -> tuple[int, bytes]:
    """The end and the content of the gzip member that begins at ``start``."""
    opener, at, out = zlib.decompressobj(31), start, bytearray()
    looked, count = False, CHUNK // 16
    try:
        while not opener.eof:
            chunk = source.read(at, count)
            if not chunk:
                raise Damaged("truncated")
            at, count = at + len(chunk), CHUNK
            out += opener.decompress(chunk)
            if not looked and len(out) >= 5:
                looked = True
                if out[:5] != b"WARC/":
                    raise Damaged("version")
    except zlib.error:
        raise Damaged("checksum" if looked else "member") from None
    return at - len(opener.unused_data), bytes(out)


def _next(source, start: int, sign: re.Pattern) -> int:
    """The next place from ``start`` on that looks like a beginning; the end if there is none."""
    at = start
    while at < source.size:
        chunk = source.read(at - 1, CHUNK + 16)  # one byte earlier: a version line follows a line break
        found = sign.search(chunk, 1)
        if found:
            return at - 1 + found.start()
        at += CHUNK
    return source.size


MEMBER_SIGN, LINE_SIGN = re.compile(rb"\x1f\x8b\x08"), re.compile(rb"(?<=\n)WARC/(?:0\.1[78]|1\.[01])\r\n")


def salvaged(source, compressed: bool) -> Iterator[Record | Gap]:
    """All sound records in order, and the byte ranges between them that hold none."""
    at, gap, why = 0, None, ""
    while at < source.size:
        try:
            if compressed:
                end, content = _unpacked(source, at)
                found = list(salvaged(InMemory(content), False))
            else:
                one = _plain(source, at)
                end, found = one.end, [one]
        except Damaged as damage:
            if gap is None:
                gap, why = at, damage.reason
            at = damage.resume or _next(source, at + 1, MEMBER_SIGN if compressed else LINE_SIGN)
            continue
        sound = [r._replace(start=at, end=end) for r in found if isinstance(r, Record)]
        broken = [r.reason for r in found if isinstance(r, Gap)]
        if gap is not None and (sound or not broken):
            yield Gap(gap, at, why)
            gap = None
        yield from sound
        if broken and sound:
            yield Gap(at, end, broken[0])
        elif broken and gap is None:
            gap, why = at, broken[0]
        at = end
    if gap is not None:
        yield Gap(gap, source.size, why)


def _named(field: str | None) -> str | None:
    """The id in ``<urn:record:…>``; another URI as it is; null for none."""
    uri = (field or "").strip().strip("<>")
    return (unquote(uri[len(ID_PREFIX):]) or None) if uri.startswith(ID_PREFIX) else uri or None


def _row(archive: str, item: Record | Gap, payload: bool) -> tuple:
    if isinstance(item, Gap):
        return (archive, item.start, item.end - item.start, *[None] * 7, item.reason)
    fields = item.fields
    digest = fields.get("warc-payload-digest", "").partition(":")[2].strip()
    if not digest:
        digest = hashlib.sha256(item.payload).hexdigest()
    return (archive, item.start, item.end - item.start, _named(fields["warc-record-id"]), fields["warc-type"],
            fields.get("warc-target-uri"), _named(fields.get("warc-refers-to")), item.payload_bytes, digest,
            item.payload if payload else None, None)


def _reader(payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        rows: list[tuple] = []
        size = 0

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FIELDS, strict=True)],
                                              schema=_FIELDS)

        for batch in batches:
            for archive in batch.column(0).to_pylist():
                store, path = fs.FileSystem.from_uri(archive)
                with store.open_input_file(path) as file:
                    for item in salvaged(InFile(file), archive.endswith(".gz")):
                        rows.append(_row(archive, item, payload))
                        size += len(rows[-1][9] or b"") + 500
                        if size > OUT_BYTES:
                            yield full()
                            rows, size = [], 0
        if rows:
            yield full()
    return read


def read_archives(archives: DataFrame, payload: bool = True) -> DataFrame:
    """Records (``reason`` null) and gaps (with ``reason``) of the listed ``archive`` URIs.

    ``payload_digest`` is the stated one, bare, which a response's payload was held against.
    Store the result where it is used twice: every use reads the archives.
    """
    count = archives.count()
    tasks = max(1, min(count, max(4 * archives.sparkSession.sparkContext.defaultParallelism, count // 8)))
    return archives.select("archive").repartition(tasks).mapInArrow(_reader(payload), RECORDS)

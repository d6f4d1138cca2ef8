"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

Writing: pages with equal payloads (by SHA-1) are found with one grouped aggregate; the record of the
largest page id is the response, the others revisit it.  Each task writes gzip members, one for each
record, into files of at most ``ROLL`` bytes in a shared folder; a file's name holds the task attempt, and
only the files in the returned manifest count, so a retried or doubled attempt does no harm.

Reading: each file is read front to back.  A member or record that fails a check (gzip CRC, header
syntax, length, end marks, block and payload digests) is given up; the reader searches for the next
gzip member or version line that holds a valid record, goes on there, and logs the bytes between as a
quarantined gap.  Plain and compressed archives are read alike; memory is that of one record.

Cases: a null payload is empty; empty payloads count as equal; repeated rows of a page id are a record
each (those of the largest id are all responses); a null page id never is the largest; a null url
becomes a URN; control characters of a url, and blanks at its ends, are percent-encoded; an empty table writes
nothing and reads as no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.common import batches, prepare, shared_folder, staged, table, to_arrow

ROLL = 32 << 20
#: Tasks that read archives, at most (each one file after another; files are of about one size).
READERS = 20_000
#: Bytes that are read at a start mark to see whether it can begin a record.
HEAD = 512
LEVEL = 4
BLOCK = 1 << 20
DATE = "2000-01-01T00:00:00Z"
# Format marks.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STARTS = re.compile(rb"\x1f\x8b\x08[\x00-\x1f]|WARC/1\.[01]\r\n")
LONGEST_START = 10
#: Longest header of a plain record; that of a compressed one ends with its member.
HEADER_BYTES = 1 << 20
_UNSAFE = re.compile(r"[\x00-\x1f\x7f]|^ +| +$")

MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
ENTRY = pa.schema([("kind", pa.string()), ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                   ("reason", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()),
                   ("refers_to", pa.string()), ("uri", pa.string()), ("payload_digest", pa.string()),
                   ("payload_bytes", pa.int64()), ("payload", pa.binary())])
ENTRY_DDL = ("kind string, path string, offset long, length long, reason string, record_id string, record_type string, "
             "refers_to string, uri string, payload_digest string, payload_bytes long, payload binary")


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def encoded(uri: str) -> str:
    """A url as one header line that reads back the same: control characters and outer blanks percent-encoded."""
    return _UNSAFE.sub(lambda m: "".join(f"%{ord(c):02X}" for c in m[0]), uri)


def record(record_id: str, uri: str, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC record: the HTTP response, or its header alone for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    head = [f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {encoded(uri)}", f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}"]
    if refers_to:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def open_folder(path: str):
    """(file system, path in it) of a folder URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_archives(records: DataFrame, folder: str, roll: int = ROLL, compress: bool = True) -> DataFrame:
    """Write rows (record_id, uri, payload, refers_to) below ``folder``; the manifest, written and read again."""
    prepare(records.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        task = TaskContext.get()
        name, out, done = "", None, []
        for b in batches(it):
            for rid, uri, payload, to in zip(*(b.column(c).to_pylist() for c in ("record_id", "uri", "payload", "refers_to")), strict=True):
                data = record(rid, uri, (payload or "").encode(), to)
                if not compress and data.find(b"\r\n\r\n", 0, HEADER_BYTES) < 0:
                    raise ValueError(f"the header of {rid} is too long for a plain record")
                data = member(data) if compress else data
                if out is not None and done[-1][2] + len(data) > roll:
                    out.close()
                    out = None
                if out is None:
                    name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{len(done):04d}.warc{'.gz' * compress}"
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                    done.append([f"{folder.rstrip('/')}/{name}", 0, 0])
                out.write(data)
                done[-1][1] += 1
                done[-1][2] += len(data)
        if out is not None:
            out.close()
            yield to_arrow(dict(zip(MANIFEST.names, map(list, zip(*done, strict=True)), strict=True)), MANIFEST)

    return staged(records.select("record_id", "uri", "payload", "refers_to").mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


class Bad(Exception):
    """A failed check."""


def parse(data: bytes, longest: int = HEADER_BYTES) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, length) of the record at the start of ``data``; Bad if a check fails."""
    if not re.match(rb"WARC/1\.[01]\r\n", data):
        raise Bad("no version line")
    end = data.find(b"\r\n\r\n", 0, longest)
    if end < 0:
        raise Bad("header without an end")
    headers = {}
    for line in data[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name or b" " in name:
            raise Bad("header line")
        headers[name.decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    if not headers.get("content-length", "").isdigit() or not headers.get("warc-record-id") or not headers.get("warc-type"):
        raise Bad("missing header")
    start, size = end + 4, int(headers["content-length"])
    block = data[start:start + size]
    if len(block) < size or data[start + size:start + size + 4] != b"\r\n\r\n":
        raise Bad("length")
    if (want := headers.get("warc-block-digest", "")).startswith("sha1:") and want[5:] != digest(block):
        raise Bad("block digest")
    return headers, block, start + size + 4


def as_entry(path: str, offset: int, length: int, headers: dict[str, str], block: bytes, payload: bool) -> tuple:
    """The row of a checked record; the payload digest must fit unless the payload is elsewhere."""
    kind, want = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    head, blank, body = block.partition(b"\r\n\r\n") if block[:5] == b"HTTP/" else (b"", b"", block)
    size = len(body)
    if kind == "revisit":
        m = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", head)
        size, body = int(m[1]) if m else None, None
    elif want is None:
        want = digest(body)
    elif want != digest(body):
        raise Bad("payload digest")
    bare = lambda x: x.strip("<>") if x else None
    return ("record", path, offset, length, None, bare(headers["warc-record-id"]), kind, bare(headers.get("warc-refers-to")),
            headers.get("warc-target-uri"), want, size, body if payload else None)


def read_at(file, offset: int, path: str, payload: bool) -> tuple[tuple, int]:
    """(entry, next offset) of the valid record at ``offset``; Bad if there is none."""
    file.seek(offset)
    data = file.read(BLOCK)
    if data[:2] == b"\x1f\x8b":
        unzip, parts, used = zlib.decompressobj(31), [], 0
        try:
            while data:
                parts.append(unzip.decompress(data))
                used += len(data) - len(unzip.unused_data)
                if unzip.eof:
                    break
                data = file.read(BLOCK)
        except zlib.error as e:
            raise Bad("gzip member") from e
        if not unzip.eof:
            raise Bad("gzip member cut off")
        whole = b"".join(parts)
        headers, block, length = parse(whole, len(whole))
        if length != len(whole):
            raise Bad("member holds more than a record")
        return as_entry(path, offset, used, headers, block, payload), offset + used
    while True:  # a plain record: its header tells how much to read
        try:
            headers, block, length = parse(data)
            return as_entry(path, offset, length, headers, block, payload), offset + length
        except Bad as bad:
            m = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d{1,18})\r\n", data[:HEADER_BYTES])
            end = data.find(b"\r\n\r\n", 0, HEADER_BYTES)
            more = file.read(int(m[1]) + end + 8 - len(data)) if str(bad) == "length" and m and end + int(m[1]) + 8 > len(data) else b""
            if not more:
                raise
            data += more


def next_start(file, offset: int) -> Iterator[int]:
    """Offsets from ``offset`` at which a member or a version line may begin (the file may be moved in between)."""
    file.seek(offset)
    held, at = b"", offset
    while data := file.read(BLOCK):
        held += data
        for m in STARTS.finditer(held):
            if m.start() < len(held) - LONGEST_START:
                yield at + m.start()
        at += max(0, len(held) - LONGEST_START)
        held = held[-LONGEST_START:] if len(held) > LONGEST_START else held
        file.seek(at + len(held))
    yield from (at + m.start() for m in STARTS.finditer(held))


def plausible(file, at: int) -> bool:
    """Whether the first bytes at a start mark can begin a record, so that a false mark costs a short read only."""
    file.seek(at)
    head = file.read(HEAD)
    if head[:2] == b"\x1f\x8b":
        try:
            head = zlib.decompressobj(31).decompress(head, HEAD)
        except zlib.error:
            return False
        return head[:7] == b"WARC/1."[:len(head)]
    return re.match(rb"WARC/1\.[01]\r\n[^\s:]+:", head) is not None


def salvage(file, size: int, path: str, payload: bool = True) -> Iterator[tuple]:
    """All valid records of a file in order, and a gap row for every run of bytes given up."""
    offset = 0
    while offset < size:
        try:
            entry, after = read_at(file, offset, path, payload)
        except Bad as bad:
            reason, entry, after = str(bad), None, size
            for at in next_start(file, offset + 1):
                if not plausible(file, at):
                    continue
                try:
                    entry, after = read_at(file, at, path, payload)
                    break
                except Bad:
                    continue
            begin = entry[2] if entry else size
            yield ("gap", path, offset, begin - offset, reason, *[None] * 7)
        if entry:
            yield entry
        offset = after


def read_archives(manifest: DataFrame, payload: bool = True, whole: bool = False) -> DataFrame:
    """Records and gaps of the archives named by ``manifest.path``, a file at a time in each of a bounded number of tasks.

    ``whole``: fail if a file does not hold as many records as ``manifest.records`` says.
    """
    n = manifest.count()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            for path, records in zip(*(b.column(c).to_pylist() for c in ("path", "records")), strict=True):
                files, name = open_folder(path)
                rows: list[tuple] = []
                held = read = 0
                with files.open_input_file(name) as f:
                    for e in salvage(f, f.size(), path, payload):
                        rows.append(e)
                        read += e[0] == "record"
                        held += 200 + len(e[-1] or b"")
                        if held > 8 << 20:
                            yield to_arrow(dict(zip(ENTRY.names, map(list, zip(*rows, strict=True)), strict=True)), ENTRY)
                            rows, held = [], 0
                if rows:
                    yield to_arrow(dict(zip(ENTRY.names, map(list, zip(*rows, strict=True)), strict=True)), ENTRY)

                if whole and read != records:
                    raise ValueError(f"{path}: {read} records read of {records} written")

    return manifest.select("path", "records" if whole else F.lit(None).cast("long").alias("records")).repartition(max(1, min(n, READERS))).mapInArrow(run, ENTRY_DDL)


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Rows (record_id, uri, payload, refers_to) of pages (page_id, url, html)."""
    rows = pages.select("page_id", F.col("url"), F.coalesce("html", F.lit("")).alias("payload")).withColumn(
        "sha", F.sha1(F.col("payload").cast("binary")))
    equal = (rows.where(F.octet_length("payload") >= least_bytes).groupBy("sha")
             .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha", "first"))
    name = lambda c: F.concat(F.lit("urn:page:"), c.cast("string"))
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), name(F.col("first")))
    own = F.coalesce(name(F.col("page_id")), F.lit("urn:page:null"))
    return rows.join(equal, "sha", "left").select(own.alias("record_id"), F.coalesce("url", own).alias("uri"), "payload", refers.alias("refers_to"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a record for every page, read the archives back, and return what they hold of each page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    manifest = write_archives(with_revisits(pages), shared_folder(spark, "warc"))
    number = lambda c: F.expr(f"try_cast(substring({c}, 10) as bigint)")
    return (read_archives(manifest, payload=False, whole=True).where("kind = 'record'")
            .select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                    number("refers_to").alias("refers_to")))


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS sha FROM pages),
g AS (SELECT sha, max(page_id) AS first, list_aggregate(list_transform(range(32), lambda k:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               ((('0x' || substr(sha, 5 * (k // 4) + 1, 5))::INTEGER >> (15 - 5 * (k % 4))) & 31)::INTEGER + 1, 1)), 'string_agg', '') AS b32
      FROM p GROUP BY sha)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, b32 AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN g USING (sha)
"""

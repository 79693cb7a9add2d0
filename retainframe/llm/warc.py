"""WARC records in ZIP-packaged archives: writer and range reader.

An archive is a ZIP file with two stored (uncompressed) members: ``archive/data.warc.gz``, a run of records of
one gzip member each, and ``indexes/index.cdxj``, a line per record with its offset and length. The reader
parses the end-of-central-directory record, the ZIP64 locator and record where present, and the central
directory, finds the stored members' places, and reads index and records by byte range; nothing is extracted.

Records with equal payloads of at least ``least_bytes`` bytes (equal length and SHA-1) are stored once: those with the
largest id hold the payload, the others are revisit records that name it.

Edge cases: a null payload is an empty one; a null url gives a record without a target; records with a null id
are responses unless a record with an id has their payload; rows that repeat the largest id of their payload
are all responses; an empty table gives no archive and an empty result. Extra columns are not read.

Archives are written to the shared folder under names of their task attempt; only those listed in the manifest
that Spark committed count, so a repeated task leaves no double records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Stored bytes after which a task begins another archive, and bytes read at once.
ARCHIVE_BYTES, READ_BYTES = 32 << 20, 4 << 20
#: Fixed values of the ZIP format: signatures, the marks that send a reader to ZIP64, and the ZIP64 extra field.
END, END64_AT, END64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
MARK16, MARK32, EXTRA64, STORED = 0xFFFF, 0xFFFFFFFF, 1, 0
RECORDS = "path string, offset bigint, length bigint, record_type string, id string, refers_to string, url string, payload_bytes bigint, payload_digest string, payload binary"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- ZIP directory -------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    method: int
    size: int
    stored: int
    header_at: int


class ZipDirectory:
    """Places of the members of a ZIP file, from its directories alone; ``file`` offers size() and read_at(n, offset)."""

    def __init__(self, file):
        self.file, size = file, file.size()
        tail_at = max(0, size - 22 - MARK16)
        tail = file.read_at(size - tail_at, tail_at)
        at = tail.rfind(END)
        while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
            at = tail.rfind(END, 0, at)  # the signature inside a comment
        if at < 0:
            raise ValueError("no end of central directory")
        count, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
        if MARK16 == count or MARK32 in (length, start):
            locator = file.read_at(20, tail_at + at - 20)
            if locator[:4] != END64_AT:
                raise ValueError("no ZIP64 locator")
            record = file.read_at(56, struct.unpack("<Q", locator[8:16])[0])
            if record[:4] != END64:
                raise ValueError("no ZIP64 end of central directory")
            count, length, start = struct.unpack("<QQQ", record[32:56])
        self.members = dict(self._entries(file.read_at(length, start), count))

    @staticmethod
    def _entries(directory: bytes, count: int) -> Iterator[tuple[str, Member]]:
        at = 0
        for _ in range(count):
            if directory[at : at + 4] != ENTRY:
                raise ValueError("broken central directory")
            method, = struct.unpack("<H", directory[at + 10 : at + 12])
            stored, size, name_n, extra_n, comment_n = struct.unpack("<IIHHH", directory[at + 20 : at + 34])
            header_at, = struct.unpack("<I", directory[at + 42 : at + 46])
            name = directory[at + 46 : at + 46 + name_n].decode()
            extra, e = directory[at + 46 + name_n : at + 46 + name_n + extra_n], 0
            while e + 4 <= len(extra):
                kind, n = struct.unpack("<HH", extra[e : e + 4])
                if kind == EXTRA64:  # holds only the fields that are marked, in this order
                    wide = iter(struct.unpack(f"<{n // 8}Q", extra[e + 4 : e + 4 + n // 8 * 8]))
                    size = next(wide) if size == MARK32 else size
                    stored = next(wide) if stored == MARK32 else stored
                    header_at = next(wide) if header_at == MARK32 else header_at
                e += 4 + n
            yield name, Member(method, size, stored, header_at)
            at += 46 + name_n + extra_n + comment_n

    def data_at(self, name: str) -> int:
        """Where a stored member's bytes begin: the local header's own name and extra field lie before them."""
        member = self.members[name]
        if member.method != STORED:
            raise ValueError(f"{name} is compressed and cannot be read by range")
        header = self.file.read_at(30, member.header_at)
        if header[:4] != LOCAL:
            raise ValueError("broken local header")
        name_n, extra_n = struct.unpack("<HH", header[26:30])
        return member.header_at + 30 + name_n + extra_n

    def read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        member = self.members[name]
        length = member.size - offset if length is None else length
        if offset < 0 or offset + length > member.size:
            raise ValueError("range outside the member")
        return self.file.read_at(length, self.data_at(name) + offset)


# --- WARC records --------------------------------------------------------------------------------------------


def _id(key) -> str:
    return "<urn:record:none>" if key is None else f"<urn:record:{key}>"


def _key(value: str | None) -> str | None:
    name = (value or "<urn:record:none>")[12:-1]
    return None if name == "none" else name


def record_bytes(key, url: str | None, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One record, uncompressed; a revisit (``refers_to`` given) leaves its payload out."""
    revisit = refers_to is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block += b"" if revisit else payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_id(key)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: {_id(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers, headers of the HTTP message (names in lower case), and the stored payload of one record."""
    if not data.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode().split("\r\n")[1:])}
    block = rest[: int(warc["content-length"])]
    if len(block) != int(warc["content-length"]):
        raise ValueError("record cut short")
    inner, _, payload = block.partition(b"\r\n\r\n")
    http = {k.lower(): v for k, _, v in (x.partition(": ") for x in inner.decode().split("\r\n")[1:])}
    return warc, http, payload


# --- writer --------------------------------------------------------------------------------------------------


class _Archive:
    def __init__(self, filesystem, path: str, wide: bool):
        self.sink = filesystem.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED)
        self.member, self.wide = self.zip.open(DATA, "w", force_zip64=wide), wide
        self.path, self.at, self.lines = path, 0, []

    def add(self, data: bytes, line: dict) -> None:
        stored = gzip.compress(data, compresslevel=1, mtime=0)
        self.member.write(stored)
        self.lines.append(json.dumps(line | {"offset": self.at, "length": len(stored)}))
        self.at += len(stored)

    def close(self) -> tuple[str, int]:
        self.member.close()
        with self.zip.open(INDEX, "w", force_zip64=self.wide) as index:
            index.write("".join(f"{x}\n" for x in self.lines).encode())
        self.zip.close()
        self.sink.close()
        return self.path.rpartition("/")[2], len(self.lines)


def mark_copies(df: DataFrame, key: str, payload: str, least_bytes: int) -> DataFrame:
    """(key, bytes, sha1, copy_of): the largest key of an equal payload, for rows that shall refer to it."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = df.withColumn("bytes", F.octet_length(body)).withColumn("sha1", F.sha1(body))
    # one row per payload that occurs again; written, so that a very frequent payload is split like any skewed join key
    repeated = keep(rows.where(F.col("bytes") >= least_bytes).groupBy("sha1", "bytes").agg(F.max(key).alias("last"), F.count("*").alias("n")).where("n > 1 and last is not null").drop("n"), "repeated")
    return rows.join(repeated, ["sha1", "bytes"], "left").withColumn("copy_of", F.when(~F.col(key).eqNullSafe(F.col("last")), F.col("last"))).drop("last")


def write_archives(df: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", wide: bool = False) -> DataFrame:
    """Write a record per row into archives under ``folder`` (a URI that all executors share); returns (path, records)."""
    rows = mark_copies(df.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(payload).alias("payload")), "key", "payload", least_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = pa.fs.FileSystem.from_uri(folder)
        filesystem.create_dir(base, recursive=True)
        archive, done = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("key", "url", "payload", "sha1", "copy_of")}
                archive = archive or _Archive(filesystem, f"{base}/{uuid.uuid4().hex}.zip", wide)
                digest, body = base64.b32encode(bytes.fromhex(row["sha1"])).decode(), (row["payload"] or "").encode()
                line = {"id": _key(_id(row["key"])), "type": "response" if row["copy_of"] is None else "revisit", "digest": digest}
                archive.add(record_bytes(row["key"], row["url"], body, digest, row["copy_of"], date), line)
                if archive.at >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{p}" for p, _ in done], "records": [n for _, n in done]}, schema=pa.schema([("path", pa.string()), ("records", pa.int64())]))

    return keep(rows.mapInArrow(run, "path string, records bigint"), "archives")


# --- reader --------------------------------------------------------------------------------------------------


def _records(filesystem, path: str, with_payload: bool) -> Iterator[tuple]:
    with filesystem.open_input_file(path) as file:
        directory = ZipDirectory(file)
        index = [json.loads(x) for x in io.BytesIO(directory.read(INDEX))]
        start, at, held = directory.data_at(DATA), 0, b""  # held: the bytes of the data member from at on
        for line in index:
            offset, length = line["offset"], line["length"]
            if not at <= offset or offset + length > at + len(held):
                at, held = offset, file.read_at(max(length, min(READ_BYTES, directory.members[DATA].size - offset)), start + offset)
            warc, http, payload = parse_record(zlib.decompress(held[offset - at : offset - at + length], 31))
            kind, digest, size = warc["warc-type"], warc["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"])
            if kind == "response" and (len(payload) != size or digest_of(payload) != digest) or digest != line["digest"]:
                raise ValueError(f"{path} at {offset}: payload does not match its digest")
            yield path, offset, length, kind, _key(warc["warc-record-id"]), _key(warc.get("warc-refers-to")), warc.get("warc-target-uri"), size, digest, payload if with_payload and kind == "response" else None


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """A row per record of the archives in column ``path``; the payload of a revisit is null, its length and digest are those it refers to."""
    schema = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), *[(c, pa.string()) for c in ("record_type", "id", "refers_to", "url")], ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                filesystem, path = pa.fs.FileSystem.from_uri(uri)
                rows, held = [], 0
                for row in _records(filesystem, path, with_payload):
                    rows.append(row)
                    held += 200 + len(row[-1] or b"")
                    if held > READ_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    # one archive per task: an archive is bounded, and few of them would otherwise be read by one task
    tasks = max(1, min(manifest.count(), 10_000))
    return manifest.select("path").repartition(tasks, F.col("path")).mapInArrow(run, RECORDS)

"""WARC records in ZIP-packaged web archives: writer, and a reader that range-reads records without extraction.

A package is a ZIP file whose members are stored, not deflated: ``archive/data.warc.gz`` (a gzip member for each record) and
``indexes/index.cdxj`` (a line for each record: key, JSON with offset and length within the member). The reader takes the end of
central directory record, its ZIP64 form where a field is saturated, then the central directory; it locates the data of a stored
member from its local header, reads the index, and range-reads records. Packages lie in the shared folder; they are opened by URI
through pyarrow's file systems (file, hdfs, s3, gs), so driver and executors need no common mount for remote stores.

Payloads are identified by SHA-1. Of records with equal payloads of at least ``MIN_REVISIT`` bytes, that with the largest key is the
response; the others are revisit records which refer to it and hold no payload. A package is closed at ``PACKAGE_BYTES`` of payload,
so a task writes as many as its rows need, each with bounded memory. Writers are retried safely: a package is written under a unique
name and only paths of tasks that succeeded reach the list, which is itself a written table.

Defined cases: a null payload is empty; a null url is the empty string; a row without a key is a response, and its key reads back as null; equal keys each
make a record, and if their payloads are equal, all with the largest key are responses; extra columns are ignored, whatever their names; an empty table
writes no package.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

MIN_REVISIT = 1000
PACKAGE_BYTES = 32 << 20
RANGE_BYTES = 8 << 20  # records of a package are dealt out in ranges of about this size
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"


# ---- records ---------------------------------------------------------------------------------------------------------


def record_id(key: int | None) -> str:
    return f"<urn:record:{'' if key is None else key}>"


def key_of(name: str) -> int | None:
    """The key of a record id; null where the record has none."""
    key = name.removeprefix("<urn:record:").removesuffix(">")
    return int(key) if key else None


def warc_record(key: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id(key)), ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A"))]
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Payload-Length", str(len(payload)))]
    if refers_to is not None:
        head += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if refers_to is None else b"")
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers in lower case, and the block's payload after its HTTP head."""
    at = data.index(b"\r\n\r\n")
    lines = data[:at].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0]!r}")
    head = {k.lower(): v for k, v in (x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])}
    block = data[at + 4 : at + 4 + int(head["content-length"])]
    if len(block) != int(head["content-length"]):
        raise ValueError("truncated WARC record")
    return head, block[block.index(b"\r\n\r\n") + 4 :]


# ---- zip packages ----------------------------------------------------------------------------------------------------


def zip_pieces(members: list[tuple[str, bytes | bytearray]], *, zip64: bool = False) -> Iterator[bytes | bytearray]:
    """A ZIP of stored members, in pieces that don't copy them. ``zip64`` forces the 64-bit fields, which large packages need anyway."""
    central, at = bytearray(), 0
    for name, data in members:
        raw, crc, n = name.encode(), zlib.crc32(data), len(data)
        big = zip64 or n >= 0xFFFFFFFF or at >= 0xFFFFFFFF
        size = 0xFFFFFFFF if big else n
        extra = struct.pack("<HHQQ", 1, 16, n, n) if big else b""
        head = struct.pack("<4sHHHHHIIIHH", b"PK\3\4", 45 if big else 20, 0x800, 0, 0, 0x21, crc, size, size, len(raw), len(extra)) + raw + extra
        yield head
        yield data
        extra = struct.pack("<HHQQQ", 1, 24, n, n, at) if big else b""
        central += struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\1\2", 45, 45 if big else 20, 0x800, 0, 0, 0x21, crc, size, size, len(raw), len(extra), 0, 0, 0, 0, 0xFFFFFFFF if big else at) + raw + extra
        at += len(head) + n
    n, k = len(central), len(members)
    big = zip64 or at >= 0xFFFFFFFF or k >= 0xFFFF
    if big:
        central += struct.pack("<4sQHHIIQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, k, k, n, at) + struct.pack("<4sIQI", b"PK\6\7", 0, at + n, 1)
    central += struct.pack("<4sHHHHIIH", b"PK\5\6", 0, 0, 0xFFFF if big else k, 0xFFFF if big else k, 0xFFFFFFFF if big else n, 0xFFFFFFFF if big else at, 0)
    yield central


def zip_package(members: list[tuple[str, bytes]], *, zip64: bool = False) -> bytes:
    return b"".join(zip_pieces(members, zip64=zip64))


def central_directory(read, size: int) -> dict[str, tuple[int, int]]:
    """``{member: (offset of its local header, stored size)}``. ``read(offset, length)`` gives bytes of a file of ``size``."""
    tail_at = max(0, size - 65557 - 20)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\5\6")
    if end < 0:
        raise ValueError("no end of central directory record")
    k, n, at = struct.unpack("<10xHII", tail[end : end + 20])
    if k == 0xFFFF or n == 0xFFFFFFFF or at == 0xFFFFFFFF:
        where = tail[end - 20 : end]
        if where[:4] != b"PK\6\7":
            raise ValueError("no ZIP64 locator")
        k, n, at = struct.unpack("<32xQQQ", read(struct.unpack("<8xQ4x", where)[0], 56))
    data, out, p = read(at, n), {}, 0
    for _ in range(k):
        sign, method, packed, plain, name_n, extra_n, note_n, offset = struct.unpack("<4s6xH8xIIHHH8xI", data[p : p + 46])
        if sign != b"PK\1\2":
            raise ValueError("broken central directory")
        name, extra = data[p + 46 : p + 46 + name_n].decode(), data[p + 46 + name_n : p + 46 + name_n + extra_n]
        while len(extra) >= 4:
            tag, length = struct.unpack("<HH", extra[:4])
            if tag == 1:
                wide = list(struct.unpack(f"<{length // 8}Q", extra[4 : 4 + length // 8 * 8]))
                plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                offset = wide.pop(0) if offset == 0xFFFFFFFF else offset
            extra = extra[4 + length :]
        if method == 0:
            if packed != plain:
                raise ValueError(f"{name}: a stored member of two sizes")
            out[name] = (offset, plain)
        p += 46 + name_n + extra_n + note_n
    return out


def member_start(read, offset: int) -> int:
    head = read(offset, 30)
    if head[:4] != b"PK\3\4":
        raise ValueError("broken local header")
    return offset + 30 + sum(struct.unpack("<26xHH", head))


# ---- distributed writer and reader -----------------------------------------------------------------------------------


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        body, index, held = bytearray(), [], 0

        def close() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.wacz"
            size = 0
            with store.open_output_stream(f"{base}/{name}") as f:
                for piece in zip_pieces([(DATA, body), (INDEX, "".join(index).encode())]):
                    f.write(piece)
                    size += len(piece)
            body.clear()
            index.clear()
            return pa.record_batch([pa.array([f"{folder}/{name}"]), pa.array([size], pa.int64())], names=["path", "size"])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in ("key", "url", "digest", "refers_to")]
            for key, url, digest, refers, payload in zip(*columns, batch.column("payload").cast(pa.binary()).to_pylist(), strict=True):
                data = gzip.compress(warc_record(key, url or "", payload or b"", digest, refers), 1, mtime=0)
                index.append(f"{key} " + json.dumps({"offset": str(len(body)), "length": str(len(data))}) + "\n")
                body += data
                held += len(payload or b"")
                if held >= PACKAGE_BYTES:
                    yield close()
                    held = 0
        if index:
            yield close()

    return run


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each package: runs of records, by absolute offset, with the lengths of the records in them."""
    for batch in batches:
        for path, size in zip(*(batch.column(k).to_pylist() for k in ("path", "size")), strict=True):
            store, name = pafs.FileSystem.from_uri(path)
            with store.open_input_file(name) as f:
                read = lambda at, n: f.read_at(n, at)  # noqa: E731, B023
                members = central_directory(read, size)
                start = member_start(read, members[DATA][0])
                at = member_start(read, members[INDEX][0])
                spots = [json.loads(x.split(" ", 1)[1]) for x in read(at, members[INDEX][1]).decode().splitlines()]
            runs: list[tuple[int, list[int]]] = []
            upto = 0
            for spot in spots:
                at, n = start + int(spot["offset"]), int(spot["length"])
                if not runs or upto != at or at + n - runs[-1][0] > RANGE_BYTES:
                    runs.append((at, []))
                runs[-1][1].append(n)
                upto = at + n
            yield pa.record_batch([pa.array([path] * len(runs)), pa.array([x for x, _ in runs], pa.int64()), pa.array([x for _, x in runs], pa.list_(pa.int64()))], names=["path", "at", "lengths"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, at, lengths in zip(*(batch.column(k).to_pylist() for k in ("path", "at", "lengths")), strict=True):
            store, name = pafs.FileSystem.from_uri(path)
            with store.open_input_file(name) as f:
                data = f.read_at(sum(lengths), at)
            rows, p = [], 0
            for n in lengths:
                head, payload = parse_record(gzip.decompress(data[p : p + n]))
                p += n
                revisit = head["warc-type"] == "revisit"
                digest = head["warc-payload-digest"].removeprefix("sha1:")
                if not revisit and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"{path}: payload digest of {head['warc-record-id']} differs")
                size = int(head["warc-payload-length"]) if revisit else len(payload)
                rows.append((key_of(head["warc-record-id"]), head["warc-target-uri"], size, digest, head["warc-type"], key_of(head["warc-refers-to"]) if revisit else None, None if revisit else payload.decode()))
            names = ["key", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def write_packages(pages: DataFrame, folder: str, *, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Writes a record for each row; the lazy result lists the packages: ``(path, size)``. Save it before reading it twice."""
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload")).withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    # Only digests of several records matter; the count combines before its shuffle, so a payload with a third of the rows is a row a task.
    large = rows.where(F.octet_length("payload") >= MIN_REVISIT).groupBy("digest").agg(F.max("key").alias("main"), F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("_same"), "main")
    # Small payloads, of which many may be equal, are dealt out by their keys.
    same = F.when(F.octet_length("payload") >= MIN_REVISIT, F.col("digest")).otherwise(F.concat(F.lit("~"), F.coalesce(F.col("key").cast("string"), F.col("url"), F.lit(""))))
    decided = rows.withColumn("_by", same).join(large, F.col("_by") == F.col("_same"), "left").withColumn("refers_to", F.when(F.col("main") != F.col("key"), F.col("main")))
    return decided.select("key", "url", "payload", "digest", "refers_to").mapInArrow(_write(folder), "path string, size long")


def read_packages(packages: DataFrame) -> DataFrame:
    """Records of packages ``(path, size)``: key, url, payload_bytes, payload_digest, record_type, refers_to, payload (null for revisits)."""
    ranges = packages.mapInArrow(_ranges, "path string, at long, lengths array<long>")
    # A row stands for up to RANGE_BYTES to be read, so the number of tasks follows the packages' bytes, not the rows' own size.
    total = packages.agg(F.sum("size")).first()[0] or 0
    dealt = ranges.repartition(max(1, -(-total // RANGE_BYTES)), "path", "at")
    return dealt.mapInArrow(_read, "key long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload string")


def round_trip(spark: SparkSession, pages: DataFrame, **columns) -> DataFrame:
    scratch = Scratch(spark, "warc")
    return read_packages(scratch.save(write_packages(pages, scratch.path("packages"), **columns), "list"))

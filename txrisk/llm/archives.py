"""WARC records in ZIP packages: written by tasks, read back by range.

A package is a ZIP file with two stored members: ``archive/data.warc.gz`` (one gzip member per record) and
``indexes/index.cdx`` (a line per record: id, offset, length).  The reader never extracts a package: it reads the end of
the file, follows the ZIP64 records if there are any, reads the central directory and each member's local header, and
then range-reads the index and single records.  A package's records are dealt over tasks in slices, so a long package
needs no single task.

Records with equal payloads of at least ``least`` bytes are written once: that with the smallest id is a ``response``,
the others are ``revisit`` records that name it and keep the payload's digest and length.

Defined results: a null payload is empty; null ids come last in the order of ids and are named ``-``; of repeated rows
with one id one is the response and the others revisit it; an empty table gives no packages and no rows; other columns
are not read.  Packages lie below ``spark.checkpoint.dir``; only those of tasks that ended well are read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txrisk.llm.common import batches_of, open_fs, scratch, spread, written

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"

#: Records in one package and in one slice of a package.
PACKAGE_RECORDS, SLICE_RECORDS = 20_000, 2_000

#: Signatures of the ZIP format (fixed values).
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF

DATE = "2024-01-01T00:00:00Z"


# --- WARC records -------------------------------------------------------------

def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, revisit: bool, refers_to: int | None) -> bytes:
    """A WARC response, or a revisit of ``refers_to`` without the payload, as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{_name(page_id)}>",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {_line(url)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{_name(refers_to)}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def _name(page_id: int | None) -> str:
    return "-" if page_id is None else str(page_id)


def _line(url: str | None) -> str:
    """A URL on one line."""
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "urn:none")


def parse(member: bytes) -> dict:
    """Headers and payload of one gzip member that holds one record."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if len(block) < int(headers["Content-Length"]):
        raise ValueError("a WARC record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    return {"headers": headers, "size": int(fields["Content-Length"]), "payload": payload}


# --- ZIP packages -------------------------------------------------------------

def _pair64(size: int, offset: int) -> tuple[int, int, bytes]:
    """Size and offset fields of a central entry, and its ZIP64 extra field if one of them needs it."""
    extra = b""
    if size >= FULL32:
        extra += struct.pack("<QQ", size, size)
    if offset >= FULL32:
        extra += struct.pack("<Q", offset)
    return min(size, FULL32), min(offset, FULL32), struct.pack("<HH", 1, len(extra)) + extra if extra else b""


def package(records: Iterator[tuple[str, bytes]], out: BinaryIO, zip64: bool = False) -> int:
    """Write a package of (id, record) to a stream.  Returns the number of records.

    Sizes stand behind the data (streaming), so nothing is held but the index.  ``zip64`` writes ZIP64 ends even where
    they are not needed.
    """
    index, at, data, crc, count = [], 0, 0, 0, 0

    def put(piece: bytes) -> None:
        nonlocal at
        out.write(piece)
        at += len(piece)

    def local(name: str) -> None:
        put(LOCAL + struct.pack("<5H3I2H", 45, 8, 0, 0, 0x21, 0, 0, 0, len(name), 0) + name.encode())

    def described(crc: int, size: int) -> None:
        put(b"PK\x07\x08" + struct.pack("<IQQ", crc, size, size))

    local(DATA)
    for name, piece in records:
        index.append(f"{name} {data} {len(piece)}\n")
        crc, data, count = zlib.crc32(piece, crc), data + len(piece), count + 1
        put(piece)
    described(crc, data)
    second, lines = at, "".join(index).encode()
    local(INDEX)
    put(lines)
    described(zlib.crc32(lines), len(lines))
    start = at
    for name, sum_, size, offset in ((DATA, crc, data, 0), (INDEX, zlib.crc32(lines), len(lines), second)):
        short, place, extra = _pair64(size, offset)
        put(CENTRAL + struct.pack("<6H3I5H2I", 45, 45, 8, 0, 0, 0x21, sum_, short, short, len(name), len(extra), 0, 0, 0, 0, place)
            + name.encode() + extra)
    length = at - start
    if zip64 or start >= FULL32:
        end64 = at
        put(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 2, 2, length, start))
        put(LOCATOR64 + struct.pack("<IQI", 0, end64, 1))
        put(END + struct.pack("<4H2IH", 0, 0, FULL16, FULL16, FULL32, FULL32, 0))
    else:
        put(END + struct.pack("<4H2IH", 0, 0, 2, 2, length, start, 0))
    return count


def directory(read, size: int) -> dict[str, tuple[int, int]]:
    """Place and size of the stored members of a ZIP file; ``read(offset, length)`` returns bytes of it.

    Members that are compressed are left out: their records cannot be read by range.
    """
    tail_at = max(0, size - 22 - FULL16 - 20)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)  # the signature may stand in the comment
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if FULL16 == count or FULL32 in (length, start):
        if tail[at - 20: at - 16] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        end64 = read(struct.unpack_from("<Q", tail, at - 12)[0], 56)
        if end64[:4] != END64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", end64, 32)
    central, out, p = read(start, length), {}, 0
    for _ in range(count):
        if central[p: p + 4] != CENTRAL:
            raise ValueError("a central directory entry is broken")
        method = struct.unpack_from("<H", central, p + 10)[0]
        short, full, n, e, c = struct.unpack_from("<IIHHH", central, p + 20)
        offset = struct.unpack_from("<I", central, p + 42)[0]
        name, extra = central[p + 46: p + 46 + n].decode(), central[p + 46 + n: p + 46 + n + e]
        wide = _extra64(extra)
        if full == FULL32:
            full = wide.pop(0)
        if short == FULL32:
            short = wide.pop(0)
        if offset == FULL32:
            offset = wide.pop(0)
        p += 46 + n + e + c
        if method == 0 and short == full:
            head = read(offset, 30)
            if head[:4] != LOCAL:
                raise ValueError("a local header is broken")
            n, e = struct.unpack_from("<HH", head, 26)
            out[name] = (offset + 30 + n + e, full)
    return out


def _extra64(extra: bytes) -> list[int]:
    """Numbers of the ZIP64 extra field, in order."""
    p = 0
    while p + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, p)
        if kind == 1:
            return list(struct.unpack_from(f"<{length // 8}Q", extra, p + 4))
        p += 4 + length
    return []


def _reader(path: str):
    """(read, size, file) of a package."""
    store, place = open_fs(path)
    file = store.open_input_file(place)
    return (lambda at, length: file.read_at(length, at)), file.size(), file


# --- Spark --------------------------------------------------------------------

def typed(pages: DataFrame, least: int = 0, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html") -> DataFrame:
    """(page_id, url, payload, size, digest, revisit, refers_to); a revisit has no payload."""
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"),
                        F.coalesce(F.col(payload_column).cast("string").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "row")
    first = (rows.filter(F.col("size") >= least).groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"))
             .filter("copies > 1").select("digest", F.col("first.row").alias("first_row"), F.col("first.page_id").alias("first_id")))
    revisit = F.col("first_row").isNotNull() & (F.col("first_row") != F.col("row"))
    return rows.join(first, "digest", "left").select("page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "size", "digest",
                                                     revisit.alias("revisit"), F.when(revisit, F.col("first_id")).alias("refers_to"))


def write_packages(records: DataFrame, package_records: int = PACKAGE_RECORDS) -> DataFrame:
    """Packages of the rows of ``typed``, at least one per task.  Returns (path, n_records)."""
    batches_of(records.sparkSession)
    folder = scratch(records.sparkSession, "packages")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _rows(batches)
        row = next(rows, None)
        while row is not None:
            path = f"{folder}/{uuid.uuid4().hex}.wacz"

            def some(head: tuple) -> Iterator[tuple[str, bytes]]:
                nonlocal row
                row = head
                for _ in range(package_records):
                    if row is None:
                        return
                    page_id, url, payload, size, digest, revisit, refers_to = row
                    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
                    yield _name(page_id), record(page_id, url, payload, size, sha1, revisit, refers_to)
                    row = next(rows, None)

            store, place = open_fs(path)
            store.create_dir(place.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(f"{place}.tmp") as out:
                count = package(some(row), out)
            store.move(f"{place}.tmp", place)
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count], pa.int64())], ["path", "n_records"])

    return written(records.mapInArrow(task, "path string, n_records long"), "packages")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def read_packages(packages: DataFrame, slice_records: int = SLICE_RECORDS) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload) of every record of the packages in ``path``."""

    def slices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path in frame["path"]:
                read, size, file = _reader(path)
                with file:
                    members = directory(read, size)
                    base = members[DATA][0]
                    lines = read(*members[INDEX]).decode().splitlines()
                places = [tuple(map(int, x.rsplit(" ", 2)[1:])) for x in lines]
                for a in range(0, len(places), slice_records):
                    part = places[a: a + slice_records]
                    yield pd.DataFrame({"path": [path], "slice": [a // slice_records], "offsets": [[base + o for o, _ in part]],
                                        "lengths": [[n for _, n in part]]})

    def records(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, _, offsets, lengths in frame.itertuples(index=False):
                read, _, file = _reader(path)
                out = []
                with file:
                    for offset, length in zip(offsets.tolist(), lengths.tolist()):
                        out.append(_parsed(read(offset, length)))
                        if len(out) == 200:
                            yield pd.DataFrame(out, columns=COLUMNS).astype(TYPES)
                            out = []
                if out:
                    yield pd.DataFrame(out, columns=COLUMNS).astype(TYPES)

    cut = written(packages.select("path").mapInPandas(slices, "path string, slice long, offsets array<long>, lengths array<long>"), "slices")
    return cut.repartition(spread(packages.sparkSession, cut.count()), "path", "slice").mapInPandas(
        records, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
TYPES = {"page_id": "Int64", "payload_bytes": "int64", "refers_to": "Int64"}


def _parsed(member: bytes) -> tuple:
    found = parse(member)
    headers, kind = found["headers"], found["headers"]["WARC-Type"]
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(found["payload"]) != found["size"]
                               or base64.b32encode(hashlib.sha1(found["payload"]).digest()).decode() != digest):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
    return (_id(headers["WARC-Record-ID"]), found["size"], digest, kind, _id(headers.get("WARC-Refers-To")),
            found["payload"] if kind == "response" else None)


def _id(urn: str | None) -> int | None:
    name = (urn or "-").strip("<>").rsplit(":", 1)[-1]
    return None if name == "-" else int(name)

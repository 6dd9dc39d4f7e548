import base64
import gzip
import hashlib
import io
import zipfile

import duckdb
import pytest

from tests.conftest import SF_MID
from txrisk.llm import archives
from txrisk.llm.queries import ORACLE, QUERIES


def reader(data):
    return lambda at, n: data[at: at + n]


@pytest.mark.parametrize("zip64", [False, True])
@pytest.mark.parametrize("count", [0, 1, 50])
def test_packages_are_zip_files(zip64, count):
    out = io.BytesIO()
    records = [(str(i), gzip.compress(b"record %d" % i)) for i in range(count)]
    assert archives.package(iter(records), out, zip64) == count
    data = out.getvalue()
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and z.namelist() == [archives.DATA, archives.INDEX]
        assert z.read(archives.DATA) == b"".join(r for _, r in records)
    members = archives.directory(reader(data), len(data))
    at, size = members[archives.INDEX]
    lines = data[at: at + size].decode().splitlines()
    base = members[archives.DATA][0]
    for line, (name, piece) in zip(lines, records, strict=True):
        own, offset, length = line.split(" ")
        assert own == name and data[base + int(offset): base + int(offset) + int(length)] == piece


def test_foreign_zip_files():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("packed.txt", b"x" * 1000, zipfile.ZIP_DEFLATED)
        with z.open(zipfile.ZipInfo("wide.bin"), "w", force_zip64=True) as f:
            f.write(b"wide")
        z.writestr("a.txt", b"stored")
        z.comment = b"PK\x05\x06 in a comment"
    data = out.getvalue()
    members = archives.directory(reader(data), len(data))
    assert set(members) == {"wide.bin", "a.txt"}  # the packed member can't be read by range
    at, size = members["a.txt"]
    assert data[at: at + size] == b"stored"


def test_central_entries_beyond_4_gib():
    """Sizes and places beyond 32 bits stand in the extra field."""
    big = 5 << 32
    size, place, extra = archives._pair64(big, big + 7)
    assert (size, place) == (archives.FULL32, archives.FULL32)
    assert archives._extra64(b"\x99\x99\x02\x00ab" + extra) == [big, big, big + 7]


def test_broken_files_are_refused():
    with pytest.raises(ValueError, match="end of central directory"):
        archives.directory(reader(b"nothing here"), 12)


def test_record_round_trip():
    for payload in (b"", b"x\r\n\r\ny", "é".encode() * 1000):
        found = archives.parse(archives.record(4, "http://a b/\n", payload, len(payload), "D", False, None))
        assert found["payload"] == payload and found["size"] == len(payload) and found["headers"]["WARC-Type"] == "response"
    found = archives.parse(archives.record(None, None, None, 9, "D", True, 4))
    assert found["payload"] == b"" and found["size"] == 9 and found["headers"]["WARC-Refers-To"] == "<urn:page:4>"


def test_pages_come_back(spark):
    rows = [(0, "http://a", "same", 1), (1, "http://b", "same", 1), (2, None, "other", 1), (3, "u", None, 1), (4, "u", "", 1),
            (5, "u", "é\r\n\r\n" * 50_000, 1), (None, "u", "same", 1), (None, "u", "alone", 1), (2, "u", "other", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    packages = archives.write_packages(archives.typed(pages.repartition(3)), package_records=2)
    assert packages.agg({"n_records": "sum"}).first()[0] == len(rows)
    got = archives.read_packages(packages, slice_records=1).collect()
    sha = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    seen = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str)
    assert seen == sorted([
        (0, 4, sha("same"), "response", None), (1, 4, sha("same"), "revisit", 0), (2, 5, sha("other"), "response", None),
        (2, 5, sha("other"), "revisit", 2), (3, 0, sha(""), "response", None), (4, 0, sha(""), "revisit", 3),
        (5, 300_000, sha("é\r\n\r\n" * 50_000), "response", None), (None, 4, sha("same"), "revisit", 0),
        (None, 5, sha("alone"), "response", None)], key=str)
    assert {r.page_id: bytes(r.payload) for r in got if r.record_type == "response"}[5] == ("é\r\n\r\n" * 50_000).encode()


def test_small_payloads_are_not_shared(spark):
    pages = spark.createDataFrame([(0, "u", "ab"), (1, "u", "ab"), (2, "u", "abcd"), (3, "u", "abcd")], "page_id long, url string, html string")
    got = archives.read_packages(archives.write_packages(archives.typed(pages, least=3))).collect()
    assert {r.page_id: r.record_type for r in got} == {0: "response", 1: "response", 2: "response", 3: "revisit"}


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert archives.read_packages(archives.write_packages(archives.typed(pages))).count() == 0


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_MID}/pages.parquet'")
    got = {tuple(r) for r in QUERIES["op9_zip_archives"](spark, SF_MID).collect()}
    assert got == set(con.sql(ORACLE["op9_zip_archives"]).fetchall())


def test_several_tasks_read(spark):
    from pyspark.sql import functions as F
    pages = spark.createDataFrame([(i, f"http://x.org/{i}", "p" * (i % 7)) for i in range(300)], "page_id long, url string, html string")
    packages = archives.write_packages(archives.typed(pages.repartition(2)), package_records=50)
    read = archives.read_packages(packages, slice_records=10)
    assert read.count() == 300
    assert read.select(F.spark_partition_id()).distinct().count() > 4

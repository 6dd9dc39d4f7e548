"""Helpers shared by the operators of this subpackage.

* scratch tables and files live in ``spark.checkpoint.dir`` (shared by driver and executors);
* ``WordScan`` finds and hashes the words of a whole Arrow batch with numpy, without a Python object per word.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rows per Arrow batch sent to Python: bounds a worker's memory for long texts.
ARROW_ROWS = 1000

#: Bytes hashed at a time inside a batch (numpy needs about 30 bytes of scratch per byte).
SEGMENT = 1 << 20

#: The white space of ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, kind: str) -> str:
    """A new path below ``spark.checkpoint.dir``; on a local master without that setting, below a fresh local folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="txrisk-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written once as Parquet into the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(spark: SparkSession, pieces: int, most: int = 32) -> int:
    """Partitions for so many small rows that each stand for much reading: some for every core, at most ``most`` rows in each.

    Such a shuffle needs a number, as by its bytes it would be joined to one partition.
    """
    return max(1, min(pieces, max(4 * spark.sparkContext.defaultParallelism, -(-pieces // most))))


def batches_of(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows per Arrow batch for the plans made from here on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def trimmed(task):
    """A task over Arrow batches that gives its freed memory back at its end, as Spark keeps the worker for later stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)

    return run


#: Bytes of one column that ``slices_by_bytes`` lets into one batch.
SLICE_BYTES = 2 << 20


def slices_by_bytes(batches: Iterator[pa.RecordBatch], text_at: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the column ``text_at`` has at most ``most`` bytes in each; a longer text stands alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < len(sizes):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI (``file:``, ``hdfs:``, ``s3:``, ``gs:`` or a bare absolute path)."""
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, chunks: Iterator[bytes]) -> int:
    """Write a file beside its place and move it there, so that a file that exists is whole.  Returns its size."""
    store, path = open_fs(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    own, size = f"{path}.{uuid.uuid4().hex}.tmp", 0
    with store.open_output_stream(own) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    store.move(own, path)
    return size


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on an array of uint64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Odd multipliers by place in a word.
PLACES = mix(np.arange(1, 1025, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (rows + 1, from 0) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


class WordScan:
    """The words ``[^\\x20\\x09-\\x0D]+`` of every row: ``starts``, ``ends`` (byte places), ``row``, ``hash`` (uint64).

    ``first`` has rows + 1 entries: the words of row r are ``first[r]:first[r + 1]``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, gaps: np.ndarray = SPACE):
        """``gaps``: the bytes that separate words; ``lower``: hash A-Z as a-z."""
        self.data, self.offsets, self.gaps = data, offsets, gaps
        n = len(data)
        space = gaps[data]
        begins = ~space
        ends = ~space
        if n:
            begins[1:] &= space[:-1]
            ends[:-1] &= space[1:]
            edge = np.unique(offsets[:-1][offsets[:-1] < n])
            begins[edge] = ~space[edge]
            before = edge[edge > 0] - 1
            ends[before] = ~space[before]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.hash = np.empty(len(self.starts), np.uint64)
        cuts = [0]
        while cuts[-1] < len(self.starts):
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(self.starts, self.starts[cuts[-1]] + SEGMENT))))
        for a, b in zip(cuts, cuts[1:]):
            self.hash[a:b] = self._hashes(a, b, lower)

    def _hashes(self, a: int, b: int, lower: bool) -> np.ndarray:
        lo, hi = self.starts[a], self.ends[b - 1]
        part = self.data[lo:hi]
        sizes = self.ends[a:b] - self.starts[a:b]
        heads = np.cumsum(sizes) - sizes
        chars = part[~self.gaps[part]]
        if lower:
            chars = LOWER[chars]
        place = np.arange(len(chars), dtype=np.int64) - np.repeat(heads, sizes)
        by = PLACES[place & 1023]
        if sizes.max() > 1024:
            by = by * (2 * (place >> 10).astype(np.uint64) + np.uint64(1))
        sums = np.add.reduceat((chars.astype(np.uint64) + np.uint64(1)) * by, heads)
        return mix(sums ^ (sizes.astype(np.uint64) << np.uint64(40)))

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every window of ``width`` words that lies inside one row."""
        n = len(self.hash) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = self.hash[:n].copy()
        for k in range(1, width):
            h = mix(h) * np.uint64(0x9E3779B97F4A7C15) + self.hash[k: n + k]
        at = np.flatnonzero(self.row[:n] == self.row[width - 1:])
        return at, mix(h[at])


#: Bins in which a value is looked for by its place.
BINS = 1024


def smallest(rows: DataFrame, k: int) -> float:
    """The value with ``k`` others before it, of rows (value double, n: how often it counts), by counts in bins that get narrower."""
    low, high = rows.agg(F.min("value"), F.max("value")).first()
    while low < high:
        step = (high - low) / BINS
        if low + step <= low or high - step >= high:  # as narrow as numbers are
            break
        place = F.least(F.floor((F.col("value") - low) / step), F.lit(BINS - 1))
        bins = (rows.filter(F.col("value").between(low, high)).groupBy(place.alias("place"))
                .agg(F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).sort("place").collect())
        for b in bins:
            if k < b["n"]:
                low, high = b["low"], b["high"]
                break
            k -= b["n"]
    return float(low)


#: Most bits of a filter (8 MiB).
FILTER_BITS = 26


def bit_filter(rows: DataFrame, value: str, count: int) -> np.ndarray:
    """Bits of the low part of a random long ``value``: at least 32 for each of ``count`` rows, as far as FILTER_BITS go.

    A row that is not in ``rows`` may pass, so a join must follow; with more rows than bits the filter only saves less.
    """
    size = 1 << min(FILTER_BITS, max(16, (32 * count).bit_length()))
    found = (rows.selectExpr(f"({value}) & {size - 1} AS place")
             .selectExpr("shiftright(place, 6) AS word", "shiftleft(1L, cast(place & 63 AS int)) AS bit")
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(size // 64, "<i8")
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint8)


def in_filter(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the longs may be in the filter."""
    place = values & (8 * len(bits) - 1)
    return ((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(bool)

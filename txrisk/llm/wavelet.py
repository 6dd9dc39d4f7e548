"""Token ids in wavelet-matrix files: one compressed file a shard that gives tokens, counts and places without unpacking.

A shard's ids are stored as bit planes, the highest bit first.  Plane k holds bit k of every id in the order that the
planes before it made: ids with bit 0 move stably before those with bit 1.  With the number of ones before any place
(``rank``) and the place of any one (``select``) a position is followed down the planes to its id, and an id's range in
the last order is followed up again to the positions where it stands.

File: blocks of each plane, compressed one by one; then a directory (block offsets, ones before each block, zeros of each
plane, document ids and starts); then a footer and its length.  A reader range-reads the footer, the directory and the
blocks that a question touches.

Documents are dealt by ranges of their id, so that shards follow one another in ascending order of ids, and a task writes
files of about ``shard_tokens``.  Only the numbers of tokens are summed over shards.

Defined results: null text is empty and consists of the end id; null ids come last; documents with one id stand in the
order of their text's hash; an empty table gives no files and no rows; other columns are not read.  Files lie below
``spark.checkpoint.dir``; only those of tasks that ended well are named.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from txrisk.llm import byte_bpe
from txrisk.llm.common import open_fs, scratch, slices_by_bytes, write_file, written

#: Marks of the format, bits of a block, blocks that a reader keeps.
MAGIC, BLOCK_BITS, KEPT_BLOCKS = b"WMX1", 1 << 16, 256

#: Tokens of a shard, and bytes of text encoded at once.
SHARD_TOKENS, CHUNK = 1 << 22, 8 << 20

FILES_SCHEMA = "path string, part long, shard long, n_docs long, n_tokens long"
DOCUMENT_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


# --- one file -----------------------------------------------------------------

def build(ids: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, int]]:
    """Each plane's bits and its number of zeros, the highest bit first."""
    for k in range(bits - 1, -1, -1):
        ones = (ids & ids.dtype.type(1 << k)).astype(bool)
        zeros = ~ones
        low = np.compress(zeros, ids)
        ids = np.concatenate([low, np.compress(ones, ids)])
        yield ones, len(low)


def write_wavelet(uri: str, ids: np.ndarray, doc_ids: list[int | None], starts: np.ndarray, bits: int = 16) -> None:
    """A file of ``ids`` (below 2^bits); document d has the ids from ``starts[d]`` to ``starts[d + 1]``."""
    blocks = -(-len(ids) // BLOCK_BITS)
    sizes, ranks, zeros = [0], np.zeros((bits, blocks + 1), np.int64), np.zeros(bits, np.int64)

    def data() -> Iterator[bytes]:
        for level, (ones, low) in enumerate(build(ids.astype(np.uint16 if bits <= 16 else np.uint32), bits)):
            zeros[level] = low
            for b in range(blocks):
                part = ones[b * BLOCK_BITS: (b + 1) * BLOCK_BITS]
                ranks[level, b + 1] = ranks[level, b] + np.count_nonzero(part)
                packed = pa.compress(np.packbits(part).tobytes(), codec="zstd", asbytes=True)
                sizes.append(len(packed))
                yield packed
        known = np.array([d is not None for d in doc_ids], np.uint8)
        directory = [np.cumsum(sizes, dtype=np.int64), ranks, zeros, np.array([d or 0 for d in doc_ids], np.int64), known, starts.astype(np.int64)]
        raw = b"".join(np.ascontiguousarray(x).tobytes() for x in directory)
        packed = pa.compress(raw, codec="zstd", asbytes=True)
        yield packed
        footer = json.dumps({"tokens": len(ids), "bits": bits, "docs": len(doc_ids), "block_bits": BLOCK_BITS,
                             "directory": [sum(sizes), len(packed), len(raw)]}).encode()
        yield footer + len(footer).to_bytes(4, "little") + MAGIC

    write_file(uri, data())


class WaveletFile:
    """Questions to one file; each reads the blocks that it needs."""

    def __init__(self, uri: str):
        store, path = open_fs(uri)
        self.file, size = store.open_input_file(path), store.get_file_info(path).size
        tail = self.file.read_at(min(size, 4096), max(0, size - 4096))
        if tail[-4:] != MAGIC:
            raise ValueError(f"no wavelet file: {uri}")
        length = int.from_bytes(tail[-8:-4], "little")
        about = json.loads(tail[-8 - length: -8])
        self.tokens_total, self.bits, self.docs, self.block_bits = (about[k] for k in ("tokens", "bits", "docs", "block_bits"))
        self.blocks = -(-self.tokens_total // self.block_bits)
        at, packed, raw = about["directory"]
        data = memoryview(pa.decompress(self.file.read_at(packed, at), raw, codec="zstd", asbytes=True))

        def column(count: int, dtype: type = np.int64) -> np.ndarray:
            nonlocal data
            size = count * np.dtype(dtype).itemsize
            out, data = np.frombuffer(data[:size], dtype), data[size:]
            return out

        self.offsets = column(self.bits * self.blocks + 1)
        self.ranks = column(self.bits * (self.blocks + 1)).reshape(self.bits, -1)
        self.zeros = column(self.bits)
        ids = column(self.docs).tolist()
        self.doc_ids = [i if known else None for i, known in zip(ids, column(self.docs, np.uint8).tolist())]
        self.starts = column(self.docs + 1)
        self.kept: OrderedDict[tuple[int, int], np.ndarray] = OrderedDict()

    def _size(self, block: int) -> int:
        return min(self.block_bits, self.tokens_total - block * self.block_bits)

    def _unpacked(self, data: bytes, block: int) -> np.ndarray:
        n = self._size(block)
        return np.unpackbits(np.frombuffer(pa.decompress(data, -(-n // 8), codec="zstd", asbytes=True), np.uint8), count=n)

    def _block(self, level: int, block: int) -> np.ndarray:
        """Bits of one block."""
        key = (level, block)
        if key not in self.kept:
            a, b = self.offsets[level * self.blocks + block: level * self.blocks + block + 2].tolist()
            self.kept[key] = self._unpacked(self.file.read_at(b - a, a), block)
            if len(self.kept) > KEPT_BLOCKS:
                self.kept.popitem(last=False)
        self.kept.move_to_end(key)
        return self.kept[key]

    def _ranks(self, level: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ones before each place (0 to the number of tokens), and the bit there (0 past the end)."""
        ones, bit = np.empty(len(places), np.int64), np.zeros(len(places), np.uint8)
        block = places // self.block_bits
        for b in np.unique(block).tolist():
            mine = np.flatnonzero(block == b)
            ones[mine] = self.ranks[level, min(b, self.blocks)]
            if b < self.blocks:
                bits = self._block(level, b)
                within = places[mine] - b * self.block_bits
                ones[mine] += np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])[within]
                bit[mine] = np.append(bits, 0)[within]
        return ones, bit

    def _select(self, level: int, one: bool, numbers: np.ndarray) -> np.ndarray:
        """Place of the one (or zero) that has so many before it."""
        before = self.ranks[level] if one else np.minimum(np.arange(self.blocks + 1) * self.block_bits, self.tokens_total) - self.ranks[level]
        block = np.searchsorted(before, numbers, "right") - 1
        places = np.empty(len(numbers), np.int64)
        for b in np.unique(block).tolist():
            mine = np.flatnonzero(block == b)
            places[mine] = np.flatnonzero(self._block(level, b) == one)[numbers[mine] - before[b]] + b * self.block_bits
        return places

    def access(self, places: np.ndarray) -> np.ndarray:
        """Ids at any places."""
        places, ids = np.asarray(places, np.int64), np.zeros(len(places), np.int64)
        for level in range(self.bits):
            ones, bit = self._ranks(level, places)
            ids = 2 * ids + bit
            places = np.where(bit == 1, self.zeros[level] + ones, places - ones)
        return ids

    def _range(self, token: int, begin: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` among the places from ``begin`` to ``end`` lie in the last order."""
        places = np.array([begin, end], np.int64)
        for level in range(self.bits):
            ones, _ = self._ranks(level, places)
            places = self.zeros[level] + ones if token >> (self.bits - 1 - level) & 1 else places - ones
        return int(places[0]), int(places[1])

    def count(self, token: int, begin: int = 0, end: int | None = None) -> int:
        """Occurrences of ``token`` among the places from ``begin`` to ``end``."""
        a, b = self._range(token, begin, self.tokens_total if end is None else end) if 0 <= token < 1 << self.bits else (0, 0)
        return b - a

    def occurrences(self, token: int, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Places of ``token``, ascending."""
        if not self.count(token, begin, end):
            return np.zeros(0, np.int64)
        places = np.arange(*self._range(token, begin, self.tokens_total if end is None else end), dtype=np.int64)
        for level in range(self.bits - 1, -1, -1):
            one = bool(token >> (self.bits - 1 - level) & 1)
            places = self._select(level, one, places - self.zeros[level] * one)
        return places

    def read(self) -> np.ndarray:
        """All ids: the planes undone from the last to the first."""
        ids = np.zeros(self.tokens_total, np.uint16 if self.bits <= 16 else np.uint32)
        for level in range(self.bits - 1, -1, -1):
            lo, hi = self.offsets[level * self.blocks], self.offsets[(level + 1) * self.blocks]
            data, at = self.file.read_at(int(hi - lo), int(lo)), self.offsets[level * self.blocks: (level + 1) * self.blocks + 1] - lo
            bits = [self._unpacked(data[a:b], k) for k, (a, b) in enumerate(zip(at.tolist(), at[1:].tolist()))]
            ones = np.concatenate(bits).view(bool) if bits else np.zeros(0, bool)
            before, low = np.empty_like(ids), self.zeros[level]
            before[np.flatnonzero(~ones)] = ids[:low]
            before[np.flatnonzero(ones)] = ids[low:] | ids.dtype.type(1 << (self.bits - 1 - level))
            ids = before
        return ids


# --- Spark --------------------------------------------------------------------

def write_shards(docs: DataFrame, vocabulary: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS,
                 id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Tokenise ``docs`` into wavelet files in ascending order of ids: (path, part, shard, n_docs, n_tokens, base).

    ``base`` is the number of ids in all files before.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "wavelet")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part = byte_bpe.load(vocabulary), TaskContext.get().partitionId()
        bits = int(bpe.size - 1).bit_length()
        ids, doc_ids, sizes, shard = [], [], [], 0

        def shard_row() -> pa.RecordBatch:
            nonlocal ids, doc_ids, sizes, shard
            path = f"{folder}/shard-{part:06d}-{shard:06d}-{uuid.uuid4().hex}.wmx"
            tokens, begins = np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            write_wavelet(path, tokens, doc_ids, begins, bits)
            row = [[path], [part], [shard], [len(doc_ids)], [len(tokens)]]
            ids, doc_ids, sizes, shard = [], [], [], shard + 1
            return pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["path", "part", "shard", "n_docs", "n_tokens"])

        for batch in _chunks(batches):
            tokens, begins = bpe.encode(batch.column(1).combine_chunks())
            ids.append(np.insert(tokens, begins[1:], end_id).astype(np.uint16 if bits <= 16 else np.uint32))
            doc_ids += batch.column(0).to_pylist()
            sizes.append(np.diff(begins) + 1)
            if sum(map(len, ids)) >= shard_tokens:
                yield shard_row()
        if doc_ids:
            yield shard_row()

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    files = written(dealt.mapInArrow(task, FILES_SCHEMA), "wavelet-files")
    before = lambda *by: Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    of_part = (files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
               .select("part", F.coalesce(F.sum("n").over(before("part")), F.lit(0)).alias("part_base")))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (files.withColumn("own_base", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(of_part, "part")
            .select("path", "part", "shard", "n_docs", "n_tokens", (F.col("part_base") + F.col("own_base")).alias("base")))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of about ``CHUNK`` bytes of text, or one longer text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in slices_by_bytes(batches, 1, CHUNK // 4):
        held.append(batch)
        size += batch.column(1).nbytes
        if size >= CHUNK:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _by_file(files: DataFrame, answer, schema: str) -> DataFrame:
    """``answer(file, base)`` (record batches) of every file, the files dealt over as many partitions."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from answer(WaveletFile(path), base)

    files = written(files.select("path", "base"), "wavelet-bases")
    return files.repartition(max(1, files.count()), "path").mapInArrow(task, schema)


def read_documents(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files of ``write_shards``."""

    def answer(file: WaveletFile, base: int) -> Iterator[pa.RecordBatch]:
        ids, starts = file.read(), file.starts.tolist()
        crc: list[int] = []
        for a, b in zip(starts, starts[1:]):
            value = 0
            for at in range(a, b, 1 << 20):
                value = zlib.crc32(ids[at: min(b, at + (1 << 20))].astype("<u4"), value)
            crc.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(file.doc_ids, pa.int64()), pa.array(file.starts[:-1] + base), pa.array(np.diff(file.starts)), pa.array(crc, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _by_file(files, answer, DOCUMENT_SCHEMA)


def find(files: DataFrame, token: int) -> DataFrame:
    """(doc_id, place): every occurrence of a token, with its place in its document; no file is unpacked for it."""

    def answer(file: WaveletFile, base: int) -> Iterator[pa.RecordBatch]:
        places = file.occurrences(token)
        doc = np.searchsorted(file.starts, places, "right") - 1
        yield pa.RecordBatch.from_arrays([pa.array(file.doc_ids, pa.int64()).take(pa.array(doc)), pa.array(places - file.starts[doc])], ["doc_id", "place"])

    return _by_file(files, answer, "doc_id long, place long")


def count(files: DataFrame, tokens: list[int]) -> DataFrame:
    """(token, n): how often each of the tokens stands in all files."""

    def answer(file: WaveletFile, base: int) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array([file.count(t) for t in tokens], pa.int64())], ["token", "n"])

    return _by_file(files, answer, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))

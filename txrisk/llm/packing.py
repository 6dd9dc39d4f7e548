"""Best-fit packing: tokenised documents into sequences of at most ``size`` tokens, by best-two-fit.

A sequence is filled greedily, the longest piece that fits first.  If a gap is left, its smallest piece is exchanged
for the two unpacked pieces that fill the widened gap best, when they fill more than the piece did.

Spark tokenises in place and keeps one small row per piece.  The pieces are dealt evenly over groups of about
``group_pieces``; each group is packed by one task, so the work grows with the input and no task with it.  A group
costs at most its last few sequences.

Defined results: null text is empty and packs as the end token alone; repeated rows are pieces of their own; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from txrisk.llm import word_bpe
from txrisk.llm.common import batches_of, trimmed, written

PIECE_SCHEMA = "doc_id long, piece int, start long, length int, ids_crc32 long, deal long"
PACKED_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def tokenised_pieces(docs: DataFrame, vocabulary: str, size: int = 4096, end_id: int = 1,
                     id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece of at most ``size`` tokens: the ids of the text, then ``end_id``.  ``deal`` is an even spread."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe.load(vocabulary)
        end, count = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId() << 36
        for chunk in word_bpe.chunks(batches, 1):
            ids, begins = bpe.encode(word_bpe.single(chunk.column(1)))
            data, begins = memoryview(ids), begins.tolist()
            rows: list[tuple] = []
            for doc_id, a, b in zip(chunk.column(0).to_pylist(), begins, begins[1:]):
                for piece, at in enumerate(range(a, b + 1, size)):
                    to = min(at + size, b)
                    crc, length = zlib.crc32(data[4 * at: 4 * to]), to - at
                    if to == b and length < size:
                        crc, length = zlib.crc32(end, crc), length + 1
                    count += 1
                    rows.append((doc_id, piece, at - a, length, crc, count * 0x9E3779B97F4A7C15 % (1 << 63)))
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "deal")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(names))

    batches_of(docs.sparkSession)
    return docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string")).mapInArrow(trimmed(pieces), PIECE_SCHEMA)


def best_two_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece; lengths lie in 1..size."""
    pool: list[list[int]] = [[] for _ in range(size + 1)]
    for i, length in enumerate(lengths.tolist()):
        pool[length].append(i)
    free = 0  # bit L: a piece of L tokens is unpacked
    for length, pieces in enumerate(pool):
        if pieces:
            free |= 1 << length

    def take(length: int) -> int:
        nonlocal free
        piece = pool[length].pop()
        if not pool[length]:
            free ^= 1 << length
        return piece

    def best_pair(room: int) -> tuple[int, int]:
        """The two unpacked lengths with the largest sum of at most ``room``; (0, 0) if there are none."""
        bits = free & ((1 << (room + 1)) - 1)
        best = (0, 0)
        while bits:
            a = bits.bit_length() - 1
            bits ^= 1 << a
            if 2 * a <= best[0] + best[1]:
                break
            fit = free & ((1 << (min(room - a, a) + 1)) - 1)
            b = fit.bit_length() - 1
            if b == a and len(pool[a]) < 2:
                b = (fit ^ (1 << a)).bit_length() - 1
            if b > 0 and a + b > best[0] + best[1]:
                best = (a, b)
                if a + b == room:
                    break
        return best

    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    number = 0
    while free:
        chosen: list[tuple[int, int]] = []
        gap = size
        while fits := free & ((1 << (gap + 1)) - 1):
            length = fits.bit_length() - 1
            chosen.append((take(length), length))
            gap -= length
        if gap and free:
            piece, smallest = chosen[-1]
            a, b = best_pair(gap + smallest)
            if a + b > smallest:
                chosen.pop()
                chosen += [(take(a), a), (take(b), b)]
                pool[smallest].append(piece)
                free |= 1 << smallest
        at = 0
        for piece, length in chosen:
            sequence[piece], offset[piece] = number, at
            at += length
        number += 1
    return sequence, offset


def pack(pieces: DataFrame, size: int = 4096, group_pieces: int = 32_768) -> DataFrame:
    """Sequence and offset of every row of ``tokenised_pieces``."""
    pieces = written(pieces, "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "deal"]).reset_index(drop=True)
        sequence, offset = best_two_fit(group["length"].to_numpy(), size)
        out = group[["doc_id", "piece", "start", "length", "ids_crc32"]].copy()
        out["sequence_id"] = (int(group["grp"].iloc[0]) << 32) + sequence
        out["offset"] = offset
        return out.astype({"length": "int64"})

    return (pieces.withColumn("grp", F.pmod(F.col("deal"), F.lit(groups)))
            .groupBy("grp").applyInPandas(one, PACKED_SCHEMA))

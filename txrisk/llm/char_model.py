"""A modified Kneser-Ney model of unfolded characters, one for each value of ``lang``, built by Spark.

N-grams are of code points as they stand, so every script has its own, and the model grows with the corpus.  Each batch
counts its distinct 4-grams, Spark adds them up, and probabilities of orders 1 to 4 come from joins of the counted tables;
neither counts nor model are gathered on the driver to be built.  As the model is of the very texts that are scored, every
4-gram of theirs is in it.

A model of at most ``SENT`` 4-grams is then sent to the tasks as sorted hash arrays.  A larger one stays in Spark: the
texts' 4-grams are joined with it by their hash and added up for each text.  Both give the same scores.

Keys are 64-bit hashes of language and code points; a score would be wrong only by a collision of those.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txrisk.llm.common import batches_of, mix, slices_by_bytes, trimmed, utf8, written

ORDER = 4
PLACES = ["a", "b", "c", "d"]

#: Most 4-grams of a model that is sent to tasks (16 bytes each).
SENT = 4_000_000

#: Bytes of text worked on at once (numpy needs about 60 bytes of scratch a character), and 4-grams that a task holds.
SLICE, HELD = 1 << 20, 1 << 20

GOLD = np.uint64(0x9E3779B97F4A7C15)


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all rows, and where each row's begin (rows + 1)."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    if heads[-1] != len(points):  # invalid UTF-8: row by row
        parts = [data[a:b].tobytes().decode("utf-8", "replace").encode("utf-32-le") for a, b in zip(offsets, offsets[1:])]
        points = np.frombuffer(b"".join(parts), np.uint32)
        heads = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])])
    return points, heads


class Grams:
    """The 4-grams inside every row: distinct ``key``, ``inverse`` and ``row`` of each occurrence, ``at`` a first one in ``points``."""

    def __init__(self, texts: pa.Array, languages: pa.Array):
        self.points, heads = code_points(*utf8(texts))
        row = np.repeat(np.arange(len(texts)), np.diff(heads))
        n = max(len(self.points) - ORDER + 1, 0)
        at = np.flatnonzero(row[:n] == row[len(row) - n:])
        self.row = row[at]
        wide = self.points.astype(np.uint64)
        key = mix(wide[at] | wide[at + 1] << np.uint64(21) | wide[at + 2] << np.uint64(42)) + wide[at + 3] * GOLD
        names, number = language_hashes(languages)
        key = mix(key ^ names[number][self.row])
        coded = pa.array(key).dictionary_encode()
        self.key, self.inverse = coded.dictionary.to_numpy(), coded.indices.to_numpy(zero_copy_only=False)
        # the dictionary is in the order of first occurrences
        first = np.flatnonzero(np.diff(np.maximum.accumulate(self.inverse), prepend=-1))
        self.at, self.language = at[first], number[self.row[first]]


def language_hashes(languages: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each distinct value of a column (null is one), and every row's place among them."""
    coded = languages.dictionary_encode("encode")
    names = coded.dictionary.to_pylist()
    hashes = [0 if x is None else int.from_bytes(_digest(x), "little") for x in names]
    return np.array(hashes, np.uint64), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _digest(name: str) -> bytes:
    return hashlib.blake2b(name.encode("utf-8", "replace"), digest_size=8).digest()


COUNTED = ["key", "lang", *PLACES, "n"]


def _merged(parts: list[pa.Table]) -> pa.Table:
    """The parts with each key once."""
    whole = pa.concat_tables(parts).combine_chunks()
    coded = whole.column("key").combine_chunks().dictionary_encode()
    place = coded.indices.to_numpy(zero_copy_only=False)
    first = np.flatnonzero(np.diff(np.maximum.accumulate(place), prepend=-1))
    n = np.bincount(place, whole.column("n").to_numpy(), len(first)).astype(np.int64)
    return whole.take(pa.array(first)).set_column(len(COUNTED) - 1, "n", pa.array(n))


def counted(docs: DataFrame) -> DataFrame:
    """(key, lang, a, b, c, d, n): how often every 4-gram of code points stands in the texts of every language."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in slices_by_bytes(batches, 0, SLICE):
            grams = Grams(batch.column(0), batch.column(1))
            names = batch.column(1).dictionary_encode("encode").dictionary
            points = [pa.array(grams.points[grams.at + k].astype(np.int32)) for k in range(ORDER)]
            n = np.bincount(grams.inverse, minlength=len(grams.key))
            held.append(pa.table([pa.array(grams.key.view(np.int64)), names.take(pa.array(grams.language)), *points, pa.array(n)], COUNTED))
            if sum(map(len, held)) > HELD:
                held = [_merged(held)]
                if len(held[0]) > HELD // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from _merged(held).to_batches()

    batches_of(docs.sparkSession)
    rows = docs.select(F.col("text").cast("string"), F.col("lang").cast("string"))
    return (rows.mapInArrow(trimmed(task), "key long, lang string, a int, b int, c int, d int, n long")
            .groupBy("key", "lang", *PLACES).agg(F.sum("n").alias("n")))


def _discounted(level: DataFrame) -> DataFrame:
    """Adds ``cut``, the modified Kneser-Ney discount of each count, from its language's counts of counts."""
    few = level.groupBy("lang").agg(*(F.count_if(F.col("n") == k).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)))
    n = [F.col(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.when(n[0] > 0, n[0] / (n[0] + 2 * n[1])).otherwise(0.5)

    def take(k: int) -> F.Column:
        raw = k - (k + 1) * F.col("y") * n[k] / n[k - 1]
        return F.when(n[k - 1] > 0, F.least(F.greatest(raw, F.lit(0.0)), F.lit(float(k)))).otherwise(F.col("y"))

    takes = few.withColumn("y", y).select(F.col("lang").alias("of"), *(take(k).alias(f"d{k}") for k in (1, 2, 3)))
    d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    return (level.join(F.broadcast(takes), F.col("lang").eqNullSafe(F.col("of")))
            .withColumn("cut", F.least(d, F.col("n").cast("double"))).drop("of", "d1", "d2", "d3"))


def _joined(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join in which null is a language like any other."""
    right = right.select(*(F.col(c).alias(f"r_{c}") if c in on else F.col(c) for c in right.columns))
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"r_{c}"))
    return left.join(right, condition).drop(*(f"r_{c}" for c in on))


def probabilities(counts: DataFrame) -> DataFrame:
    """(key, log_p): interpolated log-probability of each 4-gram's last character after the three before.

    The highest order uses counts, a lower one the number of characters seen before the n-gram.
    """
    levels = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        levels[order] = levels[order + 1].groupBy("lang", *PLACES[ORDER - order:]).agg(F.count(F.lit(1)).alias("n"))
    size = levels[1].groupBy("lang").agg((1 / (F.count(F.lit(1)) + 1)).alias("lower"))
    lower, on = size, ["lang"]
    for order in range(1, ORDER + 1):
        head = ["lang", *PLACES[ORDER - order: -1]]
        cut = _discounted(levels[order])
        heads = cut.groupBy(*head).agg(F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("left"))
        level = _joined(_joined(cut, heads, head), lower, on)
        p = (F.col("n") - F.col("cut")) / F.col("total") + F.col("left") * F.col("lower")
        if order == ORDER:
            return level.select("key", F.log(p).alias("log_p"))
        on = ["lang", *PLACES[ORDER - order:]]
        lower = level.select(*on, p.alias("lower"))


def model(docs: DataFrame) -> DataFrame:
    """(key, log_p) of all 4-grams of ``docs``."""
    return written(probabilities(written(counted(docs), "grams")), "model")


def sent(table: DataFrame, most: int | None = None):
    """The model as a broadcast pair of arrays, by key; None if it has more than ``most`` 4-grams."""
    if table.count() > (SENT if most is None else most):
        return None
    found = table.toArrow()
    keys = found.column("key").to_numpy().astype(np.int64).view(np.uint64)
    by = np.argsort(keys)
    return table.sparkSession.sparkContext.broadcast((keys[by], found.column("log_p").to_numpy()[by]))


def means(grams: Grams, arrays: tuple[np.ndarray, np.ndarray], rows: int) -> pa.Array:
    """Mean negative log-probability of each row's characters; null without any 4-gram."""
    keys, log_p = arrays
    value = log_p[np.searchsorted(keys, grams.key)][grams.inverse] if len(grams.key) else np.zeros(0)
    size = np.bincount(grams.row, minlength=rows)
    return pa.array(-np.bincount(grams.row, value, minlength=rows) / np.maximum(size, 1), mask=size == 0)


def joined_means(docs: DataFrame, table: DataFrame) -> DataFrame:
    """(text_key, char_score) of every distinct text of a language, from ``docs`` (text, lang, text_key), by a join on the hash."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, 0, SLICE):
            grams = Grams(batch.column(0), batch.column(1))
            pairs, n = np.unique(grams.row * max(len(grams.key), 1) + grams.inverse, return_counts=True)
            row, gram = np.divmod(pairs, max(len(grams.key), 1))
            yield pa.RecordBatch.from_arrays([batch.column(2).take(pa.array(row)), pa.array(grams.key[gram].astype(np.int64)), pa.array(n)],
                                             ["text_key", "key", "n"])

    once = docs.select("text", "lang", "text_key").dropDuplicates(["text_key"])
    seen = once.mapInArrow(trimmed(task), "text_key long, key long, n long")
    return (seen.join(table, "key").groupBy("text_key")
            .agg((-F.sum(F.col("n") * F.col("log_p")) / F.sum("n")).alias("char_score")))

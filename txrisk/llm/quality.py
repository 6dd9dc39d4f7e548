"""Quality rules with n-gram perplexity.

A text has two scores, both its mean negative log-probability per character under modified Kneser-Ney models:

* ``score`` is over 32 folded classes (letters without case and accents, digit, space, kinds of mark).  It tells marks and
  letter salad from prose.  The folded models are of fixed size, for four languages and one for all others.
* ``char_score`` is over unfolded characters (``char_model``), with a model for each value of ``lang`` that grows with the
  corpus.  It judges every script and every language by itself.

Each value of ``lang`` has a lower and an upper band for both, around the median of its texts that pass the base rules; a
text outside one of them is rejected.

Defined results: null text is empty, has no words and fails the base rules; a text without a score (under 4 characters)
is judged by the base rules alone; texts without a language are a language; repeated rows are judged alike; an empty
table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txrisk.llm import char_model
from txrisk.llm.common import SPACE, WordScan, batches_of, mix, slices_by_bytes, trimmed, utf8, written

#: Languages with a class model of their own; all others share the last one.
LANGUAGES = ("de", "en", "es", "fr")

ORDER, BITS = 4, 5
CLASSES = 1 << BITS

#: Marks that the base rules count as symbols (fixed values).
SYMBOLS = "#*$%&|<>"


def _classes() -> np.ndarray:
    """Class of the code points below 0x250: 0 space, 1-26 letters, 27 digit, 28 stop, 29 symbol, 30 mark, 31 other letter."""
    out = np.empty(0x250, np.uint8)
    for point in range(len(out)):
        char = chr(point)
        base = unicodedata.normalize("NFKD", char)[:1].lower()
        if char.isspace() or point < 32:
            out[point] = 0
        elif "a" <= base <= "z":
            out[point] = ord(base) - 96
        elif char.isdigit():
            out[point] = 27
        elif char in ".,;:":
            out[point] = 28
        elif char in SYMBOLS:
            out[point] = 29
        else:
            out[point] = 31 if char.isalpha() else 30
    return out


CLASS_OF = _classes()


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code (20 bits, the last character lowest) and row of every 4-gram of classes inside one row."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    if heads[-1] != len(points):  # invalid UTF-8: row by row
        parts = [data[a:b].tobytes().decode("utf-8", "replace").encode("utf-32-le") for a, b in zip(offsets, offsets[1:])]
        points = np.frombuffer(b"".join(parts), np.uint32)
        heads = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])])
    kinds = CLASS_OF[np.minimum(points, len(CLASS_OF) - 1)].astype(np.uint32)
    kinds[points >= len(CLASS_OF)] = 31
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(heads))
    if len(kinds) < ORDER:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    code = kinds[3:] | kinds[2:-1] << 5 | kinds[1:-2] << 10 | kinds[:-3] << 15
    inside = row[3:] == row[:-3]
    return code[inside], row[3:][inside]


def slots(languages: list) -> np.ndarray:
    """Model number of each row's language."""
    of = {name: k for k, name in enumerate(LANGUAGES)}
    return np.array([of.get(x, len(LANGUAGES)) for x in languages], np.int64)


def count_grams(docs: DataFrame) -> DataFrame:
    """(slot, code, n) over all texts: counted in every task, then by Spark."""
    span = CLASSES ** ORDER

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for batch in slices_by_bytes(batches, 0, char_model.SLICE):
            code, row = grams(*utf8(batch.column(0)))
            slot = slots(batch.column(1).to_pylist())[row]
            for s in np.unique(slot).tolist():
                counts = np.bincount(code[slot == s], minlength=span)
                seen[s] = seen[s] + counts if s in seen else counts
        for s, counts in seen.items():
            code = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), s, np.int32)), pa.array(code.astype(np.int32)),
                                              pa.array(counts[code])], ["slot", "code", "n"])

    batches_of(docs.sparkSession)
    return (docs.select(F.col("text").cast("string"), F.col("lang").cast("string"))
            .mapInArrow(trimmed(task), "slot int, code int, n long").groupBy("slot", "code").agg(F.sum("n").alias("n")))


def _hash(slot: int, order: int, codes: np.ndarray) -> np.ndarray:
    return mix(codes.astype(np.uint64) | np.uint64(order << 32) | np.uint64((slot + 1) << 40))


class KneserNey:
    """Interpolated modified Kneser-Ney over n-gram hashes.

    ``keys`` are the sorted hashes of all n-grams of all orders and languages; ``prob`` has each one's interpolated
    probability, ``left`` the weight that it leaves, as a context, to the next lower order.
    """

    def __init__(self, counts: pd.DataFrame):
        keys, prob, left = [], [], []
        for slot, part in counts.groupby("slot"):
            for order, codes, p, weight in _interpolated(part["code"].to_numpy(np.int64), part["n"].to_numpy(np.float64)):
                keys.append(_hash(int(slot), order, codes))
                prob.append(p)
                left.append(weight)
        keys = np.concatenate([np.zeros(0, np.uint64), *keys])
        by = np.argsort(keys, kind="stable")
        self.keys = keys[by]
        self.prob = np.concatenate([np.zeros(0), *prob])[by]
        self.left = np.concatenate([np.zeros(0), *left])[by]
        self.tables: dict[int, np.ndarray] = {}

    def _find(self, slot: int, order: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = _hash(slot, order, codes)
        at = np.minimum(np.searchsorted(self.keys, wanted), max(len(self.keys) - 1, 0))
        return at, (self.keys[at] == wanted) if len(self.keys) else np.zeros(len(wanted), bool)

    def table(self, slot: int) -> np.ndarray:
        """Log-probability of every possible 4-gram of a language, looked up once per worker."""
        if slot not in self.tables:
            self.tables[slot] = self.log_prob(slot, np.arange(CLASSES ** ORDER)).astype(np.float32)
        return self.tables[slot]

    def log_prob(self, slot: int, codes: np.ndarray) -> np.ndarray:
        """Log-probability of the last character of each 4-gram given the three before."""
        p = np.full(len(codes), 1.0 / CLASSES)
        for order in range(1, ORDER + 1):
            own = codes & (CLASSES ** order - 1)
            at, found = self._find(slot, order, own)
            context, known = self._find(slot, order - 1, own >> BITS)
            if len(self.keys):
                p = np.where(known, p * self.left[context], p)
                p = np.where(found & ~np.isnan(self.prob[at]), self.prob[at], p)
        return np.log(p)


def _interpolated(codes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each order from 0: n-grams, their interpolated probabilities, and the weight each leaves as a context.

    The highest order uses counts, a lower one the number of characters seen before the n-gram.
    """
    levels = {ORDER: (codes, counts)}
    for order in range(ORDER - 1, 0, -1):
        shorter, times = np.unique(levels[order + 1][0] & (CLASSES ** order - 1), return_counts=True)
        levels[order] = (shorter, times.astype(np.float64))
    none = np.zeros(0, np.int64)
    lower, left = {0: (np.zeros(1, np.int64), np.full(1, 1.0 / CLASSES))}, {ORDER: (none, np.zeros(0))}
    for order in range(1, ORDER + 1):
        grams_, n = levels[order]
        discount = discounts(n)
        heads, group = np.unique(grams_ >> BITS, return_inverse=True)
        total = np.bincount(group, n)
        left[order - 1] = heads, np.bincount(group, discount) / total
        shorter, p = lower[order - 1]
        p = p[np.searchsorted(shorter, grams_ & (CLASSES ** (order - 1) - 1))]
        lower[order] = grams_, (n - discount) / total[group] + left[order - 1][1][group] * p
    for order in range(ORDER + 1):
        (grams_, p), (heads, weight) = lower[order], left[order]
        # an n-gram that was only seen first in a text is a context, but has no probability of its own
        every = np.union1d(grams_, heads)
        prob, leaves = np.full(len(every), np.nan), np.ones(len(every))
        prob[np.searchsorted(every, grams_)] = p
        leaves[np.searchsorted(every, heads)] = weight
        yield order, every, prob, leaves


def discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of n-grams seen ``n`` times, from the counts of counts."""
    few = [float((n == k).sum()) for k in (1, 2, 3, 4)]
    y = few[0] / (few[0] + 2 * few[1]) if few[0] else 0.5
    take = [min(max(k - (k + 1) * y * few[k] / few[k - 1], 0.0), k) if few[k - 1] else y for k in (1, 2, 3)]
    return np.minimum(np.select([n == 1, n == 2], take[:2], take[2]), n)


def base_rules(data: np.ndarray, offsets: np.ndarray, scan: WordScan) -> dict[str, np.ndarray]:
    """Counts of each row for the base rules."""
    rows = len(offsets) - 1
    letters = np.concatenate([[0], np.cumsum(((data & 0xC0) != 0x80) & ~SPACE[data])])[offsets]
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS.encode())] = True
    marks = np.concatenate([[0], np.cumsum(symbol[data])])[offsets]
    at, key = scan.windows(3)
    key = mix(key ^ (scan.row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    by = np.argsort(key, kind="stable")
    same = key[by][1:] == key[by][:-1]
    again = np.zeros(len(key), bool)
    again[by[1:][same]] = True
    again[by[:-1][same]] = True
    covered = np.zeros(len(scan.hash) + 2, bool)
    for k in range(3):
        covered[at[again] + k] = True
    text = data.tobytes()
    duplicate = np.zeros(rows, np.int64)
    for r, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
        lines = [x for x in text[a:b].split(b"\n") if x and not x.isspace()]
        duplicate[r] = len(lines) - len(set(lines))
    return {"n_words": np.diff(scan.first), "word_chars": np.diff(letters), "n_symbols": np.diff(marks), "n_dup_lines": duplicate,
            "n_repeat_words": np.bincount(scan.row[covered[: len(scan.hash)]], minlength=rows)}


STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double, char_score double"
STATS_NAMES = [column.split()[0] for column in STATS.split(", ")]


def scored(docs: DataFrame, model: KneserNey, keep: list[str], most: int | None = None) -> DataFrame:
    """``row`` (a struct of the columns ``keep``), the language, the counts of the base rules and both scores.

    ``model`` is that of the classes; ``most``: 4-grams of a character model that is sent to tasks; a larger one is joined.
    """
    spark = docs.sparkSession
    text, lang = F.col("text").cast("string"), F.col("lang").cast("string")
    text_key = F.xxhash64(F.coalesce(text, F.lit("")), text.isNull(), F.coalesce(lang, F.lit("")), lang.isNull())
    sent = spark.sparkContext.broadcast(model)
    chars = char_model.model(docs)
    chars_sent = char_model.sent(chars, most)
    rows = docs.select(text.alias("text"), lang.alias("lang"), text_key.alias("text_key"), F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"))

    def of_slice(text: pa.Array, language: pa.Array) -> list[pa.Array]:
        data, offsets = utf8(text)
        counts = base_rules(data, offsets, WordScan(data, offsets))
        code, row = grams(data, offsets)
        slot_of = slots(language.to_pylist())
        value = np.zeros(len(code))
        for s in np.unique(slot_of).tolist():
            mine = slot_of[row] == s
            value[mine] = sent.value.table(s)[code[mine]]
        size = np.bincount(row, minlength=len(text))
        total = np.bincount(row, value, minlength=len(text))
        score = pa.array(-total / np.maximum(size, 1), mask=size == 0)
        if chars_sent is None:
            char_score = pa.nulls(len(text), pa.float64())
        else:
            char_score = char_model.means(char_model.Grams(text, language), chars_sent.value, len(text))
        return [*(pa.array(c.astype(np.int64)) for c in counts.values()), score, char_score]

    @F.arrow_udf(returnType=STATS)
    def stats_of(text: pa.Array, language: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text, language], ["text", "lang"])
        parts = [of_slice(*part.columns) for part in slices_by_bytes([batch], 0, char_model.SLICE)] or [of_slice(text, language)]
        return pa.StructArray.from_arrays([pa.concat_arrays(column) for column in zip(*parts)], STATS_NAMES)

    batches_of(spark)
    # only text and language go through Python; the row waits for them in Spark
    stats = (rows.select("row", "lang", "text_key", stats_of("text", "lang").alias("stats"))
             .select("row", "lang", "text_key", "stats.*"))
    if chars_sent is None:
        stats = stats.drop("char_score").join(char_model.joined_means(rows, chars), "text_key", "left")
    return stats.drop("text_key")


def base_failed() -> F.Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


#: Quartile distances that a score may lie below and above the median, and the least quartile distance (nats).
BELOW, ABOVE, LEAST = 3.0, 3.0, 0.02


SCORES = ("score", "char_score")


def bands(stats: DataFrame, below: float = BELOW, above: float = ABOVE, least: float = LEAST) -> DataFrame:
    """(of, score_low, score_high, char_score_low, ...): the bands of each language, from its texts that pass the base rules."""
    quartiles = [F.percentile_approx(c, [0.25, 0.5, 0.75], 100_000).alias(c) for c in SCORES]
    rows = stats.filter(~base_failed()).groupBy(F.col("lang").alias("of")).agg(*quartiles)

    def limit(c: str, distances: float) -> F.Column:
        q = F.col(c)
        return F.get(q, 1) + distances * F.greatest(F.get(q, 2) - F.get(q, 0), F.lit(least))

    return rows.select("of", *(limit(c, d).alias(f"{c}_{name}") for c in SCORES for name, d in (("low", -below), ("high", above))))


def judged(stats: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds ``base_failed`` and ``kept``."""
    joined = stats.join(F.broadcast(limits), F.col("lang").eqNullSafe(F.col("of")), "left")
    inside = F.lit(True)
    for c in SCORES:
        inside = inside & F.coalesce(F.col(c).between(F.col(f"{c}_low"), F.col(f"{c}_high")), F.lit(True))
    return (joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & inside)
            .drop(*limits.columns))


def judge(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``row`` (the columns ``keep``), the base counts, both scores, ``base_failed`` and ``kept`` of every row of ``docs``."""
    model = KneserNey(count_grams(docs).toPandas())
    stats = written(scored(docs, model, keep), "quality")
    return judged(stats, bands(stats))

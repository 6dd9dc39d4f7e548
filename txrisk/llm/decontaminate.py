"""Benchmark decontamination by greedy string tiling.

Seeds are runs of ``seed`` words that a document shares with a benchmark item, found by rolling hashes.  For a document
and an item that share seeds, the longest common run of words not yet marked is marked again and again until none of
``seed`` words is left (running Karp-Rabin, greedy string tiling).  The marked share of the item's words is its
coverage: passages that were cut up or put in another order are still covered.

The benchmark is the stated query set.  It is sent to the tasks in blocks of at most about ``block_words`` words, one
pass over the documents for each block, so nothing that is sent grows beyond that.  Documents are never shuffled.

Words are runs of letters and digits in any script, without case for Latin letters.  Defined results: null and empty
texts share nothing, on either side; an item shorter than ``seed`` words must occur whole; repeated documents and
items are compared each on its own; an empty benchmark leaves every document clean; other columns are carried along.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from txrisk.llm.common import WordScan, batches_of, trimmed, utf8

#: Shortest tile, least coverage of an item, and words of the benchmark sent at once.
SEED, COVERAGE, BLOCK_WORDS = 5, 0.5, 2_000_000

#: Every byte that is no ASCII letter or digit and no part of a longer character.
GAPS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def words_of(column: pa.Array) -> WordScan:
    data, offsets = utf8(column)
    after = np.concatenate([[False], data[:-1] == 0xC3]) if len(data) else np.zeros(0, bool)
    capital = after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)  # the Latin-1 capitals
    return WordScan(np.where(capital, data + 0x20, data).astype(np.uint8), offsets, lower=True, gaps=GAPS)


class Seeds:
    """The word runs of a block of benchmark items, by width: sorted hashes, and the item and place of each."""

    def __init__(self, item_ids: list, texts: pa.Array, seed: int):
        scan = words_of(texts)
        self.item_ids, self.sizes = item_ids, np.diff(scan.first)
        self.by_width: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        width_of = np.minimum(self.sizes, seed)
        for width in sorted(set(width_of[width_of > 0].tolist())):
            at, key = scan.windows(width)
            item = scan.row[at]
            mine = width_of[item] == width
            at, key, item = at[mine], key[mine], item[mine]
            by = np.argsort(key, kind="stable")
            self.by_width[width] = key[by], item[by], (at - scan.first[item])[by]

    def shared(self, scan: WordScan) -> Iterator[tuple[int, int, int, list[tuple[int, int]]]]:
        """(row, item, width, [(place in item, place in row)]) for every row and item that share seeds."""
        for width, (keys, items, places) in self.by_width.items():
            at, key = scan.windows(width)
            lo = np.searchsorted(keys, key)
            hit = keys[np.minimum(lo, len(keys) - 1)] == key
            at, lo = at[hit], lo[hit]
            hi = np.searchsorted(keys, key[hit], side="right")
            found: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
            for w, a, b in zip(at.tolist(), lo.tolist(), hi.tolist()):
                row = int(scan.row[w])
                for k in range(a, b):
                    found[row, int(items[k])].append((int(places[k]), w - int(scan.first[row])))
            for (row, item), pairs in found.items():
                yield row, item, width, pairs


def tiles(pairs: list[tuple[int, int]], width: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in item, place in document, words) from the places of shared runs of ``width`` words."""
    pairs = sorted(set(pairs), key=lambda p: (p[1] - p[0], p[0]))
    runs: list[tuple[int, int, int]] = []  # maximal common runs: neighbours on one diagonal
    for i, j in pairs:
        if runs and runs[-1][1] - runs[-1][0] == j - i and i <= runs[-1][0] + runs[-1][2] - width + 1:
            runs[-1] = (runs[-1][0], runs[-1][1], i + width - runs[-1][0])
        else:
            runs.append((i, j, width))
    heap = [(-n, i, j) for i, j, n in runs]
    heapq.heapify(heap)
    item_marked: set[int] = set()
    text_marked: set[int] = set()
    out = []
    while heap:
        n, i, j = heapq.heappop(heap)
        free = [k for k in range(-n) if i + k not in item_marked and j + k not in text_marked]
        if len(free) == -n:
            out.append((i, j, -n))
            item_marked.update(range(i, i - n))
            text_marked.update(range(j, j - n))
            continue
        begin = 0
        for k in range(1, len(free) + 1):  # what is left of the run goes back, in unmarked parts
            if k == len(free) or free[k] != free[k - 1] + 1:
                if k - begin >= width:
                    heapq.heappush(heap, (begin - k, i + free[begin], j + free[begin]))
                begin = k
    return out


def _blocks(benchmark: DataFrame, seed: int, block_words: int, id_column: str, text_column: str) -> Iterator[Seeds]:
    items = benchmark.select(F.col(id_column).cast("long").alias("i"), F.col(text_column).cast("string").alias("t"))
    words = items.agg(F.sum(F.size(F.split(F.coalesce("t", F.lit("")), r"\s+"))).alias("n")).first()["n"] or 0
    blocks = max(1, -(-words // block_words))
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).orderBy("i", "t").toArrow()
        if part.num_rows:
            yield Seeds(part.column(0).to_pylist(), part.column(1).combine_chunks(), seed)


def _matches(scan: WordScan, seeds: Seeds, coverage: float) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, tiles, covered words) of the pairs that reach the coverage."""
    for row, item, width, pairs in seeds.shared(scan):
        found = tiles(pairs, width)
        covered = sum(n for _, _, n in found)
        if covered >= coverage * seeds.sizes[item]:
            yield row, item, len(found), covered


def contaminated(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS,
                 id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, item_id, n_tiles, covered_words, item_words, coverage) of every document and item it gives away."""
    batches_of(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string"))
    schema = "doc_id long, item_id long, n_tiles int, covered_words int, item_words int, coverage double"
    out = docs.sparkSession.createDataFrame([], schema)
    for seeds in _blocks(benchmark, seed, block_words, "item_id", "text"):
        sent = docs.sparkSession.sparkContext.broadcast(seeds)

        def task(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(_matches(words_of(batch.column(1)), sent.value, coverage))
                size = [int(sent.value.sizes[item]) for _, item, _, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([f[0] for f in found], pa.int64())),
                     pa.array([sent.value.item_ids[f[1]] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int32()),
                     pa.array([f[3] for f in found], pa.int32()), pa.array(size, pa.int32()),
                     pa.array([f[3] / n for f, n in zip(found, size)], pa.float64())],
                    ["doc_id", "item_id", "n_tiles", "covered_words", "item_words", "coverage"])

        out = out.unionByName(rows.mapInArrow(trimmed(task), schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS,
          text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that cover no benchmark item, with all their columns."""
    batches_of(docs.sparkSession)
    at, out = docs.columns.index(text_column), docs
    for seeds in _blocks(benchmark, seed, block_words, "item_id", "text"):
        sent = docs.sparkSession.sparkContext.broadcast(seeds)

        def task(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bad = {f[0] for f in _matches(words_of(pc.cast(batch.column(at), pa.string())), sent.value, coverage)}
                yield batch.filter(pa.array([r not in bad for r in range(batch.num_rows)], pa.bool_()))

        out = out.mapInArrow(trimmed(task), docs.schema)
    return out

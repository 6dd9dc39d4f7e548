"""N-gram Jaccard join with multiple global orders: all links of a wanted similarity, as components.

A document's set holds its distinct shingles of ``width`` words (4), and sets are linked from ``percent`` (85) on.  Two sets that are similar enough share a token among the first
``n - ceil(percent n / 100) + 1`` of each, under *every* global order of tokens.  Order 1 deals the work: documents meet under
the tokens of their prefix.  Where they meet, a pair must also share prefix tokens under orders 2 and 3 before its
sets are compared exactly.

The orders need only be the same everywhere.  All are made from how rare a shingle's words are, by a count sketch over
the words of all documents (a table of fixed size): order 1 goes by the rarest word, then by all four; order 2 by all
four, then by the rarest; order 3 by the rarest, then by a hash.  A shingle with a word that occurs once in the whole
corpus stands in no other document: it has its place in the prefix, but nobody is met there.  Nor is anybody met under
a prefix token that stands in one document only; such tokens are found by sorted runs of their hashes, three bytes or so
a token, and only the others are shuffled with their documents.  Passages that many documents share come last.

No pairs are emitted.  Documents that share a token meet at the list's smallest set key (the pivot), so that lists with
many common members become one.  A task compares a block of a list, with its pivot, by matrix products, and
returns a spanning forest.  The sets travel as compressed texts, which are smaller than their shingles, and are made anew where they
are compared.  Only if a list has more than one block, blocks of documents outside the list's largest
component are then compared with all other blocks; pairs inside that component need no comparison.  Equal sets are one
node throughout.  A hot list is thus cut into bounded tasks, and true copies cost time in proportion to their number.

Defined results: null and empty texts, and texts without words, have empty sets and are linked with nothing, not even
each other; a text with fewer than ``width`` words has its whole word sequence as one shingle; repeated rows share a node; null
ids keep their row and never name a component; an empty table gives no rows; other columns are not read.  Tokens and set
keys are 64-bit hashes of whole texts; a link would be wrong only by a collision of those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from txrisk.llm.common import WordScan, batches_of, bit_filter, in_filter, mix, slices_by_bytes, trimmed, utf8, written
from txrisk.llm.components import components

#: Words of a shingle and least similarity in percent, if the caller gives none.
WIDTH, PERCENT = 4, 85

#: Rows in one Arrow batch, of documents and of sets.
SET_ROWS = 256

#: Places of the word sketch, documents of a list in one block.
SKETCH_BITS, BLOCK = 24, 256
SLICES = 64

#: Prefix tokens sorted at once by a task, and about as many in one slice of all; bytes of text made into sets at once.
RUN, SLICE_TOKENS, TEXT_BYTES = 1 << 20, 1 << 21, 1 << 18

GOLD = np.uint64(0x9E3779B97F4A7C15)


class Shingles:
    """The distinct shingles of every row of a column, by row, then hash; ``levels``: how frequent each sketch place is."""

    def __init__(self, column: pa.Array, levels: np.ndarray, width: int, percent: int):
        data, offsets = utf8(column)
        scan = WordScan(data, offsets, lower=True)
        words = np.diff(scan.first)
        level = levels[scan.hash >> np.uint64(64 - SKETCH_BITS)].astype(np.uint64)
        parts = []
        for size in range(1, width + 1):
            at, key = scan.windows(size)
            if size < width:
                short = words[scan.row[at]] == size
                at, key = at[short], key[short]
            total, least = level[at], level[at]
            for k in range(1, size):
                total = total + level[at + k]
                least = np.minimum(least, level[at + k])
            parts.append((scan.row[at], key, np.minimum(total, np.uint64(255)), least))
        row, key, total, least = (np.concatenate(x) for x in zip(*parts))
        by = np.lexsort((key, row))
        row, key = row[by], key[by]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
        self.row, self.key, self.total, self.least = row[new], key[new], total[by][new], least[by][new]
        self.first = np.searchsorted(self.row, np.arange(len(offsets)))
        self.n, self.percent = np.diff(self.first), percent

    def set_keys(self) -> np.ndarray:
        """A hash of each row's set."""
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(self.key ^ GOLD), dtype=np.uint64)])
        return mix(sums[self.first[1:]] - sums[self.first[:-1]] + self.n.astype(np.uint64) * GOLD).astype(np.int64)

    def prefix(self, order: int) -> np.ndarray:
        """Which shingles stand in their row's prefix under an order."""
        high, low = ((self.least, self.total), (self.total, self.least), (self.least, np.uint64(0)))[order]
        salted = self.key if order == 0 else mix(self.key + np.uint64(order * int(GOLD) % (1 << 64)))
        rank = (high << np.uint64(56)) | (low << np.uint64(48)) | (salted >> np.uint64(16))
        by = np.lexsort((rank, self.row))
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        length = self.n - (self.percent * self.n + 99) // 100 + 1
        return place - self.first[self.row] < length[self.row]


def sketch(docs: DataFrame) -> np.ndarray:
    """Level of every place of the word sketch: 0 if its words occur once in all, 1 twice, and so on; above 16 by halves of
    powers of two.  At most 63."""
    part = (1 << SKETCH_BITS) // SLICES

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in slices_by_bytes(batches, 0, TEXT_BYTES):
            data, offsets = utf8(batch.column(0))
            at, n = np.unique(WordScan(data, offsets, lower=True).hash >> np.uint64(64 - SKETCH_BITS), return_counts=True)
            counts[at] += n.astype(np.uint32)
        places, sums = [], []
        for slice_ in np.split(counts, SLICES):
            at = np.flatnonzero(slice_)
            places.append(np.diff(at, prepend=0).astype("<u4").tobytes())
            sums.append(slice_[at].astype("<u4").tobytes())
        packed = [pa.array([pa.compress(x, "zstd", asbytes=True) for x in col], pa.binary()) for col in (places, sums)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([len(x) for x in sums], pa.int64()), *packed],
                                         ["part", "size", "places", "sums"])

    def merge(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(part, np.int64)
        for table in tables:
            for size, places, sums in zip(*(table.column(c).to_pylist() for c in ("size", "places", "sums"))):
                at = np.cumsum(np.frombuffer(pa.decompress(places, size, "zstd"), "<u4").astype(np.int64))
                total[at] += np.frombuffer(pa.decompress(sums, size, "zstd"), "<u4")
        few = np.maximum(total - 1, 0)
        level = np.where(few < 16, few, np.minimum(8 + 2 * np.log2(np.maximum(few, 1)), 63)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["part", "levels"])

    parts = (docs.mapInArrow(trimmed(task), "part int, size long, places binary, sums binary").groupBy("part")
             .applyInArrow(merge, "part int, levels binary").collect())
    out = np.zeros((SLICES, part), np.uint8)
    for row in parts:
        out[row["part"]] = np.frombuffer(row["levels"], np.uint8)
    return out.ravel()


def _keyed(docs: DataFrame, levels, width: int, percent: int) -> DataFrame:
    """(doc_id, mark, n, node, prefix): size, set key and order-1 prefix tokens of every document, but for tokens with a word that
    occurs once in all."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, 0, TEXT_BYTES):
            sets = Shingles(batch.column(0), levels.value, width, percent)
            chosen = sets.prefix(0) & (sets.least > 0)
            ends = np.concatenate([[0], np.cumsum(chosen)])[sets.first]
            prefix = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sets.key[chosen].astype(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(sets.n), pa.array(sets.set_keys()), prefix],
                                             ["doc_id", "mark", "n", "node", "prefix"])

    return docs.mapInArrow(trimmed(task), "doc_id long, mark long, n long, node long, prefix array<long>")


def _meeting(keyed: DataFrame) -> DataFrame:
    """(node, n, token): the prefix tokens that stand in two rows at least, and a few others.

    Tokens are counted by their top bits, as sorted runs of differences in slices; those found twice make a bit filter.
    """
    tokens = keyed.agg(F.sum(F.size("prefix"))).first()[0] or 0
    slices = 1 << max(4, (tokens // SLICE_TOKENS).bit_length())
    shift = np.uint64(32 - (slices.bit_length() - 1))

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        value = np.sort(np.concatenate(held)) >> shift
        more = np.ones(len(value), bool)
        more[2:] = value[2:] != value[:-2]  # two of a kind tell as much as many
        value = value[more]
        ends = np.searchsorted(value, np.arange(slices + 1, dtype=np.uint64) << np.uint64(32))
        runs = [(k, b - a, pa.compress(np.diff(value[a:b].astype("<u4"), prepend=np.uint32(0)).tobytes(), "zstd", asbytes=True))
                for k, (a, b) in enumerate(zip(ends.tolist(), ends[1:].tolist())) if a < b]
        kinds = (pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*runs), kinds)], ["slice", "size", "run"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).flatten().to_numpy().view(np.uint64))
            if sum(map(len, held)) >= RUN:
                yield packed(held)
                held = []
        if any(map(len, held)):
            yield packed(held)

    def merge(key: tuple, runs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = np.sort(np.concatenate([np.cumsum(np.frombuffer(pa.decompress(run, 4 * size, "zstd"), "<u4"), dtype=np.uint32)
                                        for table in runs for size, run in zip(*(table.column(c).to_pylist() for c in ("size", "run")))]))
        twice = np.unique(value[1:][value[1:] == value[:-1]]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(twice + (key[0].as_py() << 32))], ["value"])

    found = written(keyed.select("prefix").mapInArrow(trimmed(task), "slice int, size long, run binary").groupBy("slice")
                    .applyInArrow(merge, "value long"), "repeated")
    wanted = keyed.sparkSession.sparkContext.broadcast(bit_filter(found, "value", found.count()))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            token = batch.column(2).flatten().to_numpy()
            of = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column(2)).to_numpy())
            at = np.flatnonzero(in_filter(wanted.value, (token.view(np.uint64) >> shift).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of[at])), batch.column(1).take(pa.array(of[at])), pa.array(token[at])],
                                             ["node", "n", "token"])

    return keyed.filter("n > 0").select("node", "n", "prefix").mapInArrow(trimmed(rows), "node long, n long, token long")


def _texts(docs: DataFrame, levels, wanted, width: int, percent: int) -> DataFrame:
    """(node, size, packed): the texts of representatives in the filter, compressed."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, 0, TEXT_BYTES):
            rows = np.flatnonzero(in_filter(wanted.value, batch.column(2).to_numpy()))
            texts = batch.column(0).take(pa.array(rows)).cast(pa.large_binary())
            sets = Shingles(texts, levels.value, width, percent)
            some = pa.array(sets.n > 0)
            raw = texts.filter(some).to_pylist()
            packed = [pa.compress(x, "zstd", asbytes=True) for x in raw]
            yield pa.RecordBatch.from_arrays([pa.array(sets.set_keys()).filter(some), pa.array([len(x) for x in raw], pa.int64()),
                                              pa.array(packed, pa.binary())], ["node", "size", "packed"])

    return docs.mapInArrow(trimmed(task), "node long, size long, packed binary")


def linked(keys: list[np.ndarray], flags: list[np.ndarray], cross: np.ndarray | None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets; ``cross`` says which side each is on, to compare only across."""
    d = len(keys)
    n = np.array([len(k) for k in keys])
    row = np.repeat(np.arange(d), n)
    token, flag = np.concatenate(keys), np.concatenate(flags)
    by = np.argsort(token, kind="stable")
    token, row, flag = token[by], row[by], flag[by]
    new = np.concatenate([[True], token[1:] != token[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column) > 1
    inside = shared[column]
    row, flag = row[inside], flag[inside]
    column = (np.cumsum(shared) - 1)[column[inside]]
    width = int(shared.sum())
    large, small = np.maximum(n[:, None], n), np.minimum(n[:, None], n)
    may = np.triu(100 * small >= percent * large, 1)
    if cross is not None:
        may &= cross[:, None] != cross

    def common(mask: np.ndarray) -> np.ndarray:
        out = np.zeros((d, d), np.float32)
        r, c = row[mask], column[mask]
        order = np.argsort(c, kind="stable")
        r, c = r[order], c[order]
        for a in range(0, width, 8192):
            lo, hi = np.searchsorted(c, (a, a + 8192))
            if hi > lo:
                x = np.zeros((d, min(8192, width - a)), np.float32)
                x[r[lo:hi], c[lo:hi] - a] = 1
                out += x @ x.T
        return out

    for order in range(3):  # the pair shares a prefix token under every order
        if not may.any():
            return []
        may &= common((flag >> order) & 1 == 1) > 0
    if not may.any():
        return []
    both = common(np.ones(len(row), bool)).astype(np.int64)
    link = may & (100 * both >= percent * (n[:, None] + n - both))
    parent = list(range(d))

    def root(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    out = []
    for a, b in np.argwhere(link).tolist():
        x, y = root(a), root(b)
        if x != y:
            parent[y] = x
            out.append((a, b))
    return out


def _unpacked(batch: pa.RecordBatch, levels: np.ndarray, width: int, percent: int) -> Iterator[dict]:
    """The rows with their set's shingles (``keys``) and each shingle's prefixes as bits (``flags``)."""
    rows = batch.to_pylist()
    ends, at = np.cumsum([r["size"] for r in rows]), 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TEXT_BYTES, "right")))
        texts = [pa.decompress(r["packed"], r["size"], "zstd", asbytes=True) for r in rows[at:to]]
        sets = Shingles(pa.array(texts, pa.large_binary()), levels, width, percent)
        flags = np.zeros(len(sets.key), np.uint8)
        for order in range(3):
            flags |= sets.prefix(order).astype(np.uint8) << order
        for r, a, b in zip(rows[at:to], sets.first, sets.first[1:]):
            yield {"pivot": r["pivot"], "tile": r["tile"], "side": r["side"], "node": r["node"], "keys": sets.key[a:b].copy(), "flags": flags[a:b].copy()}
        at = to


def _verified(rows: DataFrame, across: bool, levels, width: int, percent: int) -> DataFrame:
    """Links (a, b) inside every group ``pivot, tile`` of rows (pivot, tile, side, node, size, packed)."""

    def group(held: list[dict]) -> list[tuple[int, int]]:
        held = list({r["node"]: r for r in held}.values())
        if len(held) < 2:
            return []
        side = np.array([r["side"] for r in held]) if across and len({r["side"] for r in held}) > 1 else None
        return [(held[a]["node"], held[b]["node"]) for a, b in linked([r["keys"] for r in held], [r["flags"] for r in held], side, percent)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            out: list[tuple[int, int]] = []
            for r in _unpacked(batch, levels.value, width, percent):
                if held and (held[0]["pivot"], held[0]["tile"]) != (r["pivot"], r["tile"]):
                    out += group(held)
                    held = []
                held.append(r)
            yield _links(out)
        yield _links(group(held))

    spread = rows.repartition("pivot", "tile").sortWithinPartitions("pivot", "tile")
    return spread.mapInArrow(trimmed(task), "a long, b long").distinct()


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])


def _tiles(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(pivot, node, tile, side) for lists of several blocks: the blocks outside the largest component against all others."""
    big = (members.filter(F.col("m") > BLOCK).join(labels, "node", "left")
           .withColumn("component", F.coalesce("component", "node")))
    sizes = big.groupBy("pivot", "component").agg(F.count(F.lit(1)).alias("g"))
    largest = sizes.groupBy("pivot").agg(F.max_by(F.struct("component", "g"), F.struct("g", "component")).alias("top"), F.sum("g").alias("all"))
    laid = (big.join(largest, "pivot")
            .withColumn("inner", F.col("component") == F.col("top.component"))
            .withColumn("rests", F.ceil((F.col("all") - F.col("top.g")) / BLOCK).cast("int"))
            .withColumn("inners", F.ceil(F.col("top.g") / BLOCK).cast("int"))
            .filter(F.col("rests") > 0)
            .withColumn("block", F.pmod(F.xxhash64("node"), F.when(F.col("inner"), F.col("inners")).otherwise(F.col("rests"))).cast("int")))

    def name(kind: str, a, b):
        return F.concat_ws(":", F.lit(kind), a, b)

    rests, inners = F.sequence(F.lit(0), F.col("rests") - 1), F.sequence(F.lit(0), F.col("inners") - 1)
    own = F.col("block")
    rest = F.concat(F.transform(rests, lambda j: F.struct(name("rr", F.least(own, j), F.greatest(own, j)).alias("tile"), F.lit(0).alias("side"))),
                    F.transform(inners, lambda j: F.struct(name("ri", own, j).alias("tile"), F.lit(0).alias("side"))))
    inner = F.transform(rests, lambda i: F.struct(name("ri", i, own).alias("tile"), F.lit(1).alias("side")))
    return laid.select("pivot", "node", F.inline(F.when(F.col("inner"), inner).otherwise(rest)))


def join(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document, by shingles of ``width`` words at ``percent`` similarity."""
    spark = docs.sparkSession
    batches_of(spark, SET_ROWS)
    docs = docs.select(F.col(text_column).cast("string").alias("text"), F.col(id_column).cast("long").alias("doc_id"))
    docs = docs.withColumn("mark", F.xxhash64("text", "doc_id"))
    levels = spark.sparkContext.broadcast(sketch(docs.select("text")))
    keyed = written(_keyed(docs, levels, width, percent), "sets")
    nodes = keyed.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("rep"), F.min("mark").alias("mark"))

    # in a token's list, by size: a step beyond the similarity parts documents that cannot be linked across it
    by_size = Window.partitionBy("token").orderBy("n")
    step = (100 * F.lag("n").over(by_size) < percent * F.col("n")).cast("int")
    island = Window.partitionBy("token", "island")
    meet = (_meeting(keyed)
            .withColumn("step", F.coalesce(step, F.lit(0)))
            .withColumn("island", F.sum("step").over(by_size.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("pivot", F.min("node").over(island)).withColumn("last", F.max("node").over(island))
            .filter(F.col("pivot") != F.col("last")).select("pivot", "node").distinct())
    members = written(meet.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("pivot"))), "members")

    met = members.select("node").distinct().join(nodes, "node")
    wanted = spark.sparkContext.broadcast(bit_filter(met, "mark", members.count()))
    texts = _texts(docs, levels, wanted, width, percent)

    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    first = members.select("pivot", "node", F.explode(F.when(F.col("node") == F.col("pivot"), F.sequence(F.lit(0), blocks - 1))
                                                      .otherwise(F.array(F.pmod(F.xxhash64("node"), blocks).cast("int")))).alias("block"))
    first = first.select("pivot", "node", F.col("block").cast("string").alias("tile"), F.lit(0).alias("side"))
    links = written(_verified(first.join(texts, "node"), False, levels, width, percent), "links")
    labels = components(links)
    if not members.filter(F.col("m") > BLOCK).isEmpty():
        tiles = written(_tiles(members, labels), "tiles")
        again = tiles.select("node").distinct().join(nodes, "node")
        wanted = spark.sparkContext.broadcast(bit_filter(again, "mark", tiles.count()))
        more = written(_verified(tiles.join(_texts(docs, levels, wanted, width, percent), "node"), True, levels, width, percent), "links")
        labels = components(links.unionByName(more))
    batches_of(spark)

    named = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ids = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_node = named.select("node", "component").join(ids, "component").select("node", "component_id")
    return (keyed.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("node")).alias("node"))
            .join(of_node, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))

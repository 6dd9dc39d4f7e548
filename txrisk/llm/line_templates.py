"""Line deduplication by a log-template tree.

A line's tokens are its words; words with a digit are variable fields.  The tree has a fixed depth: lines with the same
number of tokens and the same three leading tokens share a leaf.  In a leaf, a token stays at its place if at least
``min_docs`` lines have it there and they are at least ``part`` of the leaf; all other places become variable.  Lines
that agree in what stays share a template.  A template recurs if lines of at least ``min_docs`` documents have it and at
least ``share`` of its places stay.  A line under 6 tokens, or one that itself stands in ``min_docs`` documents, is its
own template.  A caller may let exact lines of ``passage`` words and more recur from ``passage_docs`` documents on.
Lines of recurring templates are dropped from all documents but that with the smallest id among the
template's; lines under 3 tokens are left alone.

Spark counts (leaf, line) pairs, as hashes, once for each document; only lines in leaves with enough documents are
looked at token by token, and equal lines are one row there.  Documents are then joined with the numbers of the lines
they lose.  Nothing is gathered by leaf or template, so a hot template is only a hot join key.

Defined results: null text stays null and has no lines; blank lines stay; repeated rows lose the same lines; null ids
never are the document that keeps a line; an empty table gives no rows; all columns of the documents are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txrisk.llm.common import WordScan, batches_of, bit_filter, in_filter, mix, trimmed, utf8, written

#: Leading tokens of a leaf, least tokens of a line that counts, and of one whose places are looked at.
LEADING, LEAST, LONG = 3, 3, 6

#: Documents that make a template recur, part of a leaf that makes a token stay, share of a template that must stay.
MIN_DOCS, PART, SHARE = 10, 0.05, 0.7

GOLD = np.uint64(0x9E3779B97F4A7C15)
FIELD = np.uint64(1)


class Lines:
    """The lines with words of every row: ``row``, ``number``, ``size`` (tokens), ``leaf``, ``key``, and the token hashes."""

    def __init__(self, column: pa.Array):
        data, offsets = utf8(column)
        scan = WordScan(data, offsets)
        feeds = np.concatenate([[0], np.cumsum(data == 10)])
        digits = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
        number = feeds[scan.starts] - feeds[offsets[scan.row]]
        token = scan.hash.copy()
        token[digits[scan.ends] > digits[scan.starts]] = FIELD
        new = np.ones(len(token), bool)
        new[1:] = (scan.row[1:] != scan.row[:-1]) | (number[1:] != number[:-1])
        self.token, self.first = token, np.flatnonzero(new)
        self.size = np.diff(np.append(self.first, len(token)))
        self.row, self.number = scan.row[self.first], number[self.first]
        place = (np.arange(len(token)) - np.repeat(self.first, self.size)).astype(np.uint64)
        sums = np.add.reduceat(mix(token + place * GOLD), self.first) if len(token) else np.zeros(0, np.uint64)
        sizes = self.size.astype(np.uint64)
        self.key = mix(sums ^ sizes).astype(np.int64)
        leaf = mix(sizes)
        for k in range(LEADING):
            leaf = mix(leaf * GOLD + token[np.minimum(self.first + k, len(token) - 1)]) if len(token) else leaf
        self.leaf = np.where(self.size >= LONG, leaf.astype(np.int64), self.key)


def _counted(docs: DataFrame) -> DataFrame:
    """(leaf, key, size, n, first): every line, in how many documents that have an id, and the smallest id of those."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = Lines(batch.column(0))
            by = np.lexsort((lines.key, lines.row))
            row, key = lines.row[by], lines.key[by]
            new = np.ones(len(by), bool)
            new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
            by = by[new & (lines.size[by] >= LEAST)]
            yield pa.RecordBatch.from_arrays([pa.array(lines.leaf[by]), pa.array(lines.key[by]), pa.array(lines.size[by]),
                                              batch.column(1).take(pa.array(lines.row[by]))], ["leaf", "key", "size", "doc_id"])

    lines = lambda some: some.select("text", "doc_id").mapInArrow(trimmed(task), "leaf long, key long, size long, doc_id long")
    named = docs.filter("doc_id IS NOT NULL")
    # an id that comes in several rows is one document: its lines are counted once; all other rows need no comparison
    again = written(named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"), "repeated-ids")
    if again.isEmpty():
        rows = lines(named)
    else:
        rows = lines(named.join(again, "doc_id", "left_anti")).unionByName(lines(named.join(again, "doc_id", "left_semi")).distinct())
    return rows.groupBy("leaf", "key", "size").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))


def _tokens(docs: DataFrame, wanted) -> DataFrame:
    """(key, tokens) of the long lines whose leaf is in the filter, each line once."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = Lines(batch.column(0))
            at = np.flatnonzero((lines.size >= LONG) & in_filter(wanted.value, lines.leaf))
            at = at[np.unique(lines.key[at], return_index=True)[1]]
            ends = np.concatenate([[0], np.cumsum(lines.size[at])])
            within = np.arange(ends[-1]) + np.repeat(lines.first[at] - ends[:-1], lines.size[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(lines.key[at]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(lines.token[within].astype(np.int64)))],
                ["key", "tokens"])

    return docs.select("text").mapInArrow(trimmed(task), "key long, tokens array<long>").dropDuplicates(["key"])


def _recurring(docs: DataFrame, min_docs: int, part: float, share: float, passage: int | None, passage_docs: int) -> DataFrame:
    """(key, first): the lines of recurring templates, and the document that keeps them."""
    spark = docs.sparkSession
    counted = written(_counted(docs), "lines")
    leaves = counted.filter(F.col("size") >= LONG).groupBy("leaf").agg(F.sum("n").alias("total")).filter(F.col("total") >= min_docs)
    hot = written(counted.join(leaves, "leaf").select("leaf", "key", "size", "n", "first", "total"), "hot-lines")
    bits = spark.sparkContext.broadcast(bit_filter(hot.select("leaf").distinct(), "leaf", hot.count()))
    places = written(hot.join(_tokens(docs, bits), "key").select("leaf", "key", "size", "n", "first", "total", F.posexplode("tokens").alias("place", "token")),
                     "places")
    told = F.col("token") != int(FIELD)
    inner = places.filter((F.col("place") >= LEADING) & told)
    stays = (inner.groupBy("leaf", "place", "token").agg(F.sum("n").alias("s"), F.first("total").alias("total"))
             .filter((F.col("s") >= min_docs) & (F.col("s") >= part * F.col("total"))).select("leaf", "place", "token"))
    fixed = (inner.join(stays, ["leaf", "place", "token"])
             .unionByName(places.filter((F.col("place") < LEADING) & told).select(*inner.columns)))
    shaped = (fixed.groupBy("leaf", "key", "size", "n", "first")
              .agg(F.count(F.lit(1)).alias("fixed"), F.bit_xor(F.xxhash64("place", "token")).alias("shape"))
              .filter(F.col("fixed") >= share * F.col("size")).withColumn("template", F.xxhash64("leaf", "shape", "fixed")))
    templates = shaped.groupBy("template").agg(F.sum("n").alias("docs"), F.min("first").alias("keeper")).filter(F.col("docs") >= min_docs)
    by_template = shaped.join(templates, "template").select("key", F.col("keeper").alias("first"))
    often = F.col("n") >= min_docs
    if passage is not None:
        often = often | ((F.col("size") >= passage) & (F.col("n") >= passage_docs))
    by_itself = counted.filter(often).select("key", "first")
    return by_template.unionByName(by_itself).groupBy("key").agg(F.min("first").alias("first"))


def _lost(docs: DataFrame, wanted) -> DataFrame:
    """(row_key, doc_id, number, key) of the lines that may be in the filter."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = Lines(batch.column(0))
            at = np.flatnonzero((lines.size >= LEAST) & in_filter(wanted.value, lines.key))
            rows = pa.array(lines.row[at])
            yield pa.RecordBatch.from_arrays([batch.column(2).take(rows), batch.column(1).take(rows), pa.array(lines.number[at].astype(np.int32)),
                                              pa.array(lines.key[at])], ["row_key", "doc_id", "number", "key"])

    return docs.select("text", "doc_id", "row_key").mapInArrow(trimmed(task), "row_key long, doc_id long, number int, key long")


def dedup(docs: DataFrame, min_docs: int = MIN_DOCS, part: float = PART, share: float = SHARE,
          id_column: str = "doc_id", text_column: str = "text", passage: int | None = None, passage_docs: int = 2) -> DataFrame:
    """(row, text, n_lines, n_dropped): a struct of the document's columns, its text without dropped lines, and counts."""
    spark = docs.sparkSession
    batches_of(spark)
    text, doc_id = F.col(text_column).cast("string"), F.col(id_column).cast("long")
    small = docs.select(text.alias("text"), doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("row_key"))
    recurring = written(_recurring(small, min_docs, part, share, passage, passage_docs), "recurring")
    bits = spark.sparkContext.broadcast(bit_filter(recurring, "key", recurring.count()))
    lost = (_lost(small, bits).join(recurring, "key").filter(~F.col("doc_id").eqNullSafe(F.col("first")))
            .groupBy("row_key").agg(F.collect_set("number").alias("dropped")))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), text.alias("text"),
                        F.xxhash64(doc_id, text).alias("row_key"))
    joined = whole.join(lost, "row_key", "left").withColumn("lines", F.split("text", "\n"))
    kept = F.filter("lines", lambda line, i: ~F.array_contains("dropped", i))
    return joined.select("row", F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
                         F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
                         F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"))

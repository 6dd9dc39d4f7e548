"""Token counts from flat, unindexed token files, by a separator scan.

A token file holds ids of one fixed width and nothing else; a document ends with the end-of-document id.  Files are
cut into blocks of equal size that tasks range-read and search with numpy, so neither a long file nor a long document
needs one task.  A block knows only its own separators; where its first document began and which number it has follow
from a prefix scan over the blocks before it in the same file (counts and last places only).

Defined results: an empty file has no documents; tokens after the last separator are one document more with
``terminated`` false; a separator right after another is a document of 0 tokens.  The writer takes null text as empty,
keeps repeated rows and null ids, and reads no other columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from txrisk.llm import word_bpe
from txrisk.llm.common import batches_of, open_fs, scratch, spread, write_file, written


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int, dtype: str = "<u2",
                      id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Tokenise ``docs`` into one flat file per partition below ``spark.checkpoint.dir``.

    Returns (path, ordinal, doc_id): which document stands at which place of which file.  Only files of tasks that
    ended well are named, so a task that runs again leaves nothing behind that is read.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "tokens")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, ids_of = word_bpe.load(vocabulary, special_as_text=True), []
        path = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"
        end = np.array([end_id], "<u4")

        def data() -> Iterator[bytes]:
            for chunk in word_bpe.chunks(batches, 1):
                ids, begins = bpe.encode(word_bpe.single(chunk.column(1)))
                ids_of.append(chunk.column(0).combine_chunks())
                yield np.insert(np.frombuffer(ids, "<u4"), begins[1:], end[0]).astype(dtype).tobytes()

        write_file(path, data())
        ordinal = 0
        for part in ids_of:
            part = part.combine_chunks() if isinstance(part, pa.ChunkedArray) else part
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(part)), pa.array(np.arange(ordinal, ordinal + len(part))), part], ["path", "ordinal", "doc_id"])
            ordinal += len(part)

    batches_of(spark)
    rows = docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string"))
    return written(rows.mapInArrow(task, "path string, ordinal long, doc_id long"), "token-docs")


def searched_blocks(files: DataFrame, end_id: int, dtype: str = "<u2", block_tokens: int = 1 << 20) -> DataFrame:
    """(path, block, begin, size, ends): the blocks of the files and the places of their separators."""
    width = np.dtype(dtype).itemsize

    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path in frame["path"]:
                store, place = open_fs(path)
                tokens = store.get_file_info(place).size // width
                at = np.arange(0, tokens, block_tokens)
                yield pd.DataFrame({"path": path, "block": at // block_tokens, "begin": at, "size": np.minimum(block_tokens, tokens - at)})

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, block, begin, size in frame.itertuples(index=False):
                store, place = open_fs(path)
                with store.open_input_file(place) as file:
                    tokens = np.frombuffer(file.read_at(size * width, begin * width), dtype)
                yield pd.DataFrame({"path": [path], "block": [block], "begin": [begin], "size": [size],
                                    "ends": [begin + np.flatnonzero(tokens == end_id)]})

    cut = written(files.select("path").distinct().mapInPandas(blocks, "path string, block long, begin long, size long"), "token-cuts")
    return (cut.repartition(spread(files.sparkSession, cut.count()), "path", "block")
            .mapInPandas(search, "path string, block long, begin long, size long, ends array<long>"))


def separator_scan(files: DataFrame, end_id: int, dtype: str = "<u2", block_tokens: int = 1 << 20) -> DataFrame:
    """(path, ordinal, start, n_tokens, terminated) of every document in the files named in column ``path``."""
    found = written(searched_blocks(files, end_id, dtype, block_tokens), "token-blocks")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    stitched = (found.withColumn("last_end", F.try_element_at("ends", F.lit(-1)))
                .withColumn("ordinal0", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)))
                .withColumn("start0", F.coalesce(F.max("last_end").over(before) + 1, F.lit(0)))
                .withColumn("file_end", F.max(F.col("begin") + F.col("size")).over(whole))
                .withColumn("file_last", F.coalesce(F.max("last_end").over(whole), F.lit(-1)))
                .withColumn("file_docs", F.sum(F.size("ends")).over(whole)))
    ended = (stitched.select("path", "ordinal0", "start0", "ends", F.posexplode("ends").alias("i", "end"))
             .withColumn("start", F.when(F.col("i") == 0, F.col("start0")).otherwise(F.try_element_at("ends", F.greatest("i", F.lit(1))) + 1))
             .select("path", (F.col("ordinal0") + F.col("i")).alias("ordinal"), "start", (F.col("end") - F.col("start")).alias("n_tokens"),
                     F.lit(True).alias("terminated")))
    open_end = (stitched.filter((F.col("block") == 0) & (F.col("file_last") + 1 < F.col("file_end")))
                .select("path", F.col("file_docs").alias("ordinal"), (F.col("file_last") + 1).alias("start"),
                        (F.col("file_end") - F.col("file_last") - 1).alias("n_tokens"), F.lit(False).alias("terminated")))
    return ended.unionByName(open_end)


def document_token_counts(docs: DataFrame, vocabulary: str, end_id: int, dtype: str = "<u2") -> DataFrame:
    """(doc_id, n_tokens): the documents written to token files, counted by scanning the files."""
    written_docs = write_token_files(docs, vocabulary, end_id, dtype)
    counts = separator_scan(written_docs.select("path"), end_id, dtype)
    return written_docs.join(counts, ["path", "ordinal"], "left").select("doc_id", F.col("n_tokens"))

"""Corpus pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

Every stage works on all rows that the one before kept and returns the columns of its input, the last excepted.
Rows without an id are kept by every stage that goes by ids, unless they are linked to a row that has one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from txrisk.llm import decontaminate, line_templates, ngram_join, packing, quality
from txrisk.llm.common import scratch, table
from txrisk.llm.queries import VOCABULARY

#: Words of a line that recurs from two documents on.
PASSAGE = 50

#: Words of a shingle and least similarity in percent of the near-duplicate stage.
WIDTH, PERCENT = 5, 80

#: Keys of rows without an id begin here; ids are below.
NO_ID = 1 << 61


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie inside their language's perplexity bands."""
    return quality.judge(docs, docs.columns).filter("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of recurring templates, each of which stays in one document; texts left blank go.

    A line of ``PASSAGE`` words recurs from two documents on; a token stays by documents alone, not by its part of the leaf.
    """
    found = line_templates.dedup(docs, part=0.0, passage=PASSAGE).filter((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("n_dropped") == 0, F.col("row.n_chars")).otherwise(F.length("text"))}
    return found.select(*(changed[c].cast(docs.schema[c].dataType).alias(c) if c in changed else F.col(f"row.`{c}`").alias(c)
                          for c in docs.columns))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (5-word shingles at 0.8), that with the smallest id; of repeated rows one stays.

    Rows without an id go by a key of their text above all ids, so they stay only in groups that have no id; those without
    words, which are linked with nothing, all stay.
    """
    text, doc_id = F.col("text").cast("string"), F.col("doc_id").cast("long")
    key = F.coalesce(doc_id, F.lit(NO_ID) + F.pmod(F.xxhash64(text), F.lit(NO_ID)))
    alone = doc_id.isNull() & ~F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(whole.alias("row"), key.alias("key"), text.alias("text"), alone.alias("alone"))
    groups = ngram_join.join(rows.filter("NOT alone"), "key", "text", WIDTH, PERCENT)
    keep = (groups.filter(F.col("doc_id") == F.col("component_id")).groupBy("doc_id")
            .agg(F.count(F.lit(1)).alias("n")).select(F.col("doc_id").alias("kept_id"), "n"))
    kept = rows.filter("NOT alone").join(keep, F.col("key") == F.col("kept_id"))
    single, repeated = kept.filter("n = 1"), kept.filter("n > 1").dropDuplicates(["key", "text"])
    return single.select("row.*").unionByName(repeated.select("row.*")).unionByName(rows.filter("alone").select("row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that give away no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise what is left and pack it into 4096-token sequences: one row per piece."""
    return packing.pack(packing.tokenised_pieces(docs, VOCABULARY))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Word-piece ids and language-model scores are beyond SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

import hashlib
import re

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.helpers import documents, frame
from txrisk.llm import fill_in_middle
from txrisk.llm.queries import op12_fill_in_middle


def brute(doc_id, text):
    """n, form, prefix, middle and output of one document, by the contract's words."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k: 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def odd():
    texts = ["<P>", "a<S>b", "<M", "<", "<<S", "P><P", "x\x01y\x02z", "\x01\x02\x03\x1f", "\n\n", "\r\n\t ", "é́\U0001F600a",
             "<p>a</p>" * 50, "S>M><P", "﻿abc", "a" * 100_000, "1" * 100_000, "<" * 9, " x\x85", "ß" * 7]
    return [(5000 + 40 * i + k, t, "en") for i, t in enumerate(texts) for k in range(12)]


def test_equals_brute_force(spark):
    rows = documents() + odd()
    got = fill_in_middle.transform(frame(spark, rows).repartition(3)).withColumn(
        "again", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.again) for r in got), key=key) == sorted(
        ((i, *brute(i, t), t or "") for i, t, _ in rows), key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_other_seeds_cut_elsewhere(spark):
    rows = documents()
    one, two = ([r.output for r in fill_in_middle.transform(frame(spark, rows), seed).orderBy("doc_id", "output").collect()] for seed in (1, 2))
    assert one != two


def test_empty_table(spark):
    assert fill_in_middle.transform(frame(spark, [])).count() == 0


def test_query_restores_every_text(spark):
    got = op12_fill_in_middle(spark, SF_SMALL)
    docs = spark.read.parquet(f"{"/root/testdata/sf0.001"}/documents.parquet").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    both = got.join(docs, "doc_id", "full")
    assert both.filter("NOT (restored_sha256 <=> sha)").count() == 0
    assert got.filter("form <> 'plain' AND output_sha256 = restored_sha256").count() == 0

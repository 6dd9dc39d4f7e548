import random

import corpus_pipeline as p
from tests.conftest import SF_SMALL
from tests.llm.helpers import documents, frame, words
from txrisk.llm import line_templates, ngram_join


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = frame(spark, documents())
    columns = docs.columns
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes], name
    assert p.quality_rules(spark, docs, SF_SMALL).filter("size(split(text, ' ')) < 5").count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = frame(spark, documents())
    kept = p.ngram_jaccard(spark, docs, SF_SMALL).collect()
    groups = {r.component_id for r in ngram_join.join(docs, width=p.WIDTH, percent=p.PERCENT).collect()}
    ids = [r.doc_id for r in kept]
    assert len(ids) == len(set(ids)) and set(ids) == groups


def test_blanked_documents_go(spark):
    rows = [(i, "This very line stands in all documents of it\nand so does this other one here too", "en") for i in range(12)]
    out = p.line_dedup(spark, frame(spark, rows), SF_SMALL).collect()
    assert [(r.doc_id, r.text) for r in out] == [(0, rows[0][1])]


def test_run_on_the_tables(spark):
    got = p.run(spark, SF_SMALL).collect()
    docs = {r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert got and {r.doc_id for r in got} <= docs
    fill = {}
    for r in got:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 4096


def test_run_on_an_empty_table(spark):
    docs = frame(spark, [])
    for _, stage in p.STAGES:
        docs_out = stage(spark, docs, SF_SMALL)
        assert docs_out.count() == 0


def test_near_copies_are_linked_by_five_words_at_four_fifths(spark):
    base = [f"word{k}" for k in range(1000)]
    copy = ["edited" if k % 45 == 20 else w for k, w in enumerate(base)]
    docs = frame(spark, [(1, " ".join(base), "en"), (2, " ".join(copy), "en")])
    assert [r.doc_id for r in p.ngram_jaccard(spark, docs, SF_SMALL).collect()] == [1]


def test_long_lines_recur_from_two_documents_on(spark):
    r = random.Random(3)
    passage, short = words(r, 60), words(r, 40)
    rows = [(i, f"{words(r, 20)}\n{passage}\n{short}", "en") for i in range(2)]
    out = {x.doc_id: x.text for x in p.line_dedup(spark, frame(spark, rows), SF_SMALL).collect()}
    assert out[0] == rows[0][1] and out[1] == rows[1][1].replace(passage + "\n", "")


def test_templates_under_a_twentieth_of_their_leaf_recur(spark):
    r = random.Random(5)
    lines = [f"one two three {words(r, 1)} {words(r, 1)} {words(r, 1)}{k} end{k % 30}" for k in range(400)]  # one leaf, no other template
    rows = [(i, line, "en") for i, line in enumerate(lines)]
    rows += [(1000 + i, f"one two three open session {'abcdefghijkl'[i]}x closed\n{words(r, 20)}", "en") for i in range(12)]
    docs = frame(spark, rows)
    assert line_templates.dedup(docs).filter("row.doc_id >= 1000 AND n_dropped > 0").count() == 0
    out = {x.doc_id: x.text for x in p.line_dedup(spark, docs, SF_SMALL).collect()}
    assert ["open session" in out[1000 + i] for i in range(12)] == [True] + [False] * 11

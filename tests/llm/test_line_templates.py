import random

import duckdb
import pytest

from tests.conftest import SF_MID
from tests.llm.helpers import documents, frame, words
from txrisk.llm import line_templates
from txrisk.llm.queries import ORACLE


def logs():
    r = random.Random(8)
    rows = []
    for k in range(40):
        own = words(r, 15)
        rows.append((800 + k, f"{own}\nSession opened for user {words(r, 1)} from host 10.0.{k}.7\n\nAll rights reserved.\nEnd", "en"))
    return rows


def expected(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, t, _ in rows])
    return con.sql(ORACLE["op3_line_templates"]).fetchall()


def test_templates_equal_sql(spark):
    rows = [x for x in documents() if x[0] is not None] + logs()
    rows += rows[-9:] + [(i, t + "\nsame line in few documents", "en") for i, t, _ in logs()[:5] for _ in range(3)]      # repeated ids
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in
           line_templates.dedup(frame(spark, rows)).select("row.doc_id", "n_lines", "n_dropped", "text").collect()]
    once = {i for i, _, _ in rows if sum(x[0] == i for x in rows) == 1}  # the SQL tells the rows of one id not apart
    of = lambda found: sorted((x for x in found if x[0] in once), key=str)
    assert len(once) < len({r[0] for r in got}) and of(got) == of(expected(rows))
    by = {r[0]: r for r in got}
    assert by[800][2] == 0 and by[801][2] == 2  # the first document keeps the lines
    assert by[804][3].endswith("same line in few documents")
    assert "Session opened" not in by[820][3] and by[820][3].endswith("\n\nEnd")


def test_query_equals_sql_on_the_tables(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = {(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in
           line_templates.dedup(docs).select("row.doc_id", "n_lines", "n_dropped", "text").collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_MID}/documents.parquet'")
    assert got == set(con.sql(ORACLE["op3_line_templates"]).fetchall())


def test_nulls_repeats_and_columns(spark):
    rows = documents() + [(None, "All rights are reserved here.", "en")] * 12
    docs = frame(spark, rows)
    found = line_templates.dedup(docs)
    assert found.count() == len(rows)
    assert found.select("row.*").columns == docs.columns
    null = found.filter("row.text IS NULL").collect()
    assert len(null) == 2 and all(r.text is None and r.n_lines == 0 for r in null)
    # no document has an id that could keep the line
    assert found.filter("row.doc_id IS NULL AND n_dropped > 0").count() == 0


def test_empty_table(spark):
    assert line_templates.dedup(frame(spark, [])).count() == 0


@pytest.mark.parametrize("low, kept", [(10, False), (41, True)])
def test_threshold(spark, low, kept):
    got = line_templates.dedup(frame(spark, logs()), min_docs=low).filter("row.doc_id = 830").first()
    assert ("Session opened" in got.text) == kept

"""Every registered query against its independent DuckDB SQL (value-exact, order-insensitive)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, rows_multiset

SF_SMALL = "/root/testdata/sf0.001"

#: The library's own queries; those of the optional parts have tests of their own.
QUERIES = {name: query for name, query in E.queries().items() if name in E.QUERIES}
ORACLE = {name: sql for name, sql in E.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle_or_is_listed():
    no_oracle = set(QUERIES) - set(ORACLE)
    assert no_oracle == set(), f"queries without SQL oracle: {sorted(no_oracle)}"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert rows_multiset(df.columns, rows, False) == rows_multiset(dcols, drows, False)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "fraud_rate" in df.columns

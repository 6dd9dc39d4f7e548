"""How messages are made, landed and scanned (F5): spread over tasks, each text and each remainder worked out once."""

import json
import os

import pytest
from pyspark.sql import functions as F

from txrisk import fixtures
from txrisk.functions import documents
from txrisk.functions import validate as V
from txrisk.sources import json_files


def _tables(spark, at):
    def put(name, rows, kinds):
        spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    put("customer", [(1, "Ann", 3, 10.5)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double")
    put("supplier", [(7, "Sup")], "s_suppkey long, s_name string")
    put("part", [(9, "Brand#1")], "p_partkey long, p_brand string")
    orders = spark.createDataFrame([(k, 1, "F", 500.0, "2024-01-02 00:00:00") for k in range(1, 61)],
                                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, d string")
    orders.withColumn("o_orderdate", F.col("d").cast("timestamp_ntz")).drop("d").coalesce(1).write.parquet(f"{at}/orders.parquet")
    put("lineitem", [(k, n, 9, 7 if n == 1 else None, 1.0, 100.0 * n, 0.0, 0.0, "N", "O", "2024-01-03") for k in range(1, 60) for n in (1, 2)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate string")
    return at


@pytest.fixture()
def whole_plans(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "5000")
    yield
    spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_lines_are_merged_and_texts_made_once(spark, tmp_dir, whole_plans):
    messages = fixtures.txn_messages(spark, _tables(spark, tmp_dir))
    plan = messages._jdf.queryExecution()
    joins = [x for x in plan.executedPlan().toString().split("\n") if "Join" in x and "l_orderkey" in x]
    assert joins and all("SortMergeJoin" in x for x in joins)
    assert plan.optimizedPlan().toString().count('"note":"extra"') == 1
    got = {r["key"]: r["value"] for r in messages.collect()}
    assert len(got) == 119 and sum(v is None for v in got.values()) == sum(int(k[2:]) % 50 == 28 for k in got)
    for key, value in got.items():
        code = int(key[2:]) % 50
        if code in (*range(24, 33), 19):
            continue
        doc = json.loads(value)
        gone = {name for name, rep in fixtures.FIELD_FAULTS.get(code, {}).items() if rep is None}
        assert not gone & set(doc) and ("note" in doc) == (code == 36) and ("channel" in doc) == (code == 40)
    lines = [v for k, v in got.items() if int(k[2:]) % 50 == 43]
    assert all(("merchant_id" in json.loads(v)) == ("merchant_name" in json.loads(v)) for v in lines)


def test_remainder_works_out_lost_fields_once_a_row(spark, whole_plans):
    texts = ['{"amount": 1, "customer_age": "x", "new": {"a": [1]}}', '{"amount": null, "loyalty_points": [1]}', '{"amount": 2}', "[1]"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", F.try_parse_json("t").alias("doc"))
    read = documents.typed(docs)
    rest = {r["i"]: r["e"] and json.loads(r["e"]) for r in read.select("i", F.to_json("extra").alias("e")).collect()}
    assert rest == {0: {"customer_age": "x", "new": {"a": [1]}}, 1: {"loyalty_points": [1]}, 2: None, 3: None}
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    filters = plan.split("map_filter(")[1:]
    assert filters and not any("array_compact" in f.split("\n")[0] for f in filters)


def test_strict_documents_equal_strict_parse(spark, tmp_dir):
    texts = ['{"a": 1}', ' {"a": "]x"} ', '{"a": 1} x', '{"a": 1}{"b": 2}', "[1, 2]", "7", "null", "", "{bad", None, '{"a": 1, "a": 2}']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    old = {r[0]: r[1] for r in rows.select("i", F.to_json(V.strict_parse(F.col("value")))).collect()}
    new = {r[0]: r[1] for r in V.strict_documents(rows).select("i", F.to_json("doc")).collect()}
    assert old == new and new[0] == '{"a":1}' and new[2] is None and new[3] is None
    for i, text in enumerate(["\n".join(t for t in texts[:2]), '{"a": 1}\n[2]', '{"a": 1}\n{"a"']):
        with open(os.path.join(tmp_dir, f"{i}.json"), "w") as f:
            f.write(text)
    docs, report = json_files.scan_documents(spark, tmp_dir, large_file_bytes=1)
    assert {os.path.basename(r["source_file"])[0]: (r["status"], r["records"]) for r in report.collect()} == {"0": ("good", 2), "1": ("bad", 0), "2": ("bad", 0)}
    assert docs.count() == 2

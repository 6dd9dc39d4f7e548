"""Plan properties: no Python UDF in any registered query; scans prune columns and push filters."""

import pytest

import __spark_entry__ as E
from txrisk import fixtures

SF = "/root/testdata/sf0.001"
PY_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_no_python_in_plan(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in PY_NODES)


def test_fixture_scan_prunes_columns(spark):
    plan = fixtures.txn(spark, SF)._jdf.queryExecution().executedPlan().toString()
    # lineitem is read for its key columns, orders for five
    lines = [x for x in plan.split("ReadSchema: ")[1:] if x.startswith("struct<l_orderkey")]
    assert lines and all("l_comment" not in x.split(">")[0] and "l_shipmode" not in x.split(">")[0] for x in lines)
    orders = [x for x in plan.split("ReadSchema: ")[1:] if x.startswith("struct<o_orderkey")]
    assert orders and all("o_orderpriority" not in x.split(">")[0] for x in orders)
    pushed = [x.split("]")[0] for x in plan.split("PushedFilters: [")[1:]]
    assert any("IsNotNull(o_custkey)" in x for x in pushed)

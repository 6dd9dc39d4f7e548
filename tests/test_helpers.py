"""Small helpers: ids, job options, quality distribution and raising suites."""

import pytest

from txrisk import fixtures
from txrisk.functions.classify import padded_id
from txrisk.operators import quality
from txrisk.session import flag, option

SF = "/root/testdata/sf0.001"


def test_padded_id_never_shortens(spark):
    r = spark.createDataFrame([(42,), (100000,), (100009,), (None,)], "n int").select(padded_id("CUST", "n", 5).alias("id")).collect()
    assert [x["id"] for x in r] == ["CUST00042", "CUST100000", "CUST100009", None]


def test_flags_and_options():
    assert flag("Yes") and flag("1") and flag("TRUE") and not flag("no") and not flag(None)
    assert option("3", 1, int) == 3 and option("x", 1, int) == 1 and option("", "d") == "d"


def test_distribution_and_assert_suite(spark):
    txn = fixtures.txn(spark, SF)
    d = quality.distribution(txn, "amount").first()
    assert d["rows"] == txn.count() and d["null_share"] == 0.0 and len(d["quantiles"]) == 3
    assert d["quantiles"][0] <= d["quantiles"][1] <= d["quantiles"][2]
    ok = quality.run_suite(txn, [quality.not_null("transaction_id"), quality.unique("transaction_id")], "txn")
    quality.assert_suite(ok)
    bad = quality.run_suite(txn, [quality.unique("customer_id"), quality.accepted_values("currency", ["EUR"])], "txn")
    with pytest.raises(AssertionError):
        quality.assert_suite(bad)
    rows = {(r["check_name"], r["column_name"]): r["failures"] for r in bad.collect()}
    assert rows[("accepted_values", "currency")] == txn.count()
    assert rows[("unique", "customer_id")] == txn.groupBy("customer_id").count().filter("count > 1").count()


def test_null_keys_count_as_not_null_failures(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    r = {(x["check_name"]): x["failures"] for x in
         quality.run_suite(df, [quality.unique("k"), quality.not_null("k")]).collect()}
    assert r == {"unique": 1, "not_null": 1}

"""Plans of queries that filter on what a message's document holds: its text is parsed where it is made, not once a mention."""

import datetime

import pytest

from txrisk import fixtures
from txrisk.plans import queries, zone_queries
from txrisk.sources import zones

WHOLE = ('"transaction_id":"%s","customer_id":"C1","amount":%s,"currency":"USD","timestamp":"2024-01-02T10:00:00","is_fraud":%s,'
         '"transaction_type":"%s","transaction_status":"completed","location":"VN","device_os":"iOS","payment_method":"crypto",'
         '"merchant_category":"gaming"')
TEXTS = ["{" + WHOLE % ("T1", "5.0", "1", "purchase") + "}", "{" + WHOLE % ("T2", "-5.0", "0", "purchase") + ',"note":"x","loyalty_points":[1]}',
         "{" + WHOLE % ("", "-5.0", "true", "refund") + "}", "{" + WHOLE % ("T4", "1", "2", "purchase") + "}", '{"amount": 1}', "[1]", "7", "{bad", "", None]


@pytest.fixture()
def messages(spark, tmp_dir, monkeypatch):
    spark.conf.set("spark.sql.debug.maxToStringFields", "5000")
    rows = [("t", 0, i, datetime.datetime(2024, 1, 2, 10), "k", text) for i, text in enumerate(TEXTS)]
    spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp timestamp, key string, value string").write.parquet(f"{tmp_dir}/m")
    monkeypatch.setattr(fixtures, "txn_messages", lambda spark, sf_dir: spark.read.parquet(f"{tmp_dir}/m"))
    yield
    spark.conf.unset("spark.sql.debug.maxToStringFields")


def _parses(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("parseJson(")


def test_extra_field_counts_parses_a_message_once(spark, messages):
    got = zone_queries.extra_field_counts(spark, "")
    assert sorted(tuple(r) for r in got.collect()) == [("loyalty_points", "ARRAY<BIGINT>", 1), ("note", "STRING", 1)]
    assert _parses(got) <= 3        # the array, the object, and the remainder made a variant again


def test_fallback_ids_parses_a_message_once(spark, messages):
    got = zone_queries.fallback_ids(spark, "")
    assert [tuple(r)[1:] for r in got.collect()] == [(2, 2)]
    assert _parses(got) <= 2


def test_labelled_messages_parses_a_message_once(spark, messages):
    got = zone_queries.labelled_messages(spark, "")
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, False), (1, 0, True), (2, 1, False)]
    assert _parses(got) <= 2


@pytest.mark.parametrize("name", ["validation_failure_counts", "landed_transactions", "dead_letter"])
def test_messages_are_validated_without_a_copy(spark, messages, tmp_dir, monkeypatch, name):
    monkeypatch.setattr(zones, "materialize", None)
    got = queries.QUERIES[name](spark, tmp_dir)
    assert got.count() == {"validation_failure_counts": 13, "landed_transactions": 2, "dead_letter": 7}[name]
    assert _parses(got) <= 2

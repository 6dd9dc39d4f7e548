"""Breakdowns by dimension."""

from txrisk.plans import queries
from txrisk.sources import zones


def test_staging_is_written_with_the_columns_that_are_read(spark, monkeypatch):
    written = []
    plain = zones.materialize
    monkeypatch.setattr(zones, "materialize", lambda df, *a: written.append(df.columns) or plain(df, *a))
    queries.q_fraud_by_device_and_age(spark, "/root/testdata/sf0.001")
    assert written and all("time_key" not in c and "transaction_id" not in c for c in written)

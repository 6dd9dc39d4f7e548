"""The mart against the star join of every row, and what its plan shuffles."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from txrisk.operators import marts

SF = "/root/testdata/sf0.001"
KINDS = ("merchant_id string, merchant_name string, merchant_category string, location string, latitude double, longitude double, "
         "timestamp timestamp, day_of_week string, transaction_hour int, payment_method string, is_fraud int, amount double")


def staged(spark):
    """Merchants with several names and categories, a timestamp with several days and hours, nulls in every key."""
    at = [dt.datetime(2024, 5, 6, 7), dt.datetime(2024, 5, 6, 7, 0, 1), dt.datetime(2024, 5, 7, 23), None]
    rows = []
    for i in range(240):
        t = at[i % 4]
        day, hour = (["Monday", "Sunday", None][i % 3], [7, 8, 15][i % 5 % 3]) if i % 4 == 0 else ("Tuesday", 23)
        rows.append((None if i % 11 == 0 else f"M{i % 5}", f"name{i % 3}", ["travel", "gaming", None][i % 7 % 3],
                     None if i % 13 == 0 else ["VN", "US"][i % 2], 1.5 + i % 2, 2.0, t, day, hour,
                     None if i % 17 == 0 else ["crypto", "credit_card"][i % 3 % 2], [0, 1, None][i % 6 % 3], None if i % 19 == 0 else i / 8))
    return marts.with_keys(spark.createDataFrame(rows, KINDS))


def star_join(stg):
    """Every fact row joined to every dimension row."""
    joined = (stg.select("merchant_id", "location_key", "time_key", "payment_method_key", "is_fraud", "amount")
              .join(marts.dim_payment_method(stg), "payment_method_key").join(marts.dim_merchant(stg), "merchant_id")
              .join(marts.dim_location(stg), "location_key").join(marts.dim_time(stg).drop("timestamp"), "time_key"))
    fraud = F.col("is_fraud") == 1
    return joined.groupBy(*marts.MART_GROUP).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(fraud).alias("f"), F.avg("amount").alias("a"), F.avg(F.when(fraud, F.col("amount"))).alias("b"))


def values(df, names):
    return sorted((repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in df.select(*names).collect()))


@pytest.mark.parametrize("mart", [marts.fraud_detection_metrics_rows, marts.fraud_detection_metrics_onepass, marts.star_mart,
                                  lambda s: marts.fraud_detection_metrics(s, marts.dim_merchant(s), marts.dim_location(s), marts.dim_time(s),
                                                                          marts.dim_payment_method(s))])
def test_mart_is_the_star_join_of_every_row(spark, mart):
    stg = staged(spark)
    names = [*marts.MART_GROUP]
    assert values(mart(stg), [*names, "total_transactions", "fraud_transactions", "avg_transaction_amount", "avg_fraud_amount"]) \
        == values(star_join(stg), [*names, "n", "f", "a", "b"])


@pytest.mark.parametrize("name", ["fraud_detection_metrics", "fraud_detection_metrics_onepass", "fraud_detection_metrics_star",
                                  "fraud_detection_metrics_latest"])
def test_no_fact_row_is_shuffled_by_its_time(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(time_key" not in plan and "hashpartitioning(timestamp" not in plan

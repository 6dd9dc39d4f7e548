"""Dashboard aggregates named in the reference's documentation.

All are partial+final aggregates; the grouping-sets query scans the fact once
for five breakdowns (Expand + one aggregate) instead of five scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions import classify as K
from txrisk.operators.marts import AMOUNT_DECIMAL


def fraud_volume_daily(fact: DataFrame) -> DataFrame:
    """Per day and label, transaction count and value."""
    return (fact.groupBy(F.to_date("timestamp").alias("date"), "is_fraud")
                .agg(F.count(F.lit(1)).alias("transactions"),
                     F.sum(F.col("amount").cast(AMOUNT_DECIMAL)).cast("double").alias("total_amount")))


BREAKDOWNS = ["country_code", "payment_method", "device_type", "time_of_day", "transaction_type"]


def fraud_rate_by_dimension(stg: DataFrame) -> DataFrame:
    """Fraud rate by each breakdown in one grouping-sets aggregate.

    Output: ``dimension, value, total_transactions, fraud_transactions, fraud_rate``.
    """
    base = stg.select(
        F.col("location").alias("country_code"), "payment_method",
        K.device_type().alias("device_type"), K.time_of_day().alias("time_of_day"),
        "transaction_type", "is_fraud")
    sets = ", ".join(f"({c})" for c in BREAKDOWNS)
    gid_cases = " ".join(
        f"WHEN grouping({c}) = 0 THEN '{c}'" for c in BREAKDOWNS)
    val_cases = " ".join(f"WHEN grouping({c}) = 0 THEN {c}" for c in BREAKDOWNS)
    return stg.sparkSession.sql(f"""
        SELECT CASE {gid_cases} END AS dimension,
               CASE {val_cases} END AS value,
               CAST(count(*) AS BIGINT) AS total_transactions,
               CAST(count_if(is_fraud = 1) AS BIGINT) AS fraud_transactions,
               count_if(is_fraud = 1) / count(*) * 100 AS fraud_rate
        FROM {{base}}
        GROUP BY GROUPING SETS ({sets})""", base=base)


def rule_hit_counts(stg: DataFrame) -> DataFrame:
    """Per rule, how often it fired and on how many fraud transactions."""
    return (stg.select(F.explode("fraud_rules").alias("rule"), "is_fraud")
               .groupBy("rule")
               .agg(F.count(F.lit(1)).alias("hits"), F.count_if(F.col("is_fraud") == 1).alias("fraud_hits")))


def explode_rules(df: DataFrame, outer: bool = False) -> DataFrame:
    """One row per (transaction, rule); ``outer`` keeps rule-less rows with a null rule."""
    gen = F.explode_outer if outer else F.explode
    return df.select("transaction_id", gen("fraud_rules").alias("rule"))


#: Staged columns that the fact and the dimensions of ``fraud_by_device_and_age`` need.
DEVICE_AGE_SOURCE = ["customer_id", "customer_name", "customer_email", "customer_age", "customer_segment", "loyalty_points",
                     "device_id", "device_os", "device_model", "ip_address", "user_agent", "is_fraud"]


def fraud_by_device_and_age(fact: DataFrame, dim_device: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Fact joined to device and customer dimensions, fraud counts by device type and age group.

    Each dimension is reduced to (key, class, number of rows) before the joins and
    the numbers multiply the counts: the result of joining every dimension row,
    without repeating fact rows.
    """
    part = (fact.groupBy("device_id", "customer_id")
                .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_fraud") == 1).alias("n_fraud")))
    devices = dim_device.groupBy("device_id", "device_type").agg(F.count(F.lit(1)).alias("w_device"))
    customers = dim_customer.groupBy("customer_id", "age_group").agg(F.count(F.lit(1)).alias("w_customer"))
    weight = F.col("w_device") * F.col("w_customer")
    return (part.join(devices, "device_id").join(customers, "customer_id")
                .groupBy("device_type", "age_group")
                .agg(F.sum(F.col("n") * weight).cast("bigint").alias("total_transactions"),
                     F.sum(F.col("n_fraud") * weight).cast("bigint").alias("fraud_transactions")))

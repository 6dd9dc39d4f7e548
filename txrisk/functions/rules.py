"""Fraud-rule tagging and record-level quality flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk import schema as S


def _get(df_cols: list[str], name: str, default) -> Column:
    """Column value, or the default when the column is absent or null (dict.get semantics)."""
    if name in df_cols:
        return F.coalesce(F.col(name), F.lit(default))
    return F.lit(default)


def fraud_rules(df_cols: list[str]) -> Column:
    """array<string> of triggered rule names, in rule order; empty when none fire.

    ``amount``, ``transaction_type`` and ``payment_method`` are read directly;
    scores default to 0 and the hour to 12 when missing.
    """
    amount = F.col("amount")
    hour = _get(df_cols, "transaction_hour", 12)
    conds = [
        (S.RULE_HIGH_AMOUNT, amount > 900),
        (S.RULE_SUSPICIOUS_METHOD,
         (F.col("transaction_type") == "transfer") & (F.col("payment_method") == "digital_wallet")),
        (S.RULE_HIGH_FRAUD_SCORE, _get(df_cols, "fraud_score", 0) > 0.8),
        (S.RULE_HIGH_RISK_SCORE, _get(df_cols, "risk_score", 0) > 0.8),
        (S.RULE_VIP_LARGE, (F.col("customer_segment") == "vip") & (amount > 500)),
        (S.RULE_OFF_HOURS, (hour < 6) | (hour > 22)),
    ]
    # A null condition (e.g. null amount) does not fire, as a Python comparison would fail
    # before tagging; nulls are dropped by array_compact.
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in conds]))


def with_fraud_rules(df: DataFrame) -> DataFrame:
    return df.withColumn("fraud_rules", fraud_rules(df.columns))


def non_positive_amount(df: DataFrame) -> Column:
    """Amount <= 0 outside refund/reversal is a quality issue."""
    return (F.col("amount") <= 0) & ~F.col("transaction_type").isin("refund", "reversal")


def with_quality_flags(df: DataFrame) -> DataFrame:
    """B18 flag plus B19 filter: rows whose label is not 0/1 are dropped."""
    return (df.withColumn("amount_quality_issue", F.coalesce(non_positive_amount(df), F.lit(False)))
              .filter(F.col("is_fraud").isin(0, 1)))

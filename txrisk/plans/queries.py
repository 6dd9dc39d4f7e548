"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query starts from the given test tables (via the derived ``txn`` table, one
row per line item) and runs over all of their rows.  Arrays are returned as comma-joined text so
results compare value-for-value with the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk import fixtures
from txrisk.functions import validate as V
from txrisk.functions.rules import with_fraud_rules
from txrisk.functions.rules import with_quality_flags
from txrisk.ml import metrics as M
from txrisk.ml import prep
from txrisk.operators import incremental, ingest, insights, marts, process, quality
from txrisk.plans import fitted, stream_queries, zone_queries
from txrisk.sources import zones

Query = Callable[[SparkSession, str], DataFrame]


def rules_text(df: DataFrame, col: str = "fraud_rules") -> DataFrame:
    return df.withColumn(col, F.array_join(col, ","))


def utc_wall_clock(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """An instant as its UTC wall-clock time (timestamp_ntz): independent of any client's time zone."""
    return df.withColumn(col, F.to_timestamp_ntz(F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")))


@fixtures.plan_once
def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed transactions with rule tags, as the staging view."""
    return marts.staging(with_fraud_rules(fixtures.txn(spark, sf_dir)))


def q_stg_transactions(spark, sf_dir):
    return rules_text(stg(spark, sf_dir))


def _dim(name: str, latest: bool = False) -> Query:
    def q(spark, sf_dir):
        fn = (marts.LATEST_DIMENSIONS if latest else marts.DIMENSIONS)[name]
        return fn(stg(spark, sf_dir))
    q.__name__ = f"q_{name}{'_latest' if latest else ''}"
    return q


def q_fact_transactions(spark, sf_dir):
    return rules_text(marts.fact_transactions(stg(spark, sf_dir)))


def _mart_source(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Staging written once with the columns that the mart reads; its keys are made again from them."""
    return marts.with_keys(zones.materialize(stg(spark, sf_dir).select(*marts.MART_SOURCE, *more), "stg"))


def q_fraud_detection_metrics(spark, sf_dir):
    return marts.fraud_detection_metrics_rows(_mart_source(spark, sf_dir))


def q_fraud_detection_metrics_onepass(spark, sf_dir):
    """The mart from one GROUPING SETS pass over staging."""
    return marts.fraud_detection_metrics_onepass(stg(spark, sf_dir))


def q_fraud_detection_metrics_star(spark, sf_dir):
    """The mart over explicitly built dimension tables (staging written once, dims read from it)."""
    return marts.star_mart(_mart_source(spark, sf_dir))


def q_fraud_detection_metrics_latest(spark, sf_dir):
    """The mart over latest-per-key dimensions (one merchant row per id: no join fan-out)."""
    return marts.star_mart(_mart_source(spark, sf_dir, "transaction_id"), dim_mode="latest")


def q_fraud_detection_metrics_flat(spark, sf_dir):
    return marts.fraud_detection_metrics_flat(stg(spark, sf_dir))


@fixtures.plan_once
def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.validate(fixtures.txn_messages(spark, sf_dir))


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated messages, read once by each query: a filter by status stays above the validation, so no copy is written."""
    return _validated(spark, sf_dir)


def q_validate_messages(spark, sf_dir):
    return validated(spark, sf_dir).select("topic", "partition", "offset", "status", "error_reason")


def q_pipeline_counters(spark, sf_dir):
    return ingest.pipeline_counters(validated(spark, sf_dir))


def q_validation_failure_counts(spark, sf_dir):
    return ingest.failure_counts(validated(spark, sf_dir), time_col="timestamp")


def q_dead_letter(spark, sf_dir):
    return ingest.dead_letters(validated(spark, sf_dir)).select(
        "doc_id", "kafka_topic", "kafka_partition", "kafka_offset", "error_message", "error_reason")


def q_landed_transactions(spark, sf_dir):
    landed = utc_wall_clock(ingest.valid_records(validated(spark, sf_dir)))
    return rules_text(landed.select("transaction_id", "customer_id", "amount", "currency", "timestamp", "is_fraud",
                                    "transaction_type", "merchant_id", "latitude", "fraud_rules"))


def q_processed_zone(spark, sf_dir):
    return utc_wall_clock(rules_text(process.process(with_fraud_rules(fixtures.txn(spark, sf_dir)), stamp=False)))


def q_quality_flags(spark, sf_dir):
    return with_quality_flags(fixtures.txn(spark, sf_dir)).select("transaction_id", "amount_quality_issue")


def _incremental(lookback):
    def q(spark, sf_dir):
        fact = marts.fact_transactions(zones.materialize(stg(spark, sf_dir), "stg"))
        # First load: the completed orders; the second run offers every staged row.
        first = zones.materialize(fact.filter(F.col("transaction_status") == "completed"), "fact_v1")
        return rules_text(incremental.incremental_load(first, fact, lookback=lookback))
    q.__name__ = "q_fact_incremental" + ("_lookback" if lookback else "")
    return q


def q_fact_incremental_partitioned(spark, sf_dir):
    """Same two loads into a date-partitioned fact: the second run rewrites only the days it touches."""
    from txrisk.session import scratch_path
    fact = zones.materialize(marts.fact_transactions(stg(spark, sf_dir)), "fact")
    path = scratch_path(spark, "fact_partitioned")
    # monthly partitions: the test tables hold a few hundred to a few thousand rows per month
    incremental.incremental_load_partitioned(spark, fact.filter(F.col("transaction_status") == "completed"), path,
                                             partition_col="month", granularity="month")
    incremental.incremental_load_partitioned(spark, fact, path, partition_col="month", granularity="month")
    return rules_text(spark.read.parquet(path).drop("month"))


def q_schema_tests(spark, sf_dir):
    star = marts.build_star(zones.materialize(stg(spark, sf_dir), "stg"))
    return quality.run_schema_tests(spark, star)


TXN_SUITE = [
    quality.not_null("transaction_id"), quality.not_null("amount"), quality.not_null("timestamp"),
    quality.unique("transaction_id"),
    quality.in_range("amount", 0, None), quality.in_range("customer_age", 18, 80),
    quality.in_range("latitude", -90, 90), quality.in_range("longitude", -180, 180),
    quality.accepted_values("transaction_type", ["purchase", "transfer", "withdrawal", "payment", "refund",
                                                 "reversal", "fee"]),
    quality.accepted_values("transaction_status", ["completed", "pending", "failed", "reversed", "flagged",
                                                   "authorized"]),
    quality.accepted_values("is_fraud", [0, 1]), quality.accepted_values("currency", ["USD"]),
    quality.accepted_values("device_os", ["Android", "iOS", "Windows", "macOS", "Linux"]),
    quality.has_type("amount", "double"), quality.has_type("is_fraud", "int"),
]


def q_quality_suite(spark, sf_dir):
    return quality.run_suite(fixtures.txn(spark, sf_dir), TXN_SUITE, "txn")


DISTRIBUTION_SUITE = [
    quality.has_distribution("amount", mean=(0, 5000), stddev=(None, 1), null_share=0.0, quantiles={0.5: (10, 1000), 0.99: (None, 50)}),
    quality.has_distribution("merchant_amount", mean=(0, None), null_share=0.5, quantiles={0.25: (0, 900)}),
    quality.has_distribution("customer_age", mean=(18, 80), stddev=(5, 40), quantiles={0.1: (18, 40), 0.9: (50, 80)}),
]


def _amounts(spark, sf_dir):
    """Transactions with the amount that went to a merchant, null where there is none."""
    return fixtures.txn(spark, sf_dir).withColumn("merchant_amount", F.when(F.col("merchant_id").isNotNull(), F.col("amount")))


def q_distribution_suite(spark, sf_dir):
    return quality.run_suite(_amounts(spark, sf_dir), DISTRIBUTION_SUITE, "txn")


def q_distribution_monthly(spark, sf_dir):
    """Every month's distribution; whether its sketched quartiles have the ranks that they should; whether the month drifted."""
    month = F.trunc(F.to_date("timestamp"), "month")
    table = zones.materialize(quality.sketches(_amounts(spark, sf_dir), "merchant_amount", month, "month"), "sketches")
    at = [0.25, 0.5, 0.75]
    values = table.filter("null_share < 1").select(F.col("month").alias("of"), *(
        F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(f"q{i}") for i, q in enumerate(at)))
    rows = _amounts(spark, sf_dir).select(month.alias("month"), "merchant_amount").filter("merchant_amount IS NOT NULL")
    n = F.count(F.lit(1))
    holds = F.lit(True)
    for i, q in enumerate(at):
        below, upto = (F.count_if(c) / n for c in (F.col("merchant_amount") < F.col(f"q{i}"), F.col("merchant_amount") <= F.col(f"q{i}")))
        holds = holds & (below <= q + 0.02) & (upto >= q - 0.02)
    checked = rows.join(values, rows.month == values.of).groupBy("month").agg(holds.alias("quartiles_hold"))
    moved = quality.drift(table, bound=0.3, name="month").select("month", "drifted")
    return (table.drop("sketch").join(checked, "month", "left").join(moved, "month", "left")
            .withColumns({c: F.round(F.col(c) + 1e-9, 4) for c in ("mean", "stddev")}))   # off exact halves, which sums in another order may miss


def q_fraud_volume_daily(spark, sf_dir):
    return insights.fraud_volume_daily(marts.fact_transactions(stg(spark, sf_dir)))


def q_fraud_rate_by_dimension(spark, sf_dir):
    return insights.fraud_rate_by_dimension(stg(spark, sf_dir))


def q_rule_hit_counts(spark, sf_dir):
    return insights.rule_hit_counts(stg(spark, sf_dir))


def q_fraud_rules_exploded(spark, sf_dir):
    return insights.explode_rules(stg(spark, sf_dir), outer=True)


def q_fraud_by_device_and_age(spark, sf_dir):
    s = zones.materialize(stg(spark, sf_dir).select(*insights.DEVICE_AGE_SOURCE), "stg")
    return insights.fraud_by_device_and_age(s, marts.dim_device(s), marts.dim_customer(s))


def q_model_metrics(spark, sf_dir):
    return M.evaluate(fixtures.scored(spark, sf_dir), ["model"])


def q_best_model(spark, sf_dir):
    metrics = M.evaluate(fixtures.scored(spark, sf_dir), ["model"])
    return M.best_model(metrics, fixtures.MODEL_ORDER).select("model", "f1_score_class_1")


def q_confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(fixtures.scored(spark, sf_dir), ["model"])


def _labelled(spark, sf_dir):
    return fixtures.txn(spark, sf_dir).select("transaction_id", F.col("is_fraud").alias("label"))


def q_label_distribution(spark, sf_dir):
    return M.label_distribution(_labelled(spark, sf_dir))


def q_class_balance(spark, sf_dir):
    return M.class_balance(_labelled(spark, sf_dir))


def q_train_test_split(spark, sf_dir):
    return (_labelled(spark, sf_dir).withColumn("split", prep.split_column())
            .groupBy("split", "label").agg(F.count(F.lit(1)).alias("rows")))


def q_undersampled_train(spark, sf_dir):
    train = _labelled(spark, sf_dir).filter(prep.split_column() == "train")
    return prep.undersample(train)


def _finish(q) -> None:
    """Wait until an availableNow query has drained its source; its failure is raised."""
    q.awaitTermination()


def q_landing_scan(spark, sf_dir):
    """Rows landed as JSON files in the shared folder, scanned back with dialect detection."""
    from txrisk.session import scratch_path
    from txrisk.sources import json_files
    path = scratch_path(spark, "landing")
    json_files.write_landing(with_fraud_rules(fixtures.txn(spark, sf_dir)), f"{path}/transactions")
    recs, _ = json_files.scan_json(spark, path)
    return rules_text(recs.select("transaction_id", "customer_id", "amount", "currency", "is_fraud",
                                  "transaction_type", "merchant_id", "latitude", "loyalty_points", "fraud_rules"))


def q_streamed_landing(spark, sf_dir):
    """Messages dumped to files, ingested by the streaming query (availableNow), landing table read back."""
    from txrisk.session import scratch_path
    from txrisk.streaming import ingest as stream
    base = scratch_path(spark, "stream")
    stream.write_message_files(fixtures.txn_messages(spark, sf_dir), f"{base}/topic", source="parquet")
    q = stream.start_ingest(stream.read_messages(spark, "parquet", path=f"{base}/topic"),
                            f"{base}/landing", f"{base}/dead", f"{base}/checkpoint", trigger={"availableNow": True})
    _finish(q)
    landed = utc_wall_clock(stream.read_landing(spark, f"{base}/landing"))
    return rules_text(landed.select("transaction_id", "customer_id", "amount", "currency", "timestamp", "is_fraud",
                                    "transaction_type", "merchant_id", "latitude", "fraud_rules"))


def q_stream_window_counts(spark, sf_dir):
    """Windowed message counters from the streaming query (30-day windows, update mode: no window is left out)."""
    from txrisk.session import scratch_path
    from txrisk.streaming import ingest as stream
    base = scratch_path(spark, "stream_windows")
    stream.write_message_files(fixtures.txn_messages(spark, sf_dir), f"{base}/topic", source="parquet")
    counts = stream.windowed_counts(stream.read_messages(spark, "parquet", path=f"{base}/topic"),
                                    window="30 days", watermark="1 day")
    q = stream.start_windowed(counts, f"{base}/out", f"{base}/checkpoint", trigger={"availableNow": True})
    _finish(q)
    return utc_wall_clock(utc_wall_clock(stream.read_windowed(spark, f"{base}/out"), "window_start"), "window_end")


QUERIES: dict[str, Query] = {
    "fraud_detection_metrics": q_fraud_detection_metrics,
    "fraud_detection_metrics_flat": q_fraud_detection_metrics_flat,
    "fraud_detection_metrics_onepass": q_fraud_detection_metrics_onepass,
    "fraud_detection_metrics_star": q_fraud_detection_metrics_star,
    "fraud_detection_metrics_latest": q_fraud_detection_metrics_latest,
    "stg_transactions": q_stg_transactions,
    "fact_transactions": q_fact_transactions,
    **{name: _dim(name) for name in marts.DIMENSIONS},
    **{f"{name}_latest": _dim(name, latest=True) for name in marts.LATEST_DIMENSIONS},
    "validate_messages": q_validate_messages,
    "pipeline_counters": q_pipeline_counters,
    "validation_failure_counts": q_validation_failure_counts,
    "dead_letter": q_dead_letter,
    "landed_transactions": q_landed_transactions,
    "processed_zone": q_processed_zone,
    "quality_flags": q_quality_flags,
    "fact_incremental": _incremental(None),
    "fact_incremental_lookback": _incremental("30 DAYS"),
    "fact_incremental_partitioned": q_fact_incremental_partitioned,
    "schema_tests": q_schema_tests,
    "quality_suite": q_quality_suite,
    "distribution_suite": q_distribution_suite,
    "distribution_monthly": q_distribution_monthly,
    "fraud_volume_daily": q_fraud_volume_daily,
    "fraud_rate_by_dimension": q_fraud_rate_by_dimension,
    "rule_hit_counts": q_rule_hit_counts,
    "fraud_rules_exploded": q_fraud_rules_exploded,
    "fraud_by_device_and_age": q_fraud_by_device_and_age,
    "model_metrics": q_model_metrics,
    "best_model": q_best_model,
    "confusion_matrix": q_confusion_matrix,
    "label_distribution": q_label_distribution,
    "class_balance": q_class_balance,
    "train_test_split": q_train_test_split,
    "undersampled_train": q_undersampled_train,
    "landing_scan": q_landing_scan,
    "streamed_landing": q_streamed_landing,
    "stream_window_counts": q_stream_window_counts,
    **fitted.QUERIES,
    **zone_queries.QUERIES,
    **stream_queries.QUERIES,
}

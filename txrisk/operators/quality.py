"""Data-quality checks and a one-pass suite runner (Q1-Q7).

Row-level checks (not_null, range, set membership, distribution) are fused
into **one** aggregate over the table: one scan, partial aggregation per task.
``unique`` needs a grouping by the key; each such check is one extra
partial+final aggregate (duplicates are counted per key map-side first, so a
hot key does not concentrate raw rows in one task), which also answers
``not_null`` for that key (the null group).  Nothing is collected except the
small report.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    kind: str                      # not_null | unique | range | accepted_values | type | distribution
    column: str
    args: dict = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"


def not_null(col: str) -> Check:
    return Check("not_null", col)


def unique(col: str) -> Check:
    return Check("unique", col)


def in_range(col: str, lo=None, hi=None) -> Check:
    return Check("range", col, {"lo": lo, "hi": hi})


def accepted_values(col: str, values: list) -> Check:
    return Check("accepted_values", col, {"values": list(values)})


def has_type(col: str, type_name: str) -> Check:
    return Check("type", col, {"type": type_name})


#: Size of a quantile sketch: about 0.4 % error of rank, some kilobytes however many rows it has seen.
SKETCH = 800


def has_distribution(col: str, mean: tuple | None = None, stddev: tuple | None = None, null_share: float | None = None,
                     quantiles: dict[float, tuple] | None = None) -> Check:
    """Q6: bounds (low, high) on mean, standard deviation and quantiles, and the largest share of nulls; ``None`` is no bound.

    Quantiles come from a mergeable sketch in the suite's one pass; each broken bound is one failure.
    """
    return Check("distribution", col, {"mean": mean, "stddev": stddev, "null_share": null_share, "quantiles": quantiles or {}})


def _outside(value: Column, bounds: tuple | None) -> Column:
    if bounds is None:
        return F.lit(0)
    bad = F.lit(False)
    for bound, breaks in zip(bounds, (lambda v, b: v < b, lambda v, b: v > b)):
        if bound is not None:
            bad = bad | breaks(value, F.lit(float(bound)))
    return F.coalesce(bad, F.lit(False)).cast("int")          # no values: nothing to bound


def _distribution_failures(c: Check) -> Column:
    col = F.col(c.column).cast("double")
    failures = _outside(F.avg(col), c.args["mean"]) + _outside(F.stddev(col), c.args["stddev"])
    if c.args["null_share"] is not None:
        failures = failures + _outside(F.count_if(col.isNull()) / F.count(F.lit(1)), (None, c.args["null_share"]))
    for q, bounds in c.args["quantiles"].items():
        sketch = F.kll_sketch_agg_double(col, F.lit(SKETCH))
        value = F.when(F.count(col) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(float(q))))
        failures = failures + _outside(value, bounds)
    return failures


def _failure_expr(c: Check) -> Column:
    col = F.col(c.column)
    if c.kind == "distribution":
        return _distribution_failures(c)
    if c.kind == "not_null":
        return F.count_if(col.isNull())
    if c.kind == "range":
        lo, hi = c.args.get("lo"), c.args.get("hi")
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (col < F.lit(lo))
        if hi is not None:
            bad = bad | (col > F.lit(hi))
        return F.count_if(col.isNotNull() & bad)
    if c.kind == "accepted_values":
        return F.count_if(col.isNotNull() & ~col.isin(c.args["values"]))
    raise ValueError(c.kind)


def run_suite(df: DataFrame, checks: list[Check], table: str = "table") -> DataFrame:
    """Q7: report rows ``(table_name, check_name, column_name, failures, passed)``.

    Schema checks (``type``) are answered from the schema without a job.
    """
    spark = df.sparkSession
    key_checks = [c for c in checks if c.kind == "unique"]
    key_cols = {c.column for c in key_checks}
    # not_null on a unique-checked key is answered by the same grouping (the null group)
    fused_nulls = [c for c in checks if c.kind == "not_null" and c.column in key_cols]
    row_checks = [c for c in checks if c.kind in ("not_null", "range", "accepted_values", "distribution") and c not in fused_nulls]
    type_checks = [c for c in checks if c.kind == "type"]
    parts: list[DataFrame] = []
    if row_checks:
        fused = df.agg(*[_failure_expr(c).cast("bigint").alias(f"c{i}") for i, c in enumerate(row_checks)])
        stack = ", ".join(f"'{c.kind}', '{c.column}', c{i}" for i, c in enumerate(row_checks))
        parts.append(fused.selectExpr(f"stack({len(row_checks)}, {stack}) AS (check_name, column_name, failures)"))
    for c in key_checks:
        # dbt semantics: number of non-null key values that occur more than once.
        per_key = df.groupBy(c.column).agg(F.count(F.lit(1)).alias("n"))
        key = F.col(c.column)
        res = per_key.agg(F.count_if(key.isNotNull() & (F.col("n") > 1)).cast("bigint").alias("dups"),
                          F.coalesce(F.sum(F.when(key.isNull(), F.col("n"))), F.lit(0)).cast("bigint")
                          .alias("nulls"))
        pairs = [f"'unique', '{c.column}', dups"]
        if any(x.column == c.column for x in fused_nulls):
            pairs.append(f"'not_null', '{c.column}', nulls")
        parts.append(res.selectExpr(f"stack({len(pairs)}, {', '.join(pairs)}) AS (check_name, column_name, failures)"))
    if type_checks:
        dtypes = dict(df.dtypes)
        rows = [(c.kind, c.column, 0 if dtypes.get(c.column) == c.args["type"] else 1) for c in type_checks]
        parts.append(spark.createDataFrame(rows, "check_name string, column_name string, failures bigint"))
    if not parts:
        return spark.createDataFrame([], "table_name string, check_name string, column_name string, "
                                         "failures bigint, passed boolean")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(table).alias("table_name"), "check_name", "column_name", "failures",
                      (F.col("failures") == 0).alias("passed"))


def assert_suite(report: DataFrame) -> None:
    """Raise when any check failed (collects only the small report)."""
    failed = [r for r in report.collect() if not r["passed"]]
    if failed:
        msg = ", ".join(f"{r['table_name']}.{r['column_name']} {r['check_name']} ({r['failures']})" for r in failed)
        raise AssertionError(f"data-quality checks failed: {msg}")


def distribution(df: DataFrame, col: str, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75),
                 accuracy: int = 10000) -> DataFrame:
    """Q6: mean, stddev, null share and approximate quantiles in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(col).alias("mean"),
        F.stddev(col).alias("stddev"),
        (F.count_if(F.col(col).isNull()) / F.count(F.lit(1))).alias("null_share"),
        F.percentile_approx(col, list(quantiles), accuracy).alias("quantiles"),
    )


def sketches(df: DataFrame, col: str, period: Column, name: str = "period") -> DataFrame:
    """Q6 over time: (period, rows, null_share, mean, stddev, sketch), one row per period.

    Sketches of single periods merge to that of any span (``kll_merge_agg_double``), so the table can grow by a period at
    a time and earlier rows are never read again.
    """
    value = F.col(col).cast("double")
    return df.groupBy(period.alias(name)).agg(
        F.count(F.lit(1)).alias("rows"), (F.count_if(value.isNull()) / F.count(F.lit(1))).alias("null_share"), F.avg(value).alias("mean"),
        F.stddev(value).alias("stddev"), F.kll_sketch_agg_double(value, F.lit(SKETCH)).alias("sketch"))


def drift(table: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75), bound: float = 0.1, name: str = "period") -> DataFrame:
    """(period, shift, drifted): how far, in rank, the quantiles of all periods together lie from their place in a period."""
    filled = table.filter("null_share < 1")
    merged = F.kll_merge_agg_double("sketch", F.lit(SKETCH))
    # one row, a number per quantile
    whole = filled.agg(*(F.kll_sketch_get_quantile_double(merged, F.lit(q)).alias(f"q{i}") for i, q in enumerate(quantiles))).first()
    if whole is None or whole[0] is None:
        return filled.select(name, F.lit(None).cast("double").alias("shift"), F.lit(None).cast("boolean").alias("drifted"))
    own = [F.abs(F.kll_sketch_get_rank_double("sketch", F.lit(v)) - F.lit(q)) for q, v in zip(quantiles, whole)]
    shift = F.greatest(*own) if len(own) > 1 else own[0]
    return filled.select(name, shift.alias("shift"), (shift > bound).alias("drifted"))


# The reference's declared model tests (unique + not_null on each key).
SCHEMA_TESTS: dict[str, list[Check]] = {
    "fact_transactions": [unique("transaction_id"), not_null("transaction_id")],
    "dim_customer": [unique("customer_id"), not_null("customer_id")],
    "dim_merchant": [unique("merchant_id"), not_null("merchant_id")],
    "dim_location": [unique("location_key"), not_null("location_key")],
    "dim_time": [unique("time_key"), not_null("time_key")],
    "dim_device": [unique("device_id"), not_null("device_id")],
    "dim_payment_method": [unique("payment_method_key"), not_null("payment_method_key")],
}


def run_schema_tests(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Q1/Q2 over the star schema, one report."""
    reports = [run_suite(tables[name], checks, name) for name, checks in SCHEMA_TESTS.items() if name in tables]
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


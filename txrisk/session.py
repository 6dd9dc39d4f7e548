"""Session construction and the shared checkpoint folder.

Settings here are the ones the library's semantics depend on (UTC session zone,
ANSI mode) plus sane execution defaults (AQE with skew-join splitting).  On a
cluster the launcher owns memory, executors and ``spark.checkpoint.dir``; this
module only fills in what is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: hash keys over timestamps and the oracle
# comparisons assume a UTC session zone.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # JSON objects with a repeated key keep the last value, as Python's json.loads does.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The validator's generated code has methods above HotSpot's 8 KB JIT limit;
    # let the JIT compile them instead of interpreting them.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def get_spark(app: str = "txrisk", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Uses ``spark.checkpoint.dir`` as configured by the cluster.  Only when it is
    unset (local runs, tests) a scratch folder is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = d.get() if d.isDefined() else None
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="txrisk-ckpt-")          # local runs and tests only
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{os.urandom(6).hex()}")


TRUTHY = {"true", "1", "y", "yes"}


def flag(value, default: bool = False) -> bool:
    """Job option as boolean; the strings true/1/y/yes (any case) are true."""
    if value is None:
        return default
    if isinstance(value, bool):
        return value
    return str(value).strip().lower() in TRUTHY


def option(value, default, cast=str):
    """Job option with type coercion; the default when missing or not convertible."""
    if value is None or value == "":
        return default
    try:
        return cast(value)
    except (TypeError, ValueError):
        return default

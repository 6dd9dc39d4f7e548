"""Parquet zones: read, write, copy, materialise, compact.

Writes never target a path that the same plan reads: ``copy_zone`` refuses
``src == dst`` and ``replace_zone`` writes a new version folder first.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from txrisk.session import scratch_path


def check_path(path: str, name: str = "path") -> str:
    """Non-empty path; returned with a trailing slash removed for comparison."""
    if not path or not str(path).strip():
        raise ValueError(f"{name} must be a non-empty path")
    return str(path).rstrip("/")


def read_zone(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file or folder."""
    return spark.read.parquet(check_path(path))


def write_zone(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet sink (overwrite by default)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(check_path(path))


def is_empty(df: DataFrame) -> bool:
    """Reads at most one row."""
    return df.isEmpty()


def copy_zone(spark: SparkSession, src: str, dst: str) -> int:
    """Copy a Parquet zone; src == dst is refused, an empty source is a no-op.

    Returns the number of rows copied (observed during the write, one pass).
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    s, d = check_path(src, "src"), check_path(dst, "dst")
    if os.path.normpath(s) == os.path.normpath(d):
        raise ValueError("source and destination zones must differ")
    df = read_zone(spark, s)
    if is_empty(df):
        return 0
    obs = Observation("copy")
    write_zone(df.observe(obs, F.count(F.lit(1)).alias("rows")), d)
    return obs.get["rows"]


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts lineage for frames consumed by several branches of a plan (each branch
    then scans only the columns it needs) and survives executor loss, unlike a
    cache or a local checkpoint.
    """
    spark = df.sparkSession
    target = path or scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(target)
    return spark.read.parquet(target)


# --- versioned tables (upsert targets) ----------------------------------------
# A table is a folder of version sub-folders ``v=<n>``; a version counts once its
# ``_SUCCESS`` marker exists.  Writing a new version never touches the one being
# read, and a crash mid-write leaves the previous version current.

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder below the shared checkpoint folder that this library wrote."""
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, written beside its place and renamed, so that a file that exists is whole."""
    fs, p, jvm = _fs(spark, path)
    own = jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}.tmp")
    out = fs.create(own, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(own, p):
        fs.delete(own, False)


def drop_partitions(spark: SparkSession, path: str, col: str, values: list) -> None:
    """Remove the folders of partition values of a Parquet table."""
    fs, base, jvm = _fs(spark, path)
    for value in values:
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
        fs.delete(jvm.org.apache.hadoop.fs.Path(base, f"{col}={name}"), True)


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[2:]))
    return sorted(out)


def current_version(spark: SparkSession, path: str) -> str | None:
    v = _versions(spark, check_path(path))
    return f"{check_path(path)}/v={v[-1]}" if v else None


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version of a versioned table, or None when it has none yet."""
    cur = current_version(spark, path)
    return spark.read.parquet(cur) if cur else None


def replace_table(spark: SparkSession, df: DataFrame, path: str, keep: int = 2) -> str:
    """Write ``df`` as the next version; older versions beyond ``keep`` are removed.

    ``df`` may read the current version (the write goes to a new folder).
    """
    base = check_path(path)
    versions = _versions(spark, base)
    nxt = (versions[-1] + 1) if versions else 1
    target = f"{base}/v={nxt}"
    df.write.mode("overwrite").parquet(target)
    fs, _, jvm = _fs(spark, base)
    for old in versions[:-max(keep - 1, 0)] if keep > 1 else versions:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{base}/v={old}"), True)
    return target


def materialize_as(spark: SparkSession, df: DataFrame, name: str, mode: str = "view",
                   path: str | None = None, unique_key: str | None = None) -> DataFrame:
    """``view`` (temp view), ``table`` (Parquet overwrite) or ``incremental`` (upsert)."""
    if mode == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if path is None:
        raise ValueError("table and incremental materialisation need a path")
    if mode == "table":
        replace_table(spark, df, path)
    elif mode == "incremental":
        from txrisk.operators.incremental import incremental_load
        if not unique_key:
            raise ValueError("incremental materialisation needs unique_key")
        replace_table(spark, incremental_load(read_table(spark, path), df, key=unique_key), path)
    else:
        raise ValueError(f"unknown materialisation {mode!r}")
    out = read_table(spark, path)
    out.createOrReplaceTempView(name)
    return out

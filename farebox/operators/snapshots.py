"""Kept versions of a table as ordinary rows: reads as of a version or a time, history, KPI diff.

A versioned table is plain Parquet partitioned by ``snapshot`` and month; a
version is the rows with one ``snapshot`` value. Reading one is a partition
filter, restoring one is copying its rows under a new value. The history is an
ordinary table too: each write appends one row about itself, once it is done, with
the counts that were observed while it wrote.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farebox.config import MONTH_COL
from farebox.session import path_exists

SNAPSHOT = "snapshot"
HISTORY_SCHEMA = "version int, committed_at timestamp, operation string, metrics map<string,bigint>, user string"


def record(spark: SparkSession, path: str, version: int, operation: str, metrics: dict[str, int]) -> None:
    """Append what a write did to the history table at ``path`` (one small file a write)."""
    row = spark.createDataFrame([(version, operation, metrics)], "version int, operation string, metrics map<string,bigint>")
    row.coalesce(1).select("version", F.current_timestamp().alias("committed_at"), "operation", "metrics",
                           F.current_user().alias("user")).write.mode("append").parquet(path)


def history(spark: SparkSession, path: str) -> DataFrame:
    """Version, time, operation, metrics and user of every recorded write; empty before the first."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], HISTORY_SCHEMA)
    return spark.read.schema(HISTORY_SCHEMA).parquet(path)


def write_snapshot(df: DataFrame, path: str, snapshot: int, partition_col: str = MONTH_COL,
                   history_path: str | None = None, operation: str = "WRITE") -> None:
    """Write ``df`` as version ``snapshot``; writing the same version again replaces its months.

    With ``history_path`` the write is recorded there with its rows and months, counted as they are written.
    """
    counts = Observation()
    (df.observe(counts, F.count(F.lit(1)).alias("rows"), F.size(F.collect_set(partition_col)).cast("long").alias("months"))
     .withColumn(SNAPSHOT, F.lit(snapshot)).hint("rebalance", partition_col)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(SNAPSHOT, partition_col).parquet(path))
    if history_path is not None:
        record(df.sparkSession, history_path, snapshot, operation, dict(counts.get))


def as_of_version(versions: DataFrame, snapshot: int) -> DataFrame:
    """The rows of one version (a partition filter on the scan)."""
    return versions.filter(F.col(SNAPSHOT) == snapshot).drop(SNAPSHOT)


def version_at(log: DataFrame, at: dt.datetime) -> int:
    """T4: the newest version of a history committed at or before ``at``, which must carry its zone."""
    if at.tzinfo is None:
        raise ValueError("an as-of time needs a time zone")
    found = log.filter(F.col("committed_at") <= F.lit(at)).agg(F.max("version")).first()[0]
    if found is None:
        raise ValueError(f"no version at or before {at.isoformat()}")
    return int(found)


def as_of_time(versions: DataFrame, log: DataFrame, at: dt.datetime) -> DataFrame:
    """T4: the rows that were current at ``at``."""
    return as_of_version(versions, version_at(log, at))


def newest(log: DataFrame, n: int) -> DataFrame:
    """O3: the ``n`` newest versions of a history."""
    return log.orderBy(F.desc("version")).limit(n)


def metric_columns(log: DataFrame, names: list[str]) -> DataFrame:
    """Chosen metrics as columns; a name the map does not have counts as 0."""
    return log.select("version", *[
        F.coalesce(F.try_element_at("metrics", F.lit(k)), F.lit(0).cast("long")).alias(k) for k in names])


def kpi_diff(kpi_a: DataFrame, kpi_b: DataFrame, key: str = MONTH_COL) -> DataFrame:
    """Two KPI snapshots side by side per month, with deltas (full outer join)."""
    value_cols = [c for c in kpi_a.columns if c != key]
    a = kpi_a.select(key, *[F.col(c).alias(f"{c}_a") for c in value_cols])
    b = kpi_b.select(key, *[F.col(c).alias(f"{c}_b") for c in value_cols])
    j = a.join(b, on=key, how="full_outer")
    deltas = [F.round(F.col(f"{c}_b") - F.col(f"{c}_a"), 2).alias(f"{c}_delta") for c in value_cols]
    return j.select(key, *[F.col(f"{c}_{s}") for c in value_cols for s in "ab"], *deltas).orderBy(key)

"""Layer jobs: each reads a storage path, applies operators, writes a path.

Jobs communicate only through storage, so each can run as a separate step
of an orchestrator and survives the loss of any executor (Spark's commit
protocol retries tasks; nothing is held on the driver).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.config import DEFAULT_COLUMNS, DateWindow, TripColumns
from farebox.operators import aggregates as agg
from farebox.operators import merge as mg
from farebox.operators.cleaning import to_silver
from farebox.operators.quality import DataQualityError, gate, observe_checks, observed_results
from farebox.session import folders, remove_path, scratch_path
from farebox.sinks import keyed
from farebox.sinks.catalog import Layer, ensure_database, register
from farebox.sinks.layout import write_gold, write_partitioned, write_silver
from farebox.sources.landing import read_landing, write_bronze


def bronze_job(spark: SparkSession, landing: str, months: list[str], bronze: str,
               template: str | None = None) -> None:
    """Landing months -> Bronze (lineage, partitioned by source month, dynamic overwrite)."""
    kwargs = {"template": template} if template else {}
    write_bronze(read_landing(spark, landing, months, **kwargs), bronze)


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A layer by storage format."""
    return spark.read.format(fmt).load(path)


def silver_job(spark: SparkSession, bronze: str, silver: str, window: DateWindow,
               cols: TripColumns = DEFAULT_COLUMNS, expectations=None, fmt: str = "parquet"):
    """Bronze -> Silver: clean, gate while staging, publish."""
    return write_silver(to_silver(read_layer(spark, bronze, fmt), window, cols), silver, cols,
                        expectations, fmt=fmt)


def silver_publish_job(spark: SparkSession, bronze: str, silver_root: str, window: DateWindow,
                       database: str, table: str = "silver_trips",
                       cols: TripColumns = DEFAULT_COLUMNS, expectations=None) -> str:
    """Bronze -> a fresh Silver location, gated, then the catalog table is re-pointed (see ``publish_silver``)."""
    return publish_silver(to_silver(read_layer(spark, bronze), window, cols), silver_root, database, table, cols, expectations)


RUNS_KEPT = 2


def publish_silver(silver: DataFrame, silver_root: str, database: str, table: str = "silver_trips",
                   cols: TripColumns = DEFAULT_COLUMNS, expectations=None, fmt: str = "parquet") -> str:
    """K2 + K5 + D8 with one write: a new run folder is written while the checks ride along, then readers are switched.

    The rows are shuffled and written once, below ``silver_root``. Only if the gate
    passes does the catalog table point at the new folder; a run that fails is removed
    and readers keep the earlier one, so they never see an empty or half-written layer.
    ``RUNS_KEPT`` newest runs stay (the current one and one for running readers).
    Returns the new location.
    """
    import time

    spark, root = silver.sparkSession, silver_root.rstrip("/")
    location = f"{root}/run={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    checked, seen = observe_checks(silver, expectations, name=location[-8:], cols=cols)
    write_partitioned(checked, location, [cols.month], fmt=fmt)
    try:
        gate(observed_results(seen))
    except DataQualityError:
        remove_path(spark, location)
        raise
    ensure_database(spark, database)
    register(spark, database, Layer(table, location, "Cleaned trips by month."), fmt)
    for old in folders(spark, f"{root}/run=*")[:-RUNS_KEPT]:
        remove_path(spark, old)
    return location


def read_silver(spark: SparkSession, silver: str, window: DateWindow | None = None,
                cols: TripColumns = DEFAULT_COLUMNS, fmt: str = "parquet") -> DataFrame:
    """Silver, pruned to the window's month partitions when the window lies in one year."""
    df = read_layer(spark, silver, fmt)
    if window is not None and window.single_year:
        df = df.filter(F.col(cols.month).isin(window.months_in_window()))
    return df


def gold_job(spark: SparkSession, silver: str, gold_root: str, month: int = 5,
             cols: TripColumns = DEFAULT_COLUMNS, fmt: str = "parquet") -> dict[str, str]:
    """Silver -> the two Gold aggregates and the Gold fact table."""
    return write_gold(read_layer(spark, silver, fmt), gold_root, month, cols, fmt=fmt)


def incremental_silver_job(spark: SparkSession, bronze: DataFrame, table: keyed.KeyedTable, window: DateWindow,
                           tie_break: list[str] | None = None, expectations=None) -> dict[str, int]:
    """Bronze rows -> clean -> gate -> first load or merge into a keyed Silver table.

    ``bronze`` carries the columns of ``table.sequence``; what has arrived last wins, whichever
    batch it comes in, so corrections take effect in either direction (see ``keyed.merge``).
    """
    silver = to_silver(bronze, window, table.cols, carried=list(table.sequence))
    return keyed.merge(spark, table, silver, expectations, tie_break)


def gold_refresh_job(spark: SparkSession, table: keyed.KeyedTable, gold: str) -> int:
    """M8: bring the stored Gold measures at ``gold`` up to the table's version; returns the version.

    The first run aggregates the table; later ones add the signed changes since the
    stored version, so they read the change feed and some hundred stored rows, no trip.
    Measures are kept by version, and running a version again replaces it.
    """
    now = keyed.history(spark, table).agg(F.max("version")).first()[0]
    if now is None:
        raise ValueError(f"{table.table} has not been loaded")
    done = read_measures_version(spark, gold)
    if done is None or done > now:
        made = agg.gold_measures(keyed.read(spark, table), cols=table.cols)
    else:
        made = gold_delta(spark, table, gold, done, now)
    if done != now:
        made.coalesce(1).write.mode("overwrite").parquet(f"{gold.rstrip('/')}/version={now:09d}")
    return now


def gold_delta(spark: SparkSession, table: keyed.KeyedTable, gold: str, done: int, now: int) -> DataFrame:
    """Stored measures of version ``done`` plus the signed changes up to ``now``."""
    since = keyed.changes(spark, table, after=done, until=now)
    return agg.add_measures(read_measures(spark, gold, done), agg.gold_measures(since, mg.signed(since), table.cols), table.cols)


def read_measures_version(spark: SparkSession, gold: str) -> int | None:
    """The newest complete version of the stored measures."""
    found = folders(spark, f"{gold.rstrip('/')}/version=*/_SUCCESS")
    return max((int(f.split("/")[-2].split("=")[1]) for f in found), default=None)


def read_measures(spark: SparkSession, gold: str, version: int | None = None) -> DataFrame:
    version = read_measures_version(spark, gold) if version is None else version
    return spark.read.parquet(f"{gold.rstrip('/')}/version={version:09d}")


class AnswerMismatchError(Exception):
    """The DataFrame API and Spark SQL answers differ."""


def export_kpis(spark: SparkSession, silver: DataFrame, out_path: str, month: int = 5,
                view: str = "silver_trips") -> None:
    """Q1 through the API and through SQL must be the same bag (one job), then the
    KPI document (one scan of Silver) is written as a single JSON file."""
    from farebox.operators.aggregates import bag_equality, monthly_revenue, monthly_revenue_sql
    from farebox.operators.documents import kpi_document, to_json_document

    # cleaned once: both answers and the document read the staged rows
    stage = scratch_path(spark, "kpi-silver")
    silver.write.parquet(stage)
    silver = spark.read.schema(silver.schema).parquet(stage)
    try:
        api = monthly_revenue(silver, cols=DEFAULT_COLUMNS)
        sql = monthly_revenue_sql(spark, silver, view=view)
        if not bag_equality(api, sql).first()["equal"]:
            raise AnswerMismatchError("API and SQL answers for Q1 differ")
        to_json_document(kpi_document(silver, month)).coalesce(1).write.mode("overwrite").text(out_path)
    finally:
        remove_path(spark, stage)

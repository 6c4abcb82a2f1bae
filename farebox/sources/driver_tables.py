"""Adapter from the driver's TPC-H-style tables to raw trip rows.

The driver tables hold no nulls or exact duplicates in the columns we use,
so the adapter derives trip columns that do (the same way the SQL oracle
does):

=====================  =======================================================
trips_raw column       expression
=====================  =======================================================
VendorID               ``CAST(l_suppkey AS INT)``
passenger_count        ``NULLIF(l_quantity - 1, 13)`` (nulls and zeros)
total_amount           ``l_extendedprice - 2000`` (some negatives)
tpep_pickup_datetime   ``o_orderdate + (l_orderkey % 24) hours``
tpep_dropoff_datetime  ``l_shipdate`` (about half precede the pickup)
trip_distance          ``l_quantity`` (extra column, pruned by the projection)
store_and_fwd_flag     ``l_returnflag`` (extra column)
=====================  =======================================================

Rows of ``lineitem JOIN orders``; rows whose ``l_orderkey`` is a multiple of
50 occur twice (exact duplicates for the dedup step).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farebox.config import DateWindow
from farebox.session import remove_path, scratch_path

DUPLICATE_EVERY = 50  # fixed: the oracle duplicates the same rows


#: Fixed columns of the two tables that every trip query reads; stating them saves a schema inference per plan.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips_raw(spark: SparkSession, sf_dir: str, prune_for: DateWindow | None = None) -> DataFrame:
    """Raw trip rows.

    ``prune_for``: when the caller will clean with this window anyway, add
    predicates that the cleaning rules imply on the *source* columns, so both
    Parquet scans skip data before the join (exact, never drops a row the
    cleaning would keep):

    * ``pickup = o_orderdate + h`` with ``0 <= h <= 23`` and
      ``start <= pickup < end``  ⇒  ``start - 23h <= o_orderdate < end``;
    * ``dropoff > pickup >= start``  ⇒  ``l_shipdate > start``.

    Catalyst cannot derive these through the interval arithmetic itself.
    """
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    if prune_for is not None:
        start = F.lit(prune_for.start).cast("timestamp_ntz")
        end = F.lit(prune_for.end).cast("timestamp_ntz")
        orders = orders.filter(
            (F.col("o_orderdate") >= start - F.expr("INTERVAL 23 HOURS"))
            & (F.col("o_orderdate") < end)
        )
        lineitem = lineitem.filter(F.col("l_shipdate") > start)

    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    # One join, then a generator emits the second copy of every 50th order's
    # rows (cheaper than UNION ALL-ing a second scan + join).
    copies = F.when(F.col("l_orderkey") % DUPLICATE_EVERY == 0, 2).otherwise(1)
    return joined.select(
        F.col("l_suppkey").cast("int").alias("VendorID"),
        F.nullif(F.col("l_quantity") - F.lit(1), F.lit(13.0)).alias("passenger_count"),
        (F.col("l_extendedprice") - F.lit(2000)).alias("total_amount"),
        (
            F.col("o_orderdate")
            + F.make_dt_interval(F.lit(0), (F.col("l_orderkey") % 24).cast("int"))
        ).alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        F.explode(F.sequence(F.lit(1), copies)).alias("_copy"),
    ).drop("_copy")


# The cleaning window used by every query over the driver tables.
DRIVER_WINDOW = DateWindow("1997-01-01", "1997-06-01")


# --- landing files derived from the driver tables ---------------------------

LANDING_PARTITION = "_file"
# Landing directories are written as ``<landing>/_file=yellow_tripdata_<YYYY-MM>.parquet``
# (one Spark write per physical schema, partitioned by file name).
DRIVER_LANDING_TEMPLATE = LANDING_PARTITION + "=yellow_tripdata_{month}.parquet"
#: Rows of a staged file: a task takes several files, and sorts their rows by landing file in memory.
STAGED_ROWS = 100_000


def landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``trips_landing`` derives its columns from, each once: the lineitems with their order's pickup time."""
    lineitem = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    copies = F.when(F.col("l_orderkey") % DUPLICATE_EVERY == 0, 2).otherwise(1)
    pickup = F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), (F.col("l_orderkey") % 24).cast("int"))
    return joined.select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
        "l_shipdate", pickup.alias("pickup"),
        F.explode(F.sequence(F.lit(1), copies)).alias("_copy"),
    ).drop("_copy")


def trips_landing(rows: DataFrame) -> DataFrame:
    """Raw trips plus the other TLC-style columns, in canonical types, of staged ``landing_rows``.

    RatecodeID = l_linenumber, PULocationID = l_partkey, DOLocationID =
    l_suppkey, payment_type = l_linenumber % 4 + 1, airport_fee = l_tax,
    congestion_surcharge = l_discount (present in even months only), and a
    sub-microsecond part ``_nanos`` = l_linenumber for the nanosecond files.
    """
    return rows.select(
        F.col("l_suppkey").cast("bigint").alias("VendorID"),
        F.nullif(F.col("l_quantity") - F.lit(1), F.lit(13.0)).alias("passenger_count"),
        (F.col("l_extendedprice") - F.lit(2000)).alias("total_amount"),
        F.col("pickup").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        F.col("l_linenumber").cast("double").alias("RatecodeID"),
        F.col("l_partkey").alias("PULocationID"),
        F.col("l_suppkey").alias("DOLocationID"),
        ((F.col("l_linenumber") % 4) + 1).cast("bigint").alias("payment_type"),
        F.col("l_tax").alias("airport_fee"),
        F.col("l_discount").alias("congestion_surcharge"),
        F.col("l_linenumber").cast("bigint").alias("_nanos"),
        LANDING_PARTITION,
    )


def stage_landing(spark: SparkSession, sf_dir: str, stage: str) -> tuple[DataFrame, list[str]]:
    """The rows of ``trips_landing`` with their landing file, and the pickup months among them.

    The rows that they derive from are joined and shuffled once and written to ``stage`` by file, so each delivery
    of some months is a scan of these months that nothing needs to be shuffled for.
    """
    rows, months = landing_rows(spark, sf_dir), Observation()
    filed = rows.withColumn("month", F.trunc("pickup", "month")).hint("rebalance", "month").withColumn(
        LANDING_PARTITION, F.concat(F.lit("yellow_tripdata_"), F.date_format("month", "yyyy-MM"), F.lit(".parquet"))).drop("month")
    (filed.observe(months, F.collect_set(F.regexp_extract(LANDING_PARTITION, r"(\d{4}-\d{2})", 1)).alias("m"))
     .write.option("maxRecordsPerFile", STAGED_ROWS).partitionBy(LANDING_PARTITION).parquet(stage))
    return trips_landing(spark.read.schema(filed.schema).parquet(stage)), sorted(months.get["m"] or [])


def odd_month() -> F.Column:
    """Whether a landing file's month is odd (of the partition column alone, so other months are not read)."""
    return F.regexp_extract(LANDING_PARTITION, r"-(\d{2})\.parquet", 1).cast("int") % 2 == 1


def _epoch_nanos(ts_col: str, extra: str) -> F.Column:
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{ts_col}`)")
    return micros * F.lit(1000) + F.col(extra)


def write_driver_landing(spark: SparkSession, sf_dir: str, landing: str) -> list[str]:
    """Write every pickup month of the driver tables as drifting landing files.

    Odd months ("schema A"): INT32 VendorID / location ids / payment type,
    BIGINT passenger_count and RatecodeID, timestamps as INT64 nanoseconds
    since the epoch, ``airport_fee``. Even months ("schema B"): canonical
    widths, DOUBLE passenger_count, microsecond timestamps, ``Airport_fee``
    and an extra ``congestion_surcharge``. Two Spark writes of staged rows; each
    is partitioned by the landing file name. Returns the months written.
    """
    stage = scratch_path(spark, "landing-stage")
    try:
        rows, months = stage_landing(spark, sf_dir, stage)
        for part in _drifting(rows):
            part.write.mode("append").partitionBy(LANDING_PARTITION).parquet(landing)
        return months
    finally:
        remove_path(spark, stage)


def _drifting(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    odd = odd_month()
    schema_a = rows.filter(odd).select(
        F.col("VendorID").cast("int").alias("VendorID"),
        F.col("passenger_count").cast("bigint").alias("passenger_count"),
        "total_amount",
        _epoch_nanos("tpep_pickup_datetime", "_nanos").alias("tpep_pickup_datetime"),
        _epoch_nanos("tpep_dropoff_datetime", "_nanos").alias("tpep_dropoff_datetime"),
        "trip_distance", "store_and_fwd_flag",
        F.col("RatecodeID").cast("bigint").alias("RatecodeID"),
        F.col("PULocationID").cast("int").alias("PULocationID"),
        F.col("DOLocationID").cast("int").alias("DOLocationID"),
        F.col("payment_type").cast("int").alias("payment_type"),
        "airport_fee",
        LANDING_PARTITION,
    )
    schema_b = rows.filter(~odd).select(
        "VendorID", "passenger_count", "total_amount", "tpep_pickup_datetime",
        "tpep_dropoff_datetime", "trip_distance", "store_and_fwd_flag", "RatecodeID",
        "PULocationID", "DOLocationID", "payment_type",
        F.col("airport_fee").alias("Airport_fee"), "congestion_surcharge", LANDING_PARTITION,
    )
    return schema_a, schema_b

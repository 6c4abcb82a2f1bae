"""Drifting landing files written with pyarrow, including real TIMESTAMP(NANOS)."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from paths import SF_SMALL
from pyspark.sql import types as T

from farebox.sources import landing as ld

# 2023-03-12 02:30:00.123456789 wall clock (inside the US spring-forward gap)
GAP_NANOS = 1678588200123456789


@pytest.fixture
def landing_dir(tmp_path):
    # the files sit below a directory that looks like a month, to catch loose matching
    base = tmp_path / "2099-12"
    base.mkdir()
    month_a = pa.table({
        "VendorID": pa.array([1, 2], pa.int32()),
        "passenger_count": pa.array([1, None], pa.int64()),
        "total_amount": pa.array([10.0, 20.0], pa.float64()),
        "tpep_pickup_datetime": pa.array([GAP_NANOS, GAP_NANOS + 60_000_000_000], pa.timestamp("ns")),
        "tpep_dropoff_datetime": pa.array([GAP_NANOS + 600_000_000_000, GAP_NANOS + 900_000_000_000],
                                          pa.timestamp("ns")),
        "PULocationID": pa.array([5, 6], pa.int32()),
        "airport_fee": pa.array([0.0, 1.25], pa.float64()),
    })
    pq.write_table(month_a, base / "yellow_tripdata_2023-03.parquet", version="2.6")
    month_b = pa.table({
        "VendorID": pa.array([6], pa.int64()),
        "passenger_count": pa.array([2.0], pa.float64()),
        "total_amount": pa.array([30.0], pa.float64()),
        "tpep_pickup_datetime": pa.array([dt.datetime(2023, 4, 1, 8, 0)], pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([dt.datetime(2023, 4, 1, 8, 30)], pa.timestamp("us")),
        "PULocationID": pa.array([7], pa.int64()),
        "Airport_fee": pa.array([1.75], pa.float64()),
        "congestion_surcharge": pa.array([2.5], pa.float64()),
    })
    pq.write_table(month_b, base / "yellow_tripdata_2023-04.parquet", version="2.6")
    return str(base)


def test_read_landing_reconciles_drift(spark, landing_dir):
    df = ld.read_landing(spark, landing_dir, ["2023-03", "2023-04"])
    types = {f.name: f.dataType for f in df.schema.fields}
    assert types["VendorID"] == T.LongType()
    assert types["passenger_count"] == T.DoubleType()
    assert types["PULocationID"] == T.LongType()
    assert types["tpep_pickup_datetime"] == T.TimestampNTZType()
    assert "airport_fee" in df.columns and "Airport_fee" not in df.columns
    rows = {r.VendorID: r for r in df.collect()}
    assert rows[1].tpep_pickup_datetime == dt.datetime(2023, 3, 12, 2, 30, 0, 123456)
    assert rows[1].congestion_surcharge is None and rows[6].congestion_surcharge == 2.5
    assert rows[6].airport_fee == 1.75 and rows[2].airport_fee == 1.25
    assert {r._source_month for r in rows.values()} == {"2023-03", "2023-04"}
    assert rows[6]._source_file.endswith("yellow_tripdata_2023-04.parquet")


def test_spring_gap_keeps_the_wall_clock_hour(spark, landing_dir):
    from pyspark.sql import functions as F

    df = ld.read_landing(spark, landing_dir, ["2023-03"])
    hour = df.filter(F.col("VendorID") == 1).select(F.hour("tpep_pickup_datetime")).first()[0]
    assert hour == 2


def test_source_month_is_anchored_on_the_file_name(spark):
    df = spark.createDataFrame(
        [("s3a://b/2099-12/yellow_tripdata_2023-01.parquet",),
         ("/x/2099-12/part-0000.parquet",),
         ("/l/_file=yellow_tripdata_1997-03.parquet/part-0.parquet",)], "p string")
    got = [r[0] for r in df.select(ld.source_month(df.p)).collect()]
    assert got == ["2023-01", "", "1997-03"]


def test_nanos_floor_before_1970(spark):
    df = spark.createDataFrame([(-1500,), (1500,)], "tpep_pickup_datetime bigint")
    got = [r[0] for r in ld.recover_nanos(df).collect()]
    assert got == [dt.datetime(1969, 12, 31, 23, 59, 59, 999998), dt.datetime(1970, 1, 1, 0, 0, 0, 1)]


def test_group_by_schema_groups_identical_files(spark, tmp_path):
    for m in ("2023-01", "2023-02"):
        spark.range(3).write.parquet(str(tmp_path / f"yellow_tripdata_{m}.parquet"))
    spark.range(3).selectExpr("CAST(id AS INT) AS id").write.parquet(
        str(tmp_path / "yellow_tripdata_2023-03.parquet"))
    paths = [ld.landing_path(str(tmp_path), m) for m in ("2023-01", "2023-02", "2023-03")]
    assert [len(g) for g in ld.group_by_schema(spark, paths)] == [2, 1]


def test_a_month_with_two_physical_schemas_reads_whole(spark, landing_dir):
    """Part files of one month differ in width, unit and columns; each is read by its own footer."""
    import os

    month = f"{landing_dir}/yellow_tripdata_2023-05.parquet"
    os.mkdir(month)
    for i, name in enumerate(("2023-03", "2023-04", "2023-03")):
        table = pq.read_table(f"{landing_dir}/yellow_tripdata_{name}.parquet")
        pq.write_table(table, f"{month}/part-0000{i}.parquet", version="2.6")
    months = ["2023-03", "2023-04", "2023-05"]
    groups = ld.group_by_schema(spark, [ld.landing_path(landing_dir, m) for m in months])
    assert sorted(len(g) for g in groups) == [2, 3]
    rows = ld.read_landing(spark, landing_dir, months).collect()
    assert sorted((r._source_month, r.VendorID, r.passenger_count) for r in rows if r.passenger_count) == sorted(
        [("2023-03", 1, 1.0), ("2023-04", 6, 2.0), ("2023-05", 1, 1.0), ("2023-05", 1, 1.0), ("2023-05", 6, 2.0)])
    assert len(rows) == 8 and {r.airport_fee for r in rows} == {0.0, 1.25, 1.75}


def test_footers_are_read_without_a_spark_read(spark, landing_dir, monkeypatch):
    """However many months: none starts a schema inference."""
    import shutil

    paths = []
    for i in range(24):
        paths.append(f"{landing_dir}/yellow_tripdata_20{10 + i}-01.parquet")
        shutil.copy(f"{landing_dir}/yellow_tripdata_2023-0{3 + i % 2}.parquet", paths[-1])
    monkeypatch.setattr(type(spark), "read", property(lambda self: pytest.fail("a Spark read")))
    assert [len(g) for g in ld.group_by_schema(spark, paths)] == [12, 12]


def test_deliveries_are_read_from_one_shuffle(spark):
    """Rows are joined and shuffled once; a delivery of odd months is a scan of them, and Bronze is written as it is read."""
    from farebox.plans.queries_more import _land_canonical
    from farebox.session import scratch_path
    from farebox.sources.driver_tables import LANDING_PARTITION, odd_month, stage_landing

    rows, months = stage_landing(spark, SF_SMALL, scratch_path(spark, "one-shuffle"))
    odd = rows.filter(odd_month())
    assert "Exchange" not in odd._jdf.queryExecution().toString()
    land, bronze = scratch_path(spark, "one-land"), scratch_path(spark, "one-bronze")
    for is_odd in (True, False):
        _land_canonical(rows, land, is_odd)
    read = ld.read_landing(spark, land, months, f"{LANDING_PARTITION}=yellow_tripdata_{{month}}.parquet")
    tasks = read.rdd.getNumPartitions()
    ld.write_bronze(read, bronze)
    written = spark.read.parquet(bronze)
    assert written.count() == rows.count() and written.select("_source_month").distinct().count() == len(months)
    assert len({f.rsplit("/", 1)[1].split("-")[1] for f in written.inputFiles()}) == tasks  # the reading tasks have written

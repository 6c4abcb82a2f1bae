"""Catalog registration and file-arrival streaming."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.config import DateWindow
from farebox.plans.queries_more import canonical_landing_schema
from farebox.session import folders, scratch_path
from farebox.sinks import catalog as cat
from farebox.sinks import keyed
from farebox.streaming import landing_stream as st

DB = "farebox_test"


@pytest.fixture(scope="module", autouse=True)
def database(spark):
    cat.ensure_database(spark, DB)
    cat.ensure_database(spark, DB)  # once more changes nothing


def months_at(spark, path, months):
    spark.createDataFrame([(m * 10.0, m) for m in months], "amount double, trip_month int").write.mode(
        "overwrite").partitionBy("trip_month").parquet(path)
    return path


def test_registered_layer_reads_its_partitions(spark, tmp_path):
    layer = cat.Layer("fares", months_at(spark, str(tmp_path / "fares"), [3, 7]), "the driver's fares")
    name = cat.register(spark, DB, layer)
    assert sorted(spark.sql(f"SELECT trip_month, amount FROM {name}").toPandas().values.tolist()) == [[3, 30], [7, 70]]
    assert cat.partition_columns(spark, name) == ["trip_month"]


def test_registering_again_points_to_the_new_folder(spark, tmp_path):
    for folder, months in (("old", [1]), ("new", [1, 2, 3])):
        name = cat.register(spark, DB, cat.Layer("moved", months_at(spark, str(tmp_path / folder), months)))
        assert spark.table(name).count() == len(months)


def test_a_wrong_folder_keeps_the_earlier_table(spark, tmp_path):
    name = cat.register(spark, DB, cat.Layer("kept", months_at(spark, str(tmp_path / "kept"), [5])))
    with pytest.raises(FileNotFoundError):
        cat.register(spark, DB, cat.Layer("kept", str(tmp_path / "typo")))
    assert spark.table(name).count() == 1


def test_dropping_forgets_the_table_only(spark, tmp_path):
    path = months_at(spark, str(tmp_path / "ext"), [4, 6])
    name = cat.register(spark, DB, cat.Layer("ext", path))
    spark.sql(f"DROP TABLE {name}")
    assert spark.read.parquet(path).count() == 2
    assert "ext" not in {r["name"] for r in cat.show_tables(spark, DB).collect()}


def test_only_missing_folders_are_reported(spark, tmp_path):
    layers = [cat.Layer("here", months_at(spark, str(tmp_path / "here"), [1])), cat.Layer("gone", str(tmp_path / "gone"))]
    got = cat.register_layers(spark, DB, layers)
    assert [tuple(r)[:2] for r in got.collect()] == [("here", "registered"), ("gone", "missing")]
    with pytest.raises(Exception, match="(?i)nosuchformat"):
        cat.register_layers(spark, DB, layers[:1], fmt="nosuchformat")


def test_show_relations_and_counts(spark, tmp_path):
    cat.register(spark, DB, cat.Layer("shown", months_at(spark, str(tmp_path / "shown"), [1, 2])))
    assert "shown" in {r["name"] for r in cat.show_tables(spark, DB).collect()}
    assert DB in {r["database"] for r in cat.show_databases(spark).collect()}
    assert [tuple(r) for r in cat.layer_counts(spark, DB, {"a": "shown"}).collect()] == [("a", 2)]


def test_available_now_stream_is_idempotent(spark):
    land = scratch_path(spark, "t_land")
    bronze, ckpt = scratch_path(spark, "t_bronze"), scratch_path(spark, "t_ckpt")
    schema = T.StructType([T.StructField("VendorID", T.LongType())])
    spark.range(5).withColumnRenamed("id", "VendorID").write.parquet(
        f"{land}/yellow_tripdata_2023-01.parquet")
    assert st.ingest_available(spark, land, bronze, ckpt, schema) == 5
    assert st.ingest_available(spark, land, bronze, ckpt, schema) == 0
    spark.range(3).withColumnRenamed("id", "VendorID").write.parquet(
        f"{land}/yellow_tripdata_2023-02.parquet")
    assert st.ingest_available(spark, land, bronze, ckpt, schema) == 3
    months = sorted(r[0] for r in spark.read.parquet(bronze).select("_source_month").distinct()
                    .collect())
    assert spark.read.parquet(bronze).count() == 8 and months == ["2023-01", "2023-02"]


def test_describe_shows_location_and_partitions(spark, tmp_path):
    path = months_at(spark, str(tmp_path / "d"), [9])
    name = cat.register(spark, DB, cat.Layer("d", path, "described"))
    rows = {r.col_name: r.data_type for r in cat.describe(spark, name).collect()}
    assert rows["Location"].endswith("/d") and rows["Provider"] == "parquet"
    assert rows["Comment"] == "described" and rows["trip_month"] == "int"


def test_rows_of_many_batches_are_all_counted(spark):
    land, bronze, ckpt = (scratch_path(spark, n) for n in ("many_land", "many_bronze", "many_ckpt"))
    schema = T.StructType([T.StructField("VendorID", T.LongType())])
    spark.range(12).select(F.col("id").alias("VendorID"), F.concat(
        F.lit("yellow_tripdata_"), F.date_format(F.add_months(F.lit("2010-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM"),
        F.lit(".parquet")).alias("_f")).repartitionByRange(12, "VendorID").write.partitionBy("_f").parquet(land)
    assert st.ingest_available(spark, land, bronze, ckpt, schema, max_files_per_trigger=1) == 12
    assert spark.read.parquet(bronze).count() == 12


TRIP = (1, 1.0, 10.0, dt.datetime(2023, 1, 3, 10), dt.datetime(2023, 1, 3, 10, 9), 1.0, "N", 1.0, 1, 2, 1, 0.0, None)
WINDOW = DateWindow("2023-01-01", "2023-03-01")


def land_trips(spark, land, name, *trips):
    spark.createDataFrame(list(trips), canonical_landing_schema()).coalesce(1).write.mode("append").parquet(
        f"{land}/yellow_tripdata_{name}.parquet")


def trip(vendor=1, amount=10.0, day=3, month=1, passengers=1.0):
    p = dt.datetime(2023, month, day, 10)
    return (vendor, passengers, amount, p, p + dt.timedelta(minutes=9), *TRIP[5:])


@pytest.mark.parametrize("files", [1, 7, 64])
def test_stream_upsert_is_the_same_at_any_batch_size(spark, files):
    """The last file to arrive wins, also where it lowers an amount."""
    land, root, ckpt = (scratch_path(spark, n) for n in ("su_land", "su_table", "su_ckpt"))
    table = keyed.KeyedTable(DB, root.rsplit("/", 1)[1].replace("-", "_"), root, st.ARRIVAL_SEQUENCE, buckets=2)
    land_trips(spark, land, "2022-12", trip(month=12))  # outside the window: an empty first batch at one file a time
    land_trips(spark, land, "2023-01", trip(amount=10.0), trip(2, 7.0))
    land_trips(spark, land, "2023-02", trip(amount=20.0), trip(1, 5.0, month=2))
    land_trips(spark, land, "2023-03", trip(amount=15.0), trip(2, 7.0))
    schema = canonical_landing_schema()
    assert st.upsert_available(spark, land, table, ckpt, schema, WINDOW, max_files_per_trigger=files) == 6
    assert st.upsert_available(spark, land, table, ckpt, schema, WINDOW) == 0
    got = sorted((r.VendorID, r.trip_month, r.total_amount) for r in keyed.read(spark, table).collect())
    assert got == [(1, 1, 15.0), (1, 2, 5.0), (2, 1, 7.0)]
    done = [r.metrics for r in keyed.history(spark, table).collect()]
    assert sum(m["inserted"] for m in done) == 3 and sum(m["source_rows"] for m in done) == 6
    assert folders(spark, f"{root.rsplit('/', 1)[0]}/merge-*") == []  # stages are gone


def test_a_month_that_is_present_is_not_added_again(spark):
    land, bronze, ckpt = (scratch_path(spark, n) for n in ("led_land", "led_bronze", "led_ckpt"))
    schema = T.StructType([T.StructField("VendorID", T.LongType())])

    def deliver(month, ids, files=1):
        spark.createDataFrame([(i,) for i in ids], "VendorID long").repartition(files).write.mode("append").parquet(
            f"{land}/yellow_tripdata_{month}.parquet")

    deliver("2023-01", range(6), files=3)  # one delivery in several part files and micro-batches
    assert st.ingest_available(spark, land, bronze, ckpt, schema, max_files_per_trigger=1) == 6
    deliver("2023-01", range(50, 53))
    deliver("2023-02", range(10, 12))
    assert st.ingest_available(spark, land, bronze, ckpt, schema) == 2
    deliver("2023-03", [20])
    deliver("2023-03", [30, 31])  # two deliveries of a new month at once: the first one counts
    assert st.ingest_available(spark, land, bronze, ckpt, schema) == 1
    assert sorted(r.VendorID for r in spark.read.parquet(bronze).collect()) == [0, 1, 2, 3, 4, 5, 10, 11, 20]
    ledger = st.read_ledger(spark, f"{bronze}_ledger")
    assert sorted(r.month for r in ledger.collect()) == ["2023-01", "2023-02", "2023-03"]


def test_deliveries_are_told_apart_by_their_write():
    import re

    pattern = r"/part-\d+-([0-9a-f-]{36})[^/]*$"
    one, two = "0123abcd-0123-4567-89ab-0123456789ab", "9123abcd-0123-4567-89ab-0123456789ab"
    paths = [f"/x/m.parquet/part-00000-{one}-c000.snappy.parquet", f"/x/m.parquet/part-00017-{one}.c000.parquet",
             f"/x/m.parquet/part-00000-{two}-c000.snappy.parquet", "/x/m.parquet"]
    found = [re.sub(pattern, r"/\1", p) for p in paths]
    assert found[0] == found[1] != found[2] and found[3] == paths[3]

"""Upsert, change sets, snapshots, partition overwrite modes."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import re

import pytest
from pyspark.sql import functions as F

from farebox.config import DEFAULT_COLUMNS as C
from farebox.operators import merge as mg
from farebox.operators import quality as dq
from farebox.operators import snapshots as snap
from farebox.session import scratch_path
from farebox.sinks.layout import write_partitioned

KEYS = C.natural_key
SCHEMA = ("VendorID int, passenger_count int, total_amount double, "
          "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
          "trip_month int, pickup_hour int")


def trip(v, amount, month, day=1, hour=8):
    p = dt.datetime(2023, month, day, hour)
    return (v, 1, amount, p, p + dt.timedelta(minutes=20), month, hour)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([trip(1, 10.0, 1), trip(2, 20.0, 1), trip(1, 30.0, 2)], SCHEMA)


@pytest.fixture
def source(spark):
    return spark.createDataFrame([trip(2, 21.0, 1), trip(6, 40.0, 2)], SCHEMA)


def amounts(df):
    return sorted((r.VendorID, r.trip_month, r.total_amount) for r in df.collect())


def test_upsert_updates_and_inserts(target, source):
    out = mg.upsert(target, source, KEYS, C.month)
    assert amounts(out) == [(1, 1, 10.0), (1, 2, 30.0), (2, 1, 21.0), (6, 2, 40.0)]


def test_upsert_is_idempotent(target, source):
    once = mg.upsert(target, source, KEYS, C.month)
    twice = mg.upsert(once, source, KEYS, C.month)
    assert amounts(once) == amounts(twice)


def test_merge_metrics(target, source):
    m = mg.merge_metrics(target, source, KEYS, C.month).first()
    assert (m.inserted, m.updated, m.deleted, m.source_rows) == (1, 1, 0, 2)


def test_unique_source_rule(spark, target):
    dup = spark.createDataFrame([trip(2, 21.0, 1), trip(2, 22.0, 1)], SCHEMA)
    assert dq.duplicate_keys(dup, KEYS).first()["duplicated_keys"] == 1
    kept = mg.dedup_by_key(dup, [*KEYS, C.month], [F.col(C.amount)])
    assert amounts(kept) == [(2, 1, 22.0)]


def test_change_set_replays(target, source):
    new = mg.upsert(target, source, KEYS, C.month)
    changes = mg.change_set(target, new, [*KEYS, C.month])
    kinds = sorted(r["_change_type"] for r in changes.collect())
    assert kinds == ["insert", "update_postimage", "update_preimage"]
    assert amounts(mg.apply_change_set(target, changes, [*KEYS, C.month])) == amounts(new)


def test_static_vs_dynamic_overwrite(spark, target):
    dyn, sta = scratch_path(spark, "dyn"), scratch_path(spark, "sta")
    for path in (dyn, sta):
        write_partitioned(target, path, [C.month])
    month1 = target.filter(F.col(C.month) == 1).withColumn(C.amount, F.lit(0.0))
    write_partitioned(month1, dyn, [C.month], dynamic=True)
    write_partitioned(month1, sta, [C.month], dynamic=False)
    assert sorted({r.trip_month for r in spark.read.parquet(dyn).collect()}) == [1, 2]
    assert sorted({r.trip_month for r in spark.read.parquet(sta).collect()}) == [1]


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_versions_are_read_by_partition(spark, target, source):
    path = scratch_path(spark, "snap")
    log_path = f"{path}-history"
    assert snap.history(spark, log_path).count() == 0
    snap.write_snapshot(target, path, 0, history_path=log_path)
    snap.write_snapshot(mg.upsert(target, source, KEYS, C.month), path, 1, history_path=log_path, operation="MERGE")
    rows, log = spark.read.parquet(path), snap.history(spark, log_path)
    assert amounts(snap.as_of_version(rows, 0)) == amounts(target)
    assert re.search(r"PartitionFilters: \[[^\]]*snapshot#\d+ = 0", plan_of(snap.as_of_version(rows, 0)))
    times = [dt.datetime.fromtimestamp(r["t"] / 1e6, dt.timezone.utc) for r in log.selectExpr(
        "version", "unix_micros(committed_at) AS t").orderBy("version").collect()]
    york, micro = dt.timezone(dt.timedelta(hours=-5)), dt.timedelta(microseconds=1)
    assert snap.version_at(log, times[1].astimezone(york)) == 1
    assert snap.version_at(log, (times[1] - micro).astimezone(york)) == 0
    assert amounts(snap.as_of_time(rows, log, times[0])) == amounts(target)
    for bad in (times[0].replace(tzinfo=None), times[0] - micro):
        with pytest.raises(ValueError):
            snap.as_of_time(rows, log, bad)
    assert [(r.version, r.operation) for r in snap.newest(log, 1).collect()] == [(1, "MERGE")]
    got = {r.version: (r["rows"], r["months"], r["nothing"]) for r in snap.metric_columns(log, ["rows", "months", "nothing"]).collect()}
    assert got == {0: (3, 2, 0), 1: (4, 2, 0)}
    assert {r.user for r in log.collect()} == {spark.sql("SELECT current_user()").first()[0]}


def test_change_set_refuses_a_doubled_key(spark, target):
    twice = target.unionByName(target)
    with pytest.raises(Exception, match="more than once"):
        mg.change_set(target, twice, [*KEYS, C.month]).collect()


def test_watermark_filter_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "bronze")
    spark.range(10).selectExpr(
        "id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS ts"
    ).write.parquet(path)
    df = spark.read.parquet(path)
    mark = mg.read_watermark(mg.advance_watermark(df.filter("id < 4"), "ts"))
    out = mg.since_watermark(df, "ts", mark)
    assert sorted(r.id for r in out.collect()) == [4, 5, 6, 7, 8, 9]
    assert "GreaterThan(ts,2024-01-01T03:00" in plan_of(out)
    assert mg.since_watermark(df, "ts", None).count() == 10

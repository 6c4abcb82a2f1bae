from __future__ import annotations

import pyspark.sql.types as T

from farebox.config import DateWindow
from farebox.operators import cleaning as cl


def test_projection_keeps_only_required(raw_df):
    out = cl.select_required(raw_df)
    assert out.columns == ["VendorID", "passenger_count", "total_amount",
                           "tpep_pickup_datetime", "tpep_dropoff_datetime"]


def test_cast_types_contract(raw_df):
    out = cl.cast_types(cl.select_required(raw_df))
    types = {f.name: type(f.dataType) for f in out.schema.fields}
    assert types == {
        "VendorID": T.IntegerType, "passenger_count": T.IntegerType,
        "total_amount": T.DoubleType, "tpep_pickup_datetime": T.TimestampNTZType,
        "tpep_dropoff_datetime": T.TimestampNTZType,
    }


def test_dirty_rows_clean_to_three(raw_df):
    out = cl.to_silver(raw_df)
    rows = sorted(out.collect(), key=lambda r: r.tpep_pickup_datetime)
    assert [(r.VendorID, r.total_amount) for r in rows] == [(6, 12.75), (1, 31.5), (2, 8.0)]


def test_dedup_removes_exact_copies(raw_df):
    assert cl.dedup_exact(raw_df).count() == 8


def test_derived_month_and_hour(raw_df):
    out = cl.to_silver(raw_df)
    got = sorted((r.trip_month, r.pickup_hour) for r in out.collect())
    assert got == [(2, 23), (3, 6), (4, 21)]
    assert out.schema["trip_month"].dataType == T.IntegerType()


def test_custom_window(raw_df):
    out = cl.to_silver(raw_df, DateWindow("2023-02-01", "2023-03-01"))
    assert out.count() == 1


def test_edge_rows(edge_df):
    out = cl.to_silver(edge_df)
    got = sorted((r.VendorID, r.passenger_count, r.total_amount) for r in out.collect())
    # NaN amount, 0.5 / NaN passengers, window end and dropoff == pickup are gone;
    # 1.7 truncates to 1; the window start is kept; two amounts of one key both stay
    assert got == [(1, 1, 11.0), (2, 2, 13.0), (6, 1, 16.0), (6, 1, 17.0)]


def test_raw_prefilter_reaches_the_scan(spark, tmp_path, edge_df):
    path = str(tmp_path / "raw")
    edge_df.write.parquet(path)
    plan = explain(cl.to_silver(spark.read.parquet(path)))
    assert "GreaterThanOrEqual(passenger_count,1.0)" in plan
    assert "GreaterThan(total_amount,0.0)" in plan
    assert "LessThan(tpep_pickup_datetime" in plan


def explain(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_month_filter_and_window_helpers():
    w = DateWindow.from_months(["2023-01", "2023-02", "2023-03", "2023-04", "2023-05"])
    assert (w.start, w.end) == ("2023-01-01", "2023-06-01")
    assert DateWindow.from_months(["2023-05"]) == DateWindow("2023-05-01", "2023-06-01")
    assert DateWindow.from_months(["2023-11", "2023-12"]) == DateWindow("2023-11-01", "2024-01-01")
    assert DateWindow.from_months(["2023-03", "2023-01", "2023-02"]) == DateWindow(
        "2023-01-01", "2023-04-01")
    assert w.single_year and w.months_in_window() == [1, 2, 3, 4, 5]
    assert DateWindow("2023-11-01", "2024-01-01").months_in_window() == [11, 12]


def test_window_from_months_relation(spark):
    import datetime as dt

    months = spark.createDataFrame([("2023-12",), ("2023-11",)], "month string")
    row = cl.window_from_months(months).first()
    assert (row.window_start, row.window_end) == (dt.date(2023, 11, 1), dt.date(2024, 1, 1))


def test_cluster_settings_follow_the_shuffled_bytes():
    from farebox.session import MOST_SHUFFLE_PARTITIONS, cluster_settings

    def width(*a, **k):
        return int(cluster_settings(*a, **k)["spark.sql.shuffle.partitions"])

    assert width(10 * 1024**3, 8) == 16
    assert width(100 * 1024**4, 8000, shuffled_bytes=3 * 1024**4) == 16_000
    assert width(100 * 1024**4, 8000, shuffled_bytes=4 * 1024**4) == 16_384
    assert width(100 * 1024**4, 8000) == MOST_SHUFFLE_PARTITIONS
    assert cluster_settings(1, 1)["spark.sql.adaptive.skewJoin.enabled"] == "true"


class Fake:
    """As much of a session as the folder rules look at."""

    def __init__(self, master, named=None):
        self.master, self.dir, self.sparkContext = master, None, self
        self.conf = self
        self.named = named

    def get(self, key, default=None):
        return self.named if key == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


def test_checkpoint_folder_rules(tmp_path):
    import pytest

    from farebox.session import checkpoint_root

    assert checkpoint_root(Fake("spark://host:7077", "hdfs:///shared/")) == "hdfs:///shared"
    assert checkpoint_root(Fake("local[2]", str(tmp_path))) == str(tmp_path)
    own = Fake("local[2]")
    assert checkpoint_root(own) == checkpoint_root(own)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_root(Fake(master))

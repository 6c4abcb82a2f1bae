"""End-to-end layer jobs on the smallest driver tables."""

from __future__ import annotations

import contextlib
import io
import os
import re

import pytest
from pyspark.sql import functions as F

from farebox.config import DateWindow
from farebox.operators.quality import DataQualityError
from farebox.plans import jobs
from farebox.session import scratch_path
from farebox.sinks import catalog as cat
from farebox.sources.driver_tables import DRIVER_LANDING_TEMPLATE, DRIVER_WINDOW, write_driver_landing

from paths import SF_SMALL


def explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def layers(spark):
    land, bronze = scratch_path(spark, "j_land"), scratch_path(spark, "j_bronze")
    silver, gold = scratch_path(spark, "j_silver"), scratch_path(spark, "j_gold")
    months = write_driver_landing(spark, SF_SMALL, land)
    jobs.bronze_job(spark, land, months, bronze, DRIVER_LANDING_TEMPLATE)
    results = jobs.silver_job(spark, bronze, silver, DRIVER_WINDOW)
    paths = jobs.gold_job(spark, silver, gold)
    return {"bronze": bronze, "silver": silver, "gold": gold, "paths": paths, "results": results}


def test_silver_gate_passed_and_rows_match(spark, layers):
    from farebox.plans.inputs import silver

    assert all(o.ok for o in layers["results"])
    written = spark.read.parquet(layers["silver"])
    assert written.count() == silver(spark, SF_SMALL).count()


def test_one_file_per_silver_month(layers):
    root = layers["silver"].removeprefix("file:")
    months = [d for d in os.listdir(root) if d.startswith("trip_month=")]
    assert sorted(months) == [f"trip_month={m}" for m in range(1, 6)]
    for d in months:
        files = [f for f in os.listdir(os.path.join(root, d)) if f.endswith(".parquet")]
        assert len(files) == 1


def test_month_partition_pruning(spark, layers):
    df = jobs.read_silver(spark, layers["silver"], DateWindow("1997-03-01", "1997-05-01"))
    plan = explain(df)
    assert re.search(r"PartitionFilters: \[.*trip_month#\d+ IN \(3,4\)", plan)
    assert sorted(r[0] for r in df.select("trip_month").distinct().collect()) == [3, 4]
    q2 = spark.read.parquet(layers["silver"]).filter(F.col("trip_month") == 5)
    assert "PartitionFilters" in explain(q2)


def test_gold_tables(spark, layers):
    q1 = spark.read.parquet(layers["paths"]["agg_receita_mensal"])
    assert [r.trip_month for r in q1.collect()] == [1, 2, 3, 4, 5]
    from farebox.operators.aggregates import hourly_passengers, monthly_revenue

    silver = spark.read.parquet(layers["silver"])
    q2 = spark.read.parquet(layers["paths"]["agg_passageiros_hora_maio"])
    assert sorted(map(tuple, q2.collect())) == sorted(map(tuple, hourly_passengers(silver).collect()))
    assert sorted(map(tuple, q1.collect())) == sorted(map(tuple, monthly_revenue(silver).collect()))
    fact = spark.read.parquet(layers["paths"]["trips"])
    assert fact.count() == spark.read.parquet(layers["silver"]).count()


def test_register_all_layers(spark, layers):
    report = cat.register_layers(spark, "farebox_jobs", cat.layers_of(
        layers["bronze"], layers["silver"], layers["gold"]))
    assert {r.status for r in report.collect()} == {"registered"}
    n = spark.sql("SELECT COUNT(*) FROM farebox_jobs.silver_trips").first()[0]
    assert n == spark.read.parquet(layers["silver"]).count()
    rows = spark.sql("""
        SELECT 'bronze' AS camada, COUNT(*) AS linhas FROM farebox_jobs.bronze_trips
        UNION ALL SELECT 'silver', COUNT(*) FROM farebox_jobs.silver_trips
        UNION ALL SELECT 'gold_trips', COUNT(*) FROM farebox_jobs.gold_trips""").collect()
    assert rows[0].linhas > rows[1].linhas == rows[2].linhas


def test_gate_blocks_the_write(spark, layers):
    bad = jobs.read_silver(spark, layers["silver"]).withColumn("total_amount", F.lit(-1.0))
    target = scratch_path(spark, "j_blocked")
    from farebox.sinks.layout import write_silver

    with pytest.raises(DataQualityError):
        write_silver(bad, target)
    from farebox.session import path_exists

    assert not path_exists(spark, target)


def test_silver_publish_repoints_the_catalog_only_after_success(spark, layers):
    root = scratch_path(spark, "j_pub")
    first = jobs.silver_publish_job(spark, layers["bronze"], root, DRIVER_WINDOW, "farebox_pub")
    n = spark.read.parquet(layers["silver"]).count()
    assert spark.table("farebox_pub.silver_trips").count() == n
    # a refresh that fails its gate leaves the published table untouched
    bad_bronze = scratch_path(spark, "j_bad_bronze")
    spark.read.parquet(layers["bronze"]).limit(0).write.parquet(bad_bronze)
    with pytest.raises(DataQualityError):
        jobs.silver_publish_job(spark, bad_bronze, root, DRIVER_WINDOW, "farebox_pub")
    assert spark.table("farebox_pub.silver_trips").count() == n
    location = spark.sql("DESCRIBE TABLE EXTENDED farebox_pub.silver_trips").filter(
        "col_name = 'Location'").first().data_type
    assert location.endswith(first.split("/")[-1])

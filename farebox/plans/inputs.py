"""Inputs shared by the registered queries: Silver of the driver window and
the typed raw rows, built from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farebox.operators import aggregates as agg
from farebox.operators import cleaning as cl
from farebox.sources.driver_tables import DRIVER_WINDOW, trips_raw

W = DRIVER_WINDOW


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver trips of the driver window (scan predicates derived from the window)."""
    return cl.to_silver(trips_raw(spark, sf_dir, prune_for=W), W)


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.cast_types(cl.select_required(trips_raw(spark, sf_dir)))


def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.filter_not_null(typed(spark, sf_dir))


def q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.monthly_revenue(silver(spark, sf_dir))


def q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.hourly_passengers(silver(spark, sf_dir), month=5)

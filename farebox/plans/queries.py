"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (through the ``trips_raw`` adapter) or
data Spark derives from them, over the whole tables. Sink queries write to a
fresh folder below the cluster's shared checkpoint folder and return the
re-read rows, so they can be checked like any other query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.config import DEFAULT_COLUMNS as C
from farebox.config import MEAN, MEDIAN, MONTH_ALIAS
from farebox.functions.columns import month_label, year_month
from farebox.operators import aggregates as agg
from farebox.operators import cleaning as cl
from farebox.plans.inputs import W, not_null, q1, q2, silver, typed
from farebox.plans.queries_more import (
    documents_queries,
    incremental_queries,
    landing_queries,
    quality_queries,
    sink_queries,
    snapshot_queries,
    streaming_queries,
)
from farebox.session import scratch_path
from farebox.sources.driver_tables import trips_raw

Query = Callable[[SparkSession, str], DataFrame]


# --- P: projections, filters, dedup ------------------------------------------

def _cleaning() -> dict[str, Query]:
    return {
        "project_required": lambda s, d: cl.select_required(trips_raw(s, d)),
        "cast_types": typed,
        "filter_not_null": not_null,
        "filter_positive_amount": lambda s, d: cl.filter_positive_amount(not_null(s, d)),
        "filter_positive_passengers": lambda s, d: cl.filter_positive_passengers(not_null(s, d)),
        "filter_chronology": lambda s, d: cl.filter_chronology(not_null(s, d)),
        "filter_date_window": lambda s, d: cl.filter_date_window(not_null(s, d), W),
        "dedup_exact": lambda s, d: cl.dedup_exact(typed(s, d)),
        "derive_month_hour": lambda s, d: cl.derive_month_hour(not_null(s, d)),
        "silver_trips": silver,
        "window_from_months": lambda s, d: cl.window_from_months(
            trips_raw(s, d).select(year_month(F.col(C.pickup)).alias("month")).distinct()
        ),
        "month_label": lambda s, d: (
            cl.derive_month_hour(not_null(s, d))
            .select(C.month)
            .distinct()
            .select(C.month, month_label(F.col(C.month)).alias(MONTH_ALIAS))
        ),
    }


# --- A: aggregates and derived KPIs ------------------------------------------

def _api_sql_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = silver(spark, sf_dir)
    api = agg.monthly_revenue(s)
    sql = agg.monthly_revenue_sql(spark, s, view="silver_trips_eq")
    return agg.bag_equality(api, sql)


def _quantiles_within_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each approximate quantile's true rank lies within the stated error of the wanted one."""
    s = silver(spark, sf_dir)
    return _ranks_within(s, agg.quantiles_approx(s).first(), 0.001)


def _ranks_within(s: DataFrame, found, error: float) -> DataFrame:
    amount = F.col(C.amount)

    def within(name: str, p: float):
        low, high = F.count_if(amount < found[name]), F.count_if(amount <= found[name])
        slack = F.lit(error) * F.count(F.lit(1)) + 1
        wanted = F.lit(p) * F.count(F.lit(1))
        return ((low <= wanted + slack) & (high >= wanted - slack)).alias(f"{name}_within")

    return s.agg(*[within(n, p) for n, p in zip(agg.QUANTILE_NAMES, agg.QUANTILE_PROBS)])


def _stored_sketches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Silver, and a sketch per month read back from a table."""
    s, path = silver(spark, sf_dir), scratch_path(spark, "sketches")
    agg.monthly_sketches(s).write.parquet(path)
    return s, spark.read.parquet(path)


def _quantiles_of_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the quantiles merged from the stored months have ranks within the sketches' error."""
    s, sketches = _stored_sketches(spark, sf_dir)
    found = agg.quantiles_of_sketches(sketches).first()
    return _ranks_within(s, found, 0.005)


def _tail_distortion_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 from stored sketches: the mean, and whether the median's rank is within the sketches' error."""
    s, sketches = _stored_sketches(spark, sf_dir)
    by_month = agg.tail_distortion_of_sketches(sketches)
    met = s.join(by_month, F.col(C.month) == F.col(MONTH_ALIAS))
    amount, median = F.round(C.amount, 2), F.col(MEDIAN)
    wanted, slack = F.count(F.lit(1)) * 0.5, F.count(F.lit(1)) * 0.005 + 1
    return met.groupBy(MONTH_ALIAS, MEAN).agg(
        ((F.count_if(amount < median) <= wanted + slack) & (F.count_if(amount <= median) >= wanted - slack)).alias("median_within"))


def _aggregates() -> dict[str, Query]:
    return {
        "monthly_revenue": q1,
        "monthly_revenue_sql": lambda s, d: agg.monthly_revenue_sql(s, silver(s, d)),
        "api_sql_equivalence": _api_sql_equivalence,
        "global_avg_amount": lambda s, d: agg.global_avg_amount(silver(s, d)),
        "mean_of_monthly_means": lambda s, d: agg.mean_of_monthly_means(q1(s, d)),
        "hourly_passengers": q2,
        "hourly_passengers_sql": lambda s, d: agg.hourly_passengers_sql(s, silver(s, d), month=5),
        "trips_per_month": lambda s, d: agg.trips_per_month(silver(s, d)),
        "profile_ranges": lambda s, d: agg.profile_ranges(silver(s, d)),
        "quantiles_approx": _quantiles_within_error,
        "quantiles_stored_sketches": _quantiles_of_sketches,
        "tail_distortion_sketches": _tail_distortion_sketches,
        "quantiles_exact": lambda s, d: agg.quantiles_exact(silver(s, d)),
        "tail_distortion": lambda s, d: agg.tail_distortion(silver(s, d)),
        "weekday_occupancy": lambda s, d: agg.weekday_occupancy(silver(s, d), month=5),
        "vendor_profile": lambda s, d: agg.vendor_profile(silver(s, d)),
        "total_trips": lambda s, d: agg.total_trips(q1(s, d)),
        "peak_month": lambda s, d: agg.peak_month(q1(s, d)),
        "peak_low_hour": lambda s, d: agg.peak_low_hour(q2(s, d)),
        "weighted_passengers": lambda s, d: agg.weighted_passengers(q2(s, d)),
        "growth_first_last": lambda s, d: agg.growth_first_last(q1(s, d)),
        "demand_intensity": lambda s, d: agg.demand_intensity(q2(s, d)),
        "kpi_snapshot": lambda s, d: agg.kpi_snapshot(silver(s, d)),
    }




def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for part in (_cleaning, _aggregates, quality_queries, incremental_queries, snapshot_queries,
                 sink_queries, landing_queries, documents_queries, streaming_queries):
        out.update(part())
    return out

"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import contextlib
import io
import re

from paths import SF_SMALL

import __spark_entry__ as E


def plan_of(spark, name) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        E.queries()[name](spark, SF_SMALL).explain("formatted")
    return buf.getvalue()


def tree(plan: str) -> str:
    return plan.split("\n\n")[0]


def test_silver_prunes_columns_and_pushes_filters(spark):
    plan = plan_of(spark, "silver_trips")
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    lineitem = next(s for s in schemas if "l_orderkey" in s)
    for unused in ("l_partkey", "l_linenumber", "l_discount", "l_tax", "l_linestatus",
                   "l_returnflag"):
        assert unused not in lineitem
    assert "GreaterThan(l_shipdate,1997-01-01" in plan
    assert re.search(r"GreaterThanOrEqual\(o_orderdate,1996-12-31", plan)


def test_dedup_combines_map_side(spark):
    for name in ("silver_trips", "discard_rate"):
        t = tree(plan_of(spark, name))
        # final aggregate above the shuffle, partial aggregate below it
        assert re.search(r"HashAggregate[^\n]*\n\s*\+- Exchange[^\n]*\n\s*\+- HashAggregate", t), name


def test_kpi_document_stays_on_hash_aggregation(spark):
    t = tree(plan_of(spark, "kpi_document"))
    assert "SortAggregate" not in t and "Expand" in t


def test_upsert_is_an_anti_join_without_cross_products(spark):
    t = tree(plan_of(spark, "merge_upsert"))
    assert "LeftAnti" in t
    assert "CartesianProduct" not in t and "BroadcastNestedLoopJoin" not in t


def test_no_query_plans_a_cross_product(spark):
    for name in ("change_set", "discard_rate", "dq_report", "api_sql_equivalence", "layer_counts",
                 "kpi_snapshot", "demand_intensity", "peak_low_hour"):
        t = tree(plan_of(spark, name))
        assert "CartesianProduct" not in t and "BroadcastNestedLoopJoin" not in t, name


def test_sql_over_the_catalog_table_prunes_months(spark):
    plan = plan_of(spark, "catalog_sql_hourly")
    assert re.search(r"PartitionFilters: \[[^\]]*trip_month#\d+ = 5", plan)

"""The expected figures of FIXTURES.md §6 (driver tables at sf0.01)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from paths import SF_ORACLE
from farebox.config import DEFAULT_COLUMNS as C
from farebox.operators import aggregates as agg
from farebox.operators import merge as mg
from farebox.operators import quality as dq
from farebox.plans.inputs import silver, typed
from farebox.plans.queries_more import upsert_scenario
from farebox.sources.driver_tables import table, trips_raw


@pytest.fixture(scope="module")
def s(spark):
    return silver(spark, SF_ORACLE).cache()


def test_raw_counts(spark):
    raw = trips_raw(spark, SF_ORACLE)
    assert raw.count() == 61176
    assert raw.distinct().count() == 60000
    m = dq.metrics_row(typed(spark, SF_ORACLE)).first()
    assert m.rows_seen - m.missing_passenger_count == 59945
    assert (m.amount_not_positive, m.passengers_not_positive, m.dropoff_not_after) == (662, 1167, 29801)


def test_silver_and_q1(s):
    assert s.count() == 2379
    rows = [(r.trip_month, r.qtd_corridas, r.receita_media_usd, r.receita_total_usd)
            for r in agg.monthly_revenue(s).collect()]
    assert rows == [
        (1, 445, 52299.30, 23273187.63), (2, 541, 52409.80, 28353702.90),
        (3, 427, 51666.03, 22061394.77), (4, 474, 52833.17, 25042921.32),
        (5, 492, 49523.83, 24365723.78),
    ]


def test_q2_peak_and_keys(s):
    q2 = agg.hourly_passengers(s, month=5).collect()
    assert len(q2) == 24
    assert (q2[0].pickup_hour, q2[0].qtd_corridas, q2[0].media_passageiros) == (0, 13, 26.308)
    assert agg.peak_month(agg.monthly_revenue(s)).first().mes_num == 4
    assert dq.duplicate_keys(s, C.natural_key).first().duplicated_keys == 0


def test_upsert_split(spark, s):
    target, source = upsert_scenario(spark, SF_ORACLE)
    m = mg.merge_metrics(target, source, C.natural_key, C.month).first()
    cls = F.pmod(F.col(C.vendor), F.lit(3))
    assert m.inserted == s.filter(cls == 2).count()
    assert m.updated == s.filter(cls == 1).count()
    assert m.deleted == 0


def test_lineitem_duplicated_keys(spark):
    row = dq.duplicate_keys(table(spark, SF_ORACLE, "lineitem"), ["l_orderkey", "l_linenumber"])
    assert row.first().duplicated_keys == 11785

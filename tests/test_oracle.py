"""Registered queries vs their DuckDB oracle SQL on the smallest tables.

The full set is compared by ``scripts/check_oracle.py`` (and by the driver at
sf0.01); here a cross-section of read-only queries keeps the registry honest.
"""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from paths import SF_SMALL

SUBSET = [
    "silver_trips", "dedup_exact", "monthly_revenue", "hourly_passengers_sql", "weekday_occupancy",
    "peak_low_hour", "discard_rate", "dq_report", "merge_upsert", "change_set", "kpi_document",
    "quantiles_exact", "window_from_months", "catalog_sql_scan", "kpi_json_roundtrip",
]


def test_every_oracle_belongs_to_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 70


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("lineitem", "orders"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())

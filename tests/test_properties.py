"""Brute-force comparisons on generated fixtures."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from farebox.config import DateWindow
from farebox.operators import aggregates as agg
from farebox.operators import cleaning as cl

WINDOW = DateWindow("2023-01-01", "2023-03-01")
BASE = dt.datetime(2022, 12, 25)

trip = st.tuples(
    st.one_of(st.none(), st.integers(1, 3)),
    st.one_of(st.none(), st.sampled_from([0.0, 0.5, 1.0, 1.7, 2.0, 6.0, float("nan")])),
    st.one_of(st.none(), st.sampled_from([-5.0, 0.0, 10.0, 12.5, float("nan")])),
    st.integers(0, 24 * 80),   # pickup offset in hours from BASE
    st.integers(-3, 3),        # dropoff - pickup in hours
)


def expected_silver(rows):
    """The cleaning rules written directly in Python."""
    out = set()
    start, end = dt.datetime(2023, 1, 1), dt.datetime(2023, 3, 1)
    for vendor, pax, amount, off, dur in rows:
        pickup = BASE + dt.timedelta(hours=off)
        dropoff = pickup + dt.timedelta(hours=dur)
        if vendor is None or pax is None or amount is None:
            continue
        if math.isnan(pax) or math.isnan(amount):
            continue
        pax_int = int(pax)  # truncation
        if amount <= 0 or pax_int <= 0 or dropoff <= pickup:
            continue
        if not (start <= pickup < end):
            continue
        out.add((vendor, pax_int, amount, pickup, dropoff, pickup.month, pickup.hour))
    return sorted(out)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(trip, min_size=0, max_size=40))
def test_to_silver_matches_brute_force(spark, rows):
    data = []
    for vendor, pax, amount, off, dur in rows:
        pickup = BASE + dt.timedelta(hours=off)
        data.append((vendor, pax, amount, pickup, pickup + dt.timedelta(hours=dur)))
    data += data[: len(data) // 3]  # exact copies
    df = spark.createDataFrame(
        data, "VendorID bigint, passenger_count double, total_amount double, "
              "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz")
    got = sorted(tuple(r) for r in cl.to_silver(df, WINDOW).collect())
    assert got == expected_silver(rows)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=300))
def test_quantiles_exact_matches_numpy(spark, values):
    hot = [7] * (len(values) // 2 + 1)  # one value holds a third or more of all rows
    data = [(float(v),) for v in values + hot]
    df = spark.createDataFrame(data, "total_amount double")
    row = agg.quantiles_exact(df).first()
    arr = np.array([d[0] for d in data])
    for p, name in zip(agg.QUANTILE_PROBS, agg.QUANTILE_NAMES):
        assert row[name] == round(float(np.quantile(arr, p)), 4)


def _frame(spark, rows):
    data = []
    for vendor, pax, amount, off, dur in rows:
        pickup = BASE + dt.timedelta(hours=off)
        data.append((vendor, pax, amount, pickup, pickup + dt.timedelta(hours=dur)))
    return spark.createDataFrame(
        data, "VendorID bigint, passenger_count double, total_amount double, "
              "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz")


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(trip, min_size=1, max_size=40))
def test_discard_profile_matches_brute_force(spark, rows):
    from farebox.operators.quality import discard_profile

    typed = cl.cast_types(cl.select_required(_frame(spark, rows)))
    got = discard_profile(typed, WINDOW).first()
    assert got.linhas_landing == len(rows)
    assert got.linhas_silver == len(expected_silver(rows))
    dropped = (got.descartadas_nulos + got.descartadas_valor + got.descartadas_passageiros
               + got.descartadas_cronologia + got.descartadas_janela + got.descartadas_duplicadas)
    assert dropped == got.linhas_landing - got.linhas_silver


keyed = st.dictionaries(st.integers(0, 30), st.integers(0, 5), max_size=20)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(keyed, keyed)
def test_upsert_and_change_set_match_dict_semantics(spark, old, new_rows):
    from farebox.operators import merge as mg

    schema = "k bigint, m int, v bigint"
    t = spark.createDataFrame([(k, k % 3, v) for k, v in old.items()], schema)
    s = spark.createDataFrame([(k, k % 3, v + 100) for k, v in new_rows.items()], schema)
    merged = dict(old)
    merged.update({k: v + 100 for k, v in new_rows.items()})
    out = mg.upsert(t, s, ["k"], "m")
    assert sorted((r.k, r.v) for r in out.collect()) == sorted(merged.items())
    m = mg.merge_metrics(t, s, ["k"], "m").first()
    assert (m.inserted, m.updated) == (len(set(new_rows) - set(old)), len(set(new_rows) & set(old)))
    changes = mg.change_set(t, out, ["k", "m"])
    replay = mg.apply_change_set(t, changes, ["k", "m"])
    assert sorted((r.k, r.v) for r in replay.collect()) == sorted(merged.items())

"""Keyed tables: merges by sequence, change feed, history, signed Gold, publishing."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from farebox.config import DEFAULT_COLUMNS as C
from farebox.config import TripColumns
from farebox.operators import aggregates as agg
from farebox.operators import merge as mg
from farebox.operators import quality as dq
from farebox.operators.cleaning import YEAR_MONTH_COL, derive_year_month
from farebox.operators.quality import DataQualityError
from farebox.plans import jobs
from farebox.session import folders, scratch_path
from farebox.sinks import keyed

KEYS = C.natural_key
SCHEMA = ("VendorID int, passenger_count int, total_amount double, "
          "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
          "trip_month int, pickup_hour int, seq int, gone boolean")
DB = "farebox_keyed_test"


def trip(v, amount, month, seq=0, gone=False, day=1, hour=8):
    p = dt.datetime(2023, month, day, hour)
    return (v, 1, amount, p, p + dt.timedelta(minutes=20), month, hour, seq, gone)


@pytest.fixture
def make(spark):
    """A new table, and a function that merges rows into it."""
    def new(**how):
        root = scratch_path(spark, "keyed")
        t = keyed.KeyedTable(DB, root.rsplit("/", 1)[1].replace("-", "_"), root, **({"sequence": ("seq",), "buckets": 4} | how))

        def merge(rows, **how):
            return keyed.merge(spark, t, spark.createDataFrame(rows, SCHEMA), deleted="gone", **how)
        return t, merge
    return new


def amounts(df):
    return sorted((r.VendorID, r.trip_month, r.total_amount) for r in df.collect())


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


BASE = [trip(1, 10.0, 1), trip(2, 20.0, 1), trip(1, 30.0, 2)]


def test_first_load_correction_rerun_and_empty_batch(spark, make):
    t, merge = make()
    assert merge(BASE[:0]) == keyed.NOTHING
    assert merge(BASE)["inserted"] == 3
    lowered = [trip(2, 19.0, 1, 1), trip(6, 40.0, 2, 1)]
    m = merge(lowered)
    assert (m["inserted"], m["updated"], m["changed"], m["stale"], m["source_rows"]) == (1, 1, 1, 0, 2)
    m = merge(lowered)  # updates are unconditional
    assert (m["inserted"], m["updated"], m["changed"], m["stale"]) == (0, 2, 0, 0)
    m = merge([trip(2, 99.0, 1, 0)])  # older than what is there
    assert (m["updated"], m["changed"], m["stale"], m["source_rows"]) == (0, 0, 1, 1)
    assert merge(BASE[:0]) == keyed.NOTHING
    assert amounts(keyed.read(spark, t)) == [(1, 1, 10.0), (1, 2, 30.0), (2, 1, 19.0), (6, 2, 40.0)]
    assert keyed.read(spark, t).columns == [c for c in spark.createDataFrame([], SCHEMA).columns if c not in ("seq", "gone", "trip_month")] + ["trip_month"]


def test_deletions_hold_against_older_rows(spark, make):
    t, merge = make()
    merge(BASE)
    m = merge([trip(1, 1.0, 1, 5, True), trip(9, 1.0, 2, 5, True)])
    assert (m["deleted"], m["stale"]) == (1, 1)
    assert merge([trip(1, 11.0, 1, 4)])["stale"] == 1
    assert amounts(keyed.read(spark, t)) == [(1, 2, 30.0), (2, 1, 20.0)]
    m = merge([trip(1, 12.0, 1, 6)])
    assert (m["inserted"], m["updated"]) == (1, 0)
    assert [r._change_type for r in keyed.changes(spark, t, after=0).orderBy("version").collect()] == ["delete", "insert"]


def test_ambiguous_rows_are_refused(spark, make):
    t, merge = make()
    merge(BASE)
    twice = [trip(2, 5.0, 1, 7), trip(2, 6.0, 1, 7)]
    with pytest.raises(mg.MergeConflictError):
        merge(twice)
    with pytest.raises(mg.MergeConflictError):
        merge([trip(2, 21.0, 1, 0)])  # another row with the place of the stored one
    assert amounts(keyed.read(spark, t)) == amounts(spark.createDataFrame(BASE, SCHEMA))
    assert keyed.history(spark, t).count() == 1 and len(folders(spark, f"{t.root}/runs/*")) == 1
    m = merge(twice, tie_break=[C.amount])
    assert (m["updated"], m["stale"], m["source_rows"]) == (1, 1, 2)
    merge([trip(6, 1.0, 1, 8), trip(6, 1.0, 1, 8)])  # equal rows are no conflict
    assert amounts(keyed.read(spark, t)) == [(1, 1, 10.0), (1, 2, 30.0), (2, 1, 6.0), (6, 1, 1.0)]


def test_an_order_must_be_stated(spark, make):
    t, merge = make(sequence=())
    with pytest.raises(ValueError, match="sequence"):
        merge(BASE)
    with pytest.raises(ValueError, match="sequence"):
        mg.newest_of(spark.createDataFrame(BASE, SCHEMA), KEYS, [])


def test_null_keys_and_failed_checks_touch_nothing(spark, make):
    t, merge = make()
    merge(BASE)
    any_rows = [dq.Expectation("any", lambda: {"n": F.count(F.lit(1))}, lambda m: m["n"] >= 0, lambda m: F.lit("ok"))]
    null_key = (None, *trip(3, 1.0, 1, 1)[1:])
    with pytest.raises(ValueError, match="null"):
        merge([null_key], expectations=any_rows)
    with pytest.raises(DataQualityError):
        merge([trip(9, -5.0, 1, 1)])
    assert amounts(keyed.read(spark, t)) == amounts(spark.createDataFrame(BASE, SCHEMA))


def plain_state(rows):
    """Newest by (seq, amount) of each key."""
    best = {}
    for r in rows:
        key = (r[0], r[3], r[4])
        if key not in best or (r[7], r[2]) > (best[key][7], best[key][2]):
            best[key] = r
    return sorted((r[0], r[5], r[2]) for r in best.values() if not r[8])


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_and_order_gives_the_same_table_and_the_feed_replays(spark, make, seed):
    r = random.Random(seed)
    rows = [trip(r.randrange(4), float(r.randrange(1, 60)), r.randrange(1, 3), s, r.random() < 0.15)
            for s in range(40) for _ in range(2)]
    want, versions = plain_state(rows), []
    for sizes in ([len(rows)], [7] * 12):
        t, merge = make()
        own = rows if len(sizes) == 1 else r.sample(rows, len(rows))
        total = dict(keyed.NOTHING)
        for a in itertools.accumulate([0, *sizes[:-1]]):
            batch = own[a:a + sizes[0]]
            if batch:
                got = merge(batch, tie_break=[C.amount, C.passengers])
                total = {k: total[k] + got[k] for k in total}
                assert got["inserted"] + got["updated"] + got["deleted"] + got["stale"] == got["source_rows"] == len(batch)
                versions.append(amounts(keyed.read(spark, t)))
        assert amounts(keyed.read(spark, t)) == want
        assert total["inserted"] - total["deleted"] == len(want)
    states = versions[-(len(rows) // 7 + 1):]
    whole = keyed.as_of_version(spark, t, 0)
    for v in (0, 3, len(states) - 1):
        assert amounts(keyed.as_of_version(spark, t, v)) == states[v]
    assert amounts(mg.replay(whole, keyed.changes(spark, t, after=0), KEYS)) == want


def test_the_table_side_of_a_merge_is_not_shuffled(spark, make):
    t, merge = make()
    merge(BASE)
    batch = spark.createDataFrame([trip(2, 3.0, 1, 1)], SCHEMA).withColumnRenamed("gone", mg.GONE)
    target = spark.table(t.table).filter(mg.in_partitions(C.month, [1]))
    met = mg.met_by_sequence(target, batch, KEYS, ["seq"], buckets=t.buckets)
    plan = met._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "FileScan" in x)
    above = plan[:plan.index("FileScan")].split("\n")
    # going up from the scan, indentation falls; no Exchange among its ancestors
    depth, ancestors = len(re.match(r"[ :+|-]*", scan).group()), []
    for line in reversed(above[:-1]):
        own = len(re.match(r"[ :+|-]*", line).group())
        if own < depth:
            ancestors.append(line)
            depth = own
    assert "Bucketed: true" in scan and not any("Exchange" in a for a in ancestors)


def test_months_that_a_batch_does_not_touch_keep_their_files(spark, make):
    t, merge = make()
    merge(BASE)

    def files(month):
        return {r[0] for r in spark.table(t.table).filter(F.col(C.month) == month).select("_metadata.file_path").collect()}

    before = files(1), files(2)
    merge([trip(1, 99.0, 2, 1)])
    assert files(1) == before[0] and not files(2) & before[1]


def test_a_run_that_died_before_its_history_is_repeated(spark, make, monkeypatch):
    t, merge = make()
    merge(BASE)
    late = [trip(2, 5.0, 1, 1), trip(1, 3.0, 2, 1)]

    def dies(*_, **__):
        raise RuntimeError("lost")

    point = keyed._point
    calls = []

    def second_month_dies(spark, table, part, folder):
        calls.append(part)
        if table == t.table and "= 2" in part:
            raise RuntimeError("lost")
        point(spark, table, part, folder)

    for broken in (("_point", second_month_dies), ("snap.record", dies)):
        with monkeypatch.context() as m:
            m.setattr(f"farebox.sinks.keyed.{broken[0]}", broken[1])
            with pytest.raises(RuntimeError):
                merge(late)
    merge(late)
    assert amounts(keyed.read(spark, t)) == [(1, 1, 10.0), (1, 2, 3.0), (2, 1, 5.0)]
    assert [r.version for r in keyed.history(spark, t).orderBy("version").collect()] == [0, 1]
    assert amounts(mg.replay(keyed.as_of_version(spark, t, 0), keyed.changes(spark, t, after=0), KEYS)) == amounts(keyed.read(spark, t))
    assert amounts(keyed.as_of_version(spark, t, 0)) == amounts(spark.createDataFrame(BASE, SCHEMA))


def test_a_table_that_the_catalog_forgot_is_found_again(spark, make):
    t, merge = make()
    merge(BASE)
    merge([trip(2, 7.0, 1, 1), trip(1, 1.0, 2, 1, True)])
    merge([trip(5, 8.0, 3, 2)])
    want, changes = amounts(keyed.read(spark, t)), sorted(map(str, keyed.changes(spark, t).collect()))
    for name in (t.table, t.feed):
        spark.sql(f"DROP TABLE {name}")
    m = merge([trip(2, 6.0, 1, 0), trip(9, 4.0, 1, 3)])  # older than what the forgotten table has
    assert (m["inserted"], m["stale"]) == (1, 1)
    assert amounts(keyed.read(spark, t)) == sorted([*want, (9, 1, 4.0)])
    assert sorted(map(str, keyed.changes(spark, t, until=2).collect())) == changes
    assert [r.version for r in keyed.history(spark, t).orderBy("version").collect()] == [0, 1, 2, 3]


def test_many_batches_leave_a_bounded_number_of_folders(spark, make):
    t, merge = make(keep_changes=3)
    scratch = folders(spark, f"{t.root.rsplit('/', 1)[0]}/*")
    for i in range(12):
        merge([trip(i % 3, 1.0 + i, 1 + i % 2, i)])
    assert len(folders(spark, f"{t.root}/runs/*")) <= 3 + 2 * 2
    assert {r.version for r in keyed.changes(spark, t).select("version").distinct().collect()} == {9, 10, 11}
    assert folders(spark, f"{t.root.rsplit('/', 1)[0]}/*") == sorted({*scratch, *folders(spark, t.root)})


def test_history_is_what_the_merges_saw(spark, make):
    t, merge = make()
    done = [merge(BASE, operation="WRITE"), merge([trip(2, 1.0, 1, 1)])]
    log = keyed.history(spark, t).orderBy("version").collect()
    assert [r.metrics for r in log] == done and [r.operation for r in log] == ["WRITE", "MERGE"]
    assert log[0].committed_at < log[1].committed_at
    micros = keyed.history(spark, t).filter("version = 0").select(F.unix_micros("committed_at")).first()[0]
    first = dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(microseconds=micros)
    assert amounts(keyed.as_of_time(spark, t, first)) == amounts(spark.createDataFrame(BASE, SCHEMA))


def test_gold_from_signed_changes_equals_recomputation(spark, make):
    t, merge = make()
    gold = scratch_path(spark, "measures")
    r = random.Random(4)
    with pytest.raises(Exception):
        jobs.gold_refresh_job(spark, t, gold)
    for seq in range(4):  # inserts, corrections and deletions; the last leaves month 2 empty
        rows = [trip(r.randrange(5), r.randrange(1, 9000) / 100 * 3, r.randrange(1, 3), seq, r.random() < 0.3, hour=r.choice([3, 4]))
                for _ in range(12)]
        if seq == 3:
            rows = [(*x[:7], 3, True) for x in [tuple(y) for y in spark.table(t.table).filter("trip_month = 2").select(
                *SCHEMA.replace(",", "").split()[:-4:2]).collect()]]
        merge(rows, tie_break=[C.amount, C.passengers])
        now = jobs.gold_refresh_job(spark, t, gold)
        kept = jobs.read_measures(spark, gold)
        for made, want in ((agg.monthly_of_measures(kept), agg.monthly_revenue(keyed.read(spark, t))),
                           (agg.hourly_of_measures(kept, 2), agg.hourly_passengers(keyed.read(spark, t), month=2))):
            assert [tuple(x) for x in made.collect()] == [tuple(x) for x in want.collect()]
    assert now == 3 and jobs.gold_refresh_job(spark, t, gold) == 3
    plan = plan_of(jobs.gold_delta(spark, t, gold, 1, 3))
    scans = re.findall(r"Location: \w+(?:\(\d+ paths\))? ?\[([^\]]*)\]", plan)
    assert scans and all("_kind=change" in x or "/version=" in x for x in scans)


def test_year_month_partitions_for_windows_spanning_years(spark):
    def row(y, m, amount, seq):
        p = dt.datetime(y, m, 10, 9)
        return (1, 1, amount, p, p + dt.timedelta(minutes=5), m, 9, seq, False)

    root, cols = scratch_path(spark, "ym"), TripColumns(month=YEAR_MONTH_COL)
    t = keyed.KeyedTable(DB, root.rsplit("/", 1)[1].replace("-", "_"), root, ("seq",), partition=YEAR_MONTH_COL, cols=cols, buckets=2)
    for rows in ([row(2023, 1, 5.0, 0), row(2023, 11, 6.0, 0), row(2024, 1, 7.0, 0)], [row(2024, 1, 8.0, 1)]):
        m = keyed.merge(spark, t, derive_year_month(spark.createDataFrame(rows, SCHEMA).drop("gone")))
    assert (m["inserted"], m["updated"]) == (0, 1)
    got = sorted((r[YEAR_MONTH_COL], r.total_amount) for r in keyed.read(spark, t).collect())
    assert got == [(202301, 5.0), (202311, 6.0), (202401, 8.0)]


def test_publish_writes_once_behind_the_gate(spark):
    root, name = scratch_path(spark, "publish"), "published"
    plain = SCHEMA.rsplit(", seq", 1)[0]

    def rows(*amounts):
        return spark.createDataFrame([trip(i, a, 1 + i % 2)[:7] for i, a in enumerate(amounts)], plain)

    first = jobs.publish_silver(rows(1.0, 2.0), root, DB, name)
    with pytest.raises(DataQualityError):
        jobs.publish_silver(rows(1.0, -2.0), root, DB, name)
    assert spark.table(f"{DB}.{name}").count() == 2 and folders(spark, f"{root}/*") == [first]
    for n in (3, 4, 5):
        last = jobs.publish_silver(rows(*[1.0] * n), root, DB, name)
        assert spark.table(f"{DB}.{name}").count() == n
    assert len(folders(spark, f"{root}/run=*")) == jobs.RUNS_KEPT and last in folders(spark, f"{root}/run=*")
    before = folders(spark, f"{root.rsplit('/', 1)[0]}/*")
    jobs.publish_silver(rows(7.0), root, DB, name)
    assert folders(spark, f"{root.rsplit('/', 1)[0]}/*") == before  # nothing staged beside it


def test_stored_sketches_give_quantiles_of_large_groups(spark):
    rows = spark.range(240_000).select((F.col("id") % 12 + 1).cast("int").alias(C.month),
                                       F.pow(F.rand(5), 3).alias(C.amount))
    path = scratch_path(spark, "kll")
    rows.write.parquet(f"{path}-rows")
    rows = spark.read.parquet(f"{path}-rows")
    agg.monthly_sketches(rows).write.parquet(path)
    kept = spark.read.parquet(path)
    found = agg.quantiles_of_sketches(kept).first()
    for name, p in zip(agg.QUANTILE_NAMES, agg.QUANTILE_PROBS):
        assert abs(rows.filter(F.col(C.amount) <= found[name]).count() / 240_000 - p) < 0.005
    for r in agg.tail_distortion_of_sketches(kept).collect():
        own = rows.filter(F.col(C.month) == r["mes"])
        assert abs(own.filter(F.round(C.amount, 2) < r["mediana"]).count() / 20_000 - 0.5) < 0.06  # medians are rounded to cents
    assert "rows" not in plan_of(agg.quantiles_of_sketches(kept)).split("ReadSchema")[1].split("\n")[0]

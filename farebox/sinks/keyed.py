"""A Silver table kept by natural key: sequence-aware merges, a change feed, a history.

The table is an ordinary external catalog table, partitioned by month and bucketed by
the natural key, so a merge shuffles the batch only. A merge writes the touched months
and the change rows of the same join once, below a new folder, and then points the
months of the table (and a new version of the change feed) at them. Readers never see
a month half written; months are switched one after another.

The rows carry the columns of the ``sequence`` and a tombstone flag, so whether a row is
newer is known across batches, deletions included; ``read`` hides them. One writer at a
time. A run that dies anywhere is simply repeated: months it had switched stay as they
are, and so does their part of the feed. Where the catalog has forgotten the table (a
session without a metastore ends), ``attach`` finds its months and changes again.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farebox.config import DEFAULT_COLUMNS, TripColumns
from farebox.operators import merge as mg
from farebox.operators import snapshots as snap
from farebox.operators.quality import gate, observe_checks, observed_results
from farebox.session import folders, remove_path, scratch_path
from farebox.sinks.catalog import ensure_database, ident

NOTHING = {"inserted": 0, "updated": 0, "deleted": 0, "changed": 0, "stale": 0, "source_rows": 0}


@dataclass(frozen=True)
class KeyedTable:
    """Where the table is and what its rows are told apart and ordered by.

    ``keys`` must determine ``partition`` (as the pickup determines its month) and hold no null.
    ``buckets``: a power of two near the number of cores, or one bucket per few hundred MB of a month.
    ``keep_changes``: versions of the change feed to keep (all if None).
    """

    database: str
    name: str
    root: str
    sequence: tuple[str, ...]
    keys: tuple[str, ...] = tuple(DEFAULT_COLUMNS.natural_key)
    partition: str = DEFAULT_COLUMNS.month
    buckets: int = 16
    keep_changes: int | None = None
    cols: TripColumns = field(default=DEFAULT_COLUMNS)

    @property
    def table(self) -> str:
        return f"{ident(self.database)}.{ident(self.name)}"

    @property
    def feed(self) -> str:
        return f"{ident(self.database)}.{ident(self.name + '_changes')}"

    @property
    def history_path(self) -> str:
        return f"{self.root.rstrip('/')}/history"

    @property
    def hidden(self) -> list[str]:
        return [*self.sequence, mg.GONE]


def read(spark: SparkSession, t: KeyedTable) -> DataFrame:
    """The current rows, without sequence columns and tombstones."""
    return spark.table(t.table).filter(~F.col(mg.GONE)).drop(*t.hidden)


def changes(spark: SparkSession, t: KeyedTable, after: int = -1, until: int | None = None) -> DataFrame:
    """M7: the change rows of the versions after ``after`` up to ``until`` (a partition filter)."""
    feed = spark.table(t.feed).filter(F.col(mg.VERSION) > after)
    return feed if until is None else feed.filter(F.col(mg.VERSION) <= until)


def history(spark: SparkSession, t: KeyedTable) -> DataFrame:
    """What each merge did, as recorded by it."""
    return snap.history(spark, t.history_path)


def as_of_version(spark: SparkSession, t: KeyedTable, version: int) -> DataFrame:
    """The rows at ``version``, from the current ones and the changes since."""
    return mg.as_of(read(spark, t), changes(spark, t, after=version), list(t.keys), version)


def as_of_time(spark: SparkSession, t: KeyedTable, at: dt.datetime) -> DataFrame:
    """T4: the rows at a time, by the recorded times of the merges."""
    return as_of_version(spark, t, snap.version_at(history(spark, t), at))


def merge(spark: SparkSession, t: KeyedTable, batch: DataFrame, expectations=None, tie_break: list[str] | None = None,
          deleted: str | None = None, operation: str = "MERGE") -> dict[str, int]:
    """M1-M7 + D8: gate a batch of Silver rows and merge it, newest by ``t.sequence``.

    1. The batch is staged while its checks, months and rows are observed. An empty batch
       ends here; a failed check raises, and so do null keys.
    2. Its newest row of each key meets the touched months of the table in one full outer
       join on the key; the table's side is bucketed and is not shuffled. Rows of one key
       with the same place in the sequence raise unless they are equal or ``tie_break``
       decides (see ``merge.newest_of``).
    3. Table rows and change rows of that join are written in one job, with the metrics
       observed; then the change feed gets its version and the months are switched.
    4. The history row is appended and the stage removed. Of replaced months one
       generation stays for running readers.

    ``deleted`` names a boolean column of the batch: such a row deletes its key.
    Returns the metrics (see ``merge.sequence_counts``).
    """
    if not t.sequence:
        raise ValueError("a merge needs a sequence: which of two rows of a key is the newer one")
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    batch = batch.withColumn(mg.GONE, gone)
    if deleted and deleted != mg.GONE:
        batch = batch.drop(deleted)
    stage = scratch_path(spark, "merge")
    try:
        checked, checks = observe_checks(batch, expectations, name=f"dq-{stage[-12:]}", cols=t.cols)
        seen = Observation(f"batch-{stage[-12:]}")
        no_key = F.coalesce(*[F.when(F.col(k).isNull(), True) for k in t.keys], F.lit(False))
        checked.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(t.partition).alias("parts"),
                        F.count_if(F.col(t.partition).isNull() | no_key).alias("nulls")).write.parquet(stage)
        if not seen.get["rows"]:
            return dict(NOTHING)
        gate(observed_results(checks))
        if seen.get["nulls"]:
            raise ValueError(f"{seen.get['nulls']} rows have no {t.partition} or a null in {list(t.keys)}")
        return _publish(spark, t, spark.read.schema(batch.schema).parquet(stage), sorted(seen.get["parts"]), tie_break, operation)
    finally:
        remove_path(spark, stage)


def _publish(spark, t: KeyedTable, staged: DataFrame, parts: list, tie_break, operation) -> dict[str, int]:
    attach(spark, t, staged)
    version = (history(spark, t).agg(F.max("version")).first()[0])
    version = 0 if version is None else version + 1
    columns = spark.table(t.table).columns
    values = [c for c in columns if c not in (*t.keys, t.partition, *t.hidden)]
    target = spark.table(t.table).filter(mg.in_partitions(t.partition, parts))
    met = mg.met_by_sequence(target, staged, list(t.keys), list(t.sequence), tie_break, t.buckets)
    counts = Observation()
    rows = mg.outcome_rows(met.observe(counts, *mg.sequence_counts(values)), columns, values)
    run = f"{t.root.rstrip('/')}/runs/v{version:09d}-{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"
    as_written = f"{ident(t.database)}.{ident(f'{t.name}_{run[-12:]}')}"
    try:
        (rows.write.partitionBy(mg.KIND, t.partition).bucketBy(t.buckets, *t.keys).sortBy(*t.keys)
         .option("path", run).saveAsTable(as_written))
    except PySparkException as e:
        remove_path(spark, run)
        if mg.CONFLICT in str(e):
            raise mg.MergeConflictError(f"{mg.CONFLICT}: {list(t.keys)}") from e
        raise
    spark.sql(f"DROP TABLE {as_written}")  # external: only the name goes
    changed = {p.rsplit("=", 1)[1] for p in folders(spark, f"{run}/{mg.KIND}=change/*")}
    for part in parts:
        month = f"{t.partition}={part}"
        if str(part) in changed:
            _point(spark, t.feed, f"{mg.VERSION} = {version}, {ident(t.partition)} = {part}", f"{run}/{mg.KIND}=change/{month}")
        before = _location(spark, t, part)
        _point(spark, t.table, f"{ident(t.partition)} = {part}", f"{run}/{mg.KIND}=table/{month}")
        for old in folders(spark, f"{t.root.rstrip('/')}/runs/*/{mg.KIND}=table/{month}"):
            if run not in old and old != before:
                remove_path(spark, old)
    metrics = {k: int(v) for k, v in counts.get.items()}
    snap.record(spark, t.history_path, version, operation, metrics)
    _forget(spark, t, version)
    return metrics


def attach(spark: SparkSession, t: KeyedTable, rows: DataFrame) -> None:
    """Create the catalog tables if they are not there, with the months and changes of all recorded merges.

    ``rows`` has the columns of a batch (those of ``t.sequence`` and the tombstone flag included). A month is read
    from the newest folder that a recorded merge has written for it.
    """
    new = not spark.catalog.tableExists(t.table) if spark.catalog.databaseExists(t.database) else True
    _create(spark, t, rows)
    last = history(spark, t).agg(F.max("version")).first()[0] if new else None
    if last is None:
        return
    newest: dict[tuple, str] = {}
    for kind in ("table", "change"):
        for folder in folders(spark, f"{t.root.rstrip('/')}/runs/*/{mg.KIND}={kind}/*"):  # by version, then time
            version, part = int(folder.split("/")[-3][1:10]), folder.rsplit("=", 1)[1]
            if version <= last:
                newest[kind, None if kind == "table" else version, part] = folder
    for (kind, version, part), folder in newest.items():
        month = f"{ident(t.partition)} = {part}"
        _point(spark, t.table if kind == "table" else t.feed, month if kind == "table" else f"{mg.VERSION} = {version}, {month}", folder)


def _create(spark: SparkSession, t: KeyedTable, rows: DataFrame) -> None:
    ensure_database(spark, t.database)
    kinds = dict(rows.dtypes)
    plain = [c for c in rows.columns if c not in (t.partition, *t.hidden)]

    def columns(names):
        return ", ".join(f"{ident(c)} {kinds[c]}" for c in names)

    by = ", ".join(map(ident, t.keys))
    if not spark.catalog.tableExists(t.table):
        spark.sql(f"CREATE TABLE {t.table} ({columns([*plain, *t.hidden, t.partition])}) USING parquet "
                  f"PARTITIONED BY ({ident(t.partition)}) CLUSTERED BY ({by}) SORTED BY ({by}) INTO {t.buckets} BUCKETS "
                  f"LOCATION '{t.root.rstrip('/')}/table'")
    if not spark.catalog.tableExists(t.feed):
        spark.sql(f"CREATE TABLE {t.feed} ({columns(plain)}, {mg.CHANGE_TYPE} string, {mg.VERSION} int, {columns([t.partition])}) "
                  f"USING parquet PARTITIONED BY ({mg.VERSION}, {ident(t.partition)}) LOCATION '{t.root.rstrip('/')}/changes'")


def _point(spark: SparkSession, table: str, part: str, folder: str) -> None:
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({part}) LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {table} PARTITION ({part}) SET LOCATION '{folder}'")


def _location(spark: SparkSession, t: KeyedTable, part) -> str | None:
    """The folder that a month is read from."""
    found = spark.sql(f"SHOW PARTITIONS {t.table} PARTITION ({ident(t.partition)} = {part})").collect()
    if not found:
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {t.table} PARTITION ({ident(t.partition)} = {part})").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def _forget(spark: SparkSession, t: KeyedTable, version: int) -> None:
    """Drop versions of the change feed beyond ``keep_changes``, and folders that hold nothing any more."""
    runs = f"{t.root.rstrip('/')}/runs"
    if t.keep_changes is not None:
        for r in spark.sql(f"SHOW PARTITIONS {t.feed}").collect():
            spec = dict(x.split("=", 1) for x in r["partition"].split("/"))
            if int(spec[mg.VERSION]) <= version - t.keep_changes:
                spark.sql(f"ALTER TABLE {t.feed} DROP IF EXISTS PARTITION ({mg.VERSION} = {spec[mg.VERSION]}, "
                          f"{ident(t.partition)} = {spec[t.partition]})")
        for f in folders(spark, f"{runs}/*/{mg.KIND}=change"):
            if int(f.split("/")[-2][1:10]) <= version - t.keep_changes:
                remove_path(spark, f)
    used = {p.rsplit("/", 2)[0] for p in folders(spark, f"{runs}/*/{mg.KIND}=*/*")}
    for run in folders(spark, f"{runs}/*"):
        if run not in used:
            remove_path(spark, run)

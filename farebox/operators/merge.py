"""Incremental load without a table format: upsert, change sets, metrics.

MERGE semantics (matched -> update all columns, not matched -> insert) are
expressed as relational algebra on the natural key:

    new = source  UNION ALL  (target LEFT ANTI JOIN source ON key)

Both inputs are shuffled once on the key (or the source is broadcast when
AQE measures it small at run time); AQE's skew-join handling covers a
hot key on the target side. A duplicated key in the *source* would make
the result ambiguous: resolve it by ``dedup_by_key``, or merge by a sequence
(``newest_of`` / ``met_by_sequence``), which refuses what the sequence can't decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.functions.columns import count_if


class MergeConflictError(Exception):
    """Several source rows match the same key."""


def _on(keys: list[str], partition_col: str | None) -> list[str]:
    return [*keys, partition_col] if partition_col and partition_col not in keys else list(keys)


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], partition_col: str | None = None
) -> DataFrame:
    """M1: new table = source rows + target rows whose key is not in the source.

    Including the partition column in the key (M3) lets each month be
    processed independently and lets the caller scope ``target`` to the
    months present in the source.
    """
    on = _on(keys, partition_col)
    untouched = target.join(source.select(*on), on=on, how="left_anti")
    return source.select(*target.columns).unionByName(untouched)


def dedup_by_key(df: DataFrame, keys: list[str], order_by: list[Column | str]) -> DataFrame:
    """M2: one row per key, the greatest by ``order_by`` then by every other column.

    ``max(struct(...))`` is an ordinary aggregate with a map-side partial
    step, so a key holding a third of all rows is reduced inside each task
    before the shuffle (a ``row_number`` window would sort that key's rows
    in one task). Ties are broken by the remaining columns, so the result is
    deterministic.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(
        *[c.alias(f"_o{i}") for i, c in enumerate(order_cols)],
        *[F.col(c).alias(f"_v{i}") for i, c in enumerate(rest)],
    )
    best = df.groupBy(*keys).agg(F.max(ranked).alias("_best"))
    return best.select(*keys, *[F.col(f"_best._v{i}").alias(c) for i, c in enumerate(rest)]).select(
        *df.columns
    )


def merge_metrics(
    target: DataFrame, source: DataFrame, keys: list[str], partition_col: str | None = None
) -> DataFrame:
    """M4: ``inserted, updated, deleted, source_rows`` of an upsert, in one join.

    Updates are unconditional (a matched row counts as updated even when
    its values are equal), as in MERGE ... WHEN MATCHED UPDATE SET *.
    """
    return merge_plan(target, source, keys, partition_col).select(
        "inserted", "updated", "deleted", "source_rows")


def merge_plan(
    target: DataFrame, source: DataFrame, keys: list[str], partition_col: str | None = None
) -> DataFrame:
    """Merge metrics plus ``duplicated_keys`` of the source, in one pass.

    Both sides are tagged and counted per key in one aggregate (with partial
    counts before the shuffle), so a hot key costs one row per task.
    """
    on = _on(keys, partition_col)
    tagged = source.select(*on, F.lit(1).alias("_s")).unionByName(target.select(*on, F.lit(0).alias("_s")))
    per_key = tagged.groupBy(*on).agg(F.sum("_s").alias("_n"), F.count_if(F.col("_s") == 0).alias("_t"))

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0))

    return per_key.agg(
        total(F.col("_t") == 0).alias("inserted"),
        total(F.col("_t") > 0).alias("updated"),
        F.lit(0).cast("long").alias("deleted"),
        total(F.lit(True)).alias("source_rows"),
        count_if(F.col("_n") > 1).alias("duplicated_keys"),
    )


#: Columns of ``met_by_sequence`` and of what follows from it.
OLD, NEW, ROWS, GONE = "_old", "_new", "_rows", "_deleted"
CONFLICT = "several rows of one key have the same place in the sequence"


def newest_of(batch: DataFrame, keys: list[str], sequence: list[str], tie_break: list[str] | None = None) -> DataFrame:
    """M2: per key the newest row of a batch as ``_new``, and how many rows the key has as ``_rows``.

    ``sequence`` (such as arrival time, then file) says what is newer; it has to be
    stated. Rows of one key with the same place in it are fine if they are equal or if
    ``tie_break`` (columns, the greatest stays) tells them apart; else the batch is
    ambiguous and the query raises. One aggregate with a partial step before its
    shuffle, so a hot key costs one row per task.
    """
    if not sequence:
        raise ValueError("a merge needs a sequence: which of two rows of a key is the newer one")
    place = F.struct(*[F.col(c).alias(f"_p{i}") for i, c in enumerate([*sequence, *(tie_break or [])])])
    whole = F.struct(*batch.columns)
    mark = F.xxhash64(*batch.columns)
    best = batch.groupBy(*keys).agg(
        F.max(F.struct(place.alias("p"), whole.alias("r"))).alias("_best"),
        # the greatest and the least mark among the rows in the last place differ if the rows do
        F.max(F.struct(place.alias("p"), mark.alias("m")))["m"].alias("_high"),
        F.max(F.struct(place.alias("p"), F.bitwise_not(mark).alias("m")))["m"].alias("_low"),
        F.count(F.lit(1)).alias(ROWS))
    one = F.when(F.col("_high") == F.bitwise_not("_low"), F.col("_best.r")).otherwise(F.raise_error(F.lit(f"{CONFLICT}: {keys}")))
    return best.select(*keys, one.alias(NEW), ROWS)


def met_by_sequence(target: DataFrame, batch: DataFrame, keys: list[str], sequence: list[str],
                    tie_break: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """M1-M3: per key of either side the target's row ``_old``, the row to keep ``_new``, and ``_rows`` of the batch.

    Both sides have the same columns, ``GONE`` (a tombstone) among them; the target has
    a key once. The newest by ``sequence`` stays whichever side it comes from, so
    batches may be split, reordered or repeated: the outcome is the same. Equal places
    with different rows raise. For a target bucketed by ``keys``, ``buckets`` deals the
    batch's newest rows (combined map-side first) to as many partitions, so that the
    target is not shuffled.
    """
    cols = target.columns
    got = newest_of(batch.select(*cols), keys, sequence, tie_break).withColumnRenamed(NEW, "_got")
    got = got.repartition(buckets, *keys) if buckets else got
    old = target.select(*keys, F.struct(*cols).alias(OLD))
    met = old.join(got, keys, "full_outer")

    def place(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}") for c in (*sequence, *(tie_break or []))])

    o, got = F.col(OLD), F.col("_got")
    keep = (F.when(o.isNull(), got).when(got.isNull() | (place("_got") < place(OLD)), o)
            .when((place("_got") > place(OLD)) | got.eqNullSafe(o), got)
            .otherwise(F.raise_error(F.lit(f"{CONFLICT}: {keys}"))))
    return met.select(o.alias(OLD), keep.alias(NEW), F.coalesce(ROWS, F.lit(0)).alias(ROWS),
                      (got.isNotNull() & (o.isNull() | (place("_got") >= place(OLD)))).alias("_took"))


def _live(side: str) -> Column:
    return F.col(side).isNotNull() & ~F.coalesce(F.col(f"{side}.{GONE}"), F.lit(False))


def values_differ(values: list[str]) -> Column:
    """Whether the kept row differs from the target's in one of the columns."""
    return ~F.struct(*[F.col(f"{OLD}.{c}") for c in values]).eqNullSafe(F.struct(*[F.col(f"{NEW}.{c}") for c in values]))


def sequence_counts(values: list[str]) -> list[Column]:
    """M4 as aggregates over ``met_by_sequence``, to be observed while its outcome is written.

    ``inserted``, ``updated`` and ``deleted`` count keys that a batch row won (an update
    is unconditional, as in MERGE); ``changed`` those updates whose ``values`` differ;
    ``stale`` batch rows that did not win, so that inserted + updated + deleted + stale
    = source_rows.
    """
    took, old, new = F.col("_took"), _live(OLD), _live(NEW)
    won = took & (old | new)
    return [F.count_if(took & ~old & new).alias("inserted"), F.count_if(took & old & new).alias("updated"),
            F.count_if(took & old & ~new).alias("deleted"),
            F.count_if(took & old & new & values_differ(values)).alias("changed"),
            F.coalesce(F.sum(F.col(ROWS) - F.when(won, 1).otherwise(0)), F.lit(0)).alias("stale"),
            F.coalesce(F.sum(ROWS), F.lit(0)).alias("source_rows")]


KIND = "_kind"


def outcome_rows(met: DataFrame, columns: list[str], values: list[str]) -> DataFrame:
    """M1 + M7 from one join: the merged table's rows (``_kind`` 'table') and its change rows (``_kind`` 'change').

    A change row's ``_change_type`` is ``insert``, ``delete``, ``update_preimage`` or
    ``update_postimage``; a key whose ``values`` stay the same has none.
    """
    def row(side: str, kind: str, change: str | None) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in columns], F.lit(change).cast("string").alias(CHANGE_TYPE),
                        F.lit(kind).alias(KIND))

    old, new = _live(OLD), _live(NEW)
    table = row(NEW, "table", None)
    changes = (F.when(~old & new, F.array(table, row(NEW, "change", "insert")))
               .when(old & ~new, F.array(table, row(OLD, "change", "delete")))
               .when(old & new & values_differ(values),
                     F.array(table, row(OLD, "change", "update_preimage"), row(NEW, "change", "update_postimage")))
               .otherwise(F.array(table)))
    return met.select(F.inline(changes))


def in_partitions(partition_col: str, values: list) -> Column:
    """Literal partition filter; a null among the values stands for the null partition."""
    c = F.col(partition_col)
    some = c.isin([v for v in values if v is not None])
    return some | c.isNull() if None in values else some


CHANGE_TYPE = "_change_type"


def change_set(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """M7: rows that differ between two versions, change-data-feed style.

    ``_change_type`` is ``insert``, ``delete``, ``update_preimage`` or
    ``update_postimage``; unchanged rows are omitted (null-safe compare of every
    column). Both versions are tagged and met per key in one aggregate; a key
    that one version holds twice is an error, never a product of rows.
    """
    cols = old.columns
    row = F.struct(*[F.col(c) for c in cols]).alias("row")
    both = old.select(*keys, F.lit(0).alias("_side"), row).unionByName(
        new.select(*cols).select(*keys, F.lit(1).alias("_side"), row))

    def of(side: int) -> tuple[Column, Column]:
        mine = F.when(F.col("_side") == side, F.col("row"))
        return F.max(mine), F.count(mine)

    (old_row, n_old), (new_row, n_new) = of(0), of(1)
    met = both.groupBy(*keys).agg(old_row.alias("_old"), new_row.alias("_new"),
                                  F.greatest(n_old, n_new).alias("_n"))

    def tagged(side: str, kind: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in cols], F.lit(kind).alias(CHANGE_TYPE))

    o, n = F.col("_old"), F.col("_new")
    rows = (
        F.when(F.col("_n") > 1, F.raise_error(F.lit(f"a version holds a key of {keys} more than once")))
        .when(o.isNull(), F.array(tagged("_new", "insert")))
        .when(n.isNull(), F.array(tagged("_old", "delete")))
        .when(~o.eqNullSafe(n), F.array(tagged("_old", "update_preimage"), tagged("_new", "update_postimage")))
    )
    return met.select(F.inline(rows))


def apply_change_set(old: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Replay: ``old`` minus deleted / pre-image keys plus inserts and post-images."""
    gone = changes.filter(F.col(CHANGE_TYPE).isin("delete", "update_preimage")).select(*keys)
    added = changes.filter(F.col(CHANGE_TYPE).isin("insert", "update_postimage")).drop(CHANGE_TYPE)
    return old.join(gone, on=keys, how="left_anti").unionByName(added.select(*old.columns))


VERSION = "version"


def replay(old: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """A table brought forward by its change rows of later versions: the last change of each key decides."""
    cols = old.columns
    after = changes.filter(F.col(CHANGE_TYPE) != "update_preimage")
    last = after.groupBy(*keys).agg(F.max(F.struct(VERSION, CHANGE_TYPE, F.struct(*cols).alias("r"))).alias("_l"))
    kept = last.filter(F.col(f"_l.{CHANGE_TYPE}") != "delete").select("_l.r.*")
    return old.join(last.select(*keys), keys, "left_anti").select(*cols).unionByName(kept)


def as_of(table: DataFrame, changes: DataFrame, keys: list[str], version: int) -> DataFrame:
    """A table as it was at ``version``: the first later change of each key is undone.

    Reads the table and the change rows after ``version``, which is a partition filter.
    """
    cols = table.columns
    before = changes.filter((F.col(VERSION) > version) & (F.col(CHANGE_TYPE) != "update_postimage"))
    first = before.groupBy(*keys).agg(F.min(F.struct(VERSION, CHANGE_TYPE, F.struct(*cols).alias("r"))).alias("_f"))
    kept = first.filter(F.col(f"_f.{CHANGE_TYPE}") != "insert").select("_f.r.*")
    return table.join(first.select(*keys), keys, "left_anti").select(*cols).unionByName(kept)


def signed(changes: DataFrame) -> Column:
    """+1 for a row that a change brings, -1 for one that it takes away."""
    return F.when(F.col(CHANGE_TYPE).isin("insert", "update_postimage"), 1).otherwise(-1)


def read_watermark(control: DataFrame, mark_col: str = "watermark"):
    """The persisted watermark: one aggregated value of a small control table."""
    return control.agg(F.max(mark_col)).first()[0]


def since_watermark(df: DataFrame, ts_col: str, watermark) -> DataFrame:
    """M9: rows newer than the watermark; ``None`` (nothing processed yet) keeps all.

    The watermark is a literal; on a stored column the predicate reaches the
    Parquet scan (row groups whose greatest ``ts_col`` is older are skipped).
    Save the new mark only after the rows are written: a crash in between
    repeats rows, which the merge absorbs, and never loses any.
    """
    if watermark is None:
        return df
    lit = F.lit(watermark).cast(df.schema[ts_col].dataType)
    return df.filter(F.col(ts_col) > lit)


def advance_watermark(processed: DataFrame, ts_col: str, mark_col: str = "watermark") -> DataFrame:
    """New control row: the greatest ingestion time processed."""
    return processed.agg(F.max(ts_col).alias(mark_col))


def save_watermark(control_row: DataFrame, path: str) -> None:
    """Append the control row to the control table (one tiny file per run)."""
    control_row.coalesce(1).write.mode("append").parquet(path)

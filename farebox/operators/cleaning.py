"""Silver cleaning: projection, type contract, row rules, dedup, derived columns.

Each step is a ``DataFrame -> DataFrame`` function; ``to_silver`` chains
them with ``DataFrame.transform`` so Catalyst sees one plan: the projection
prunes the Parquet read schema, the raw-column rules are pushed to the scan,
and the exact dedup is the plan's only shuffle (partial aggregation first,
so copies of one row collapse map-side before they are shuffled).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.config import DEFAULT_COLUMNS, DateWindow, TripColumns
from farebox.functions.columns import window_predicate


def select_required(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS, carried: list[str] | None = None) -> DataFrame:
    """Keep only the five required columns (column pruning at the scan), and ``carried`` ones as they are."""
    return df.select(*cols.required, *(carried or []))


def cast_types(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Type contract int, int, double, timestamp_ntz, timestamp_ntz.

    ``try_cast``: under ANSI mode a plain cast of NaN or an out-of-range
    double to int raises; here it becomes null and the null rule drops it.
    Doubles truncate toward zero (0.5 -> 0, 1.7 -> 1). Timestamps are kept
    as wall clock (``timestamp_ntz``) so month and hour do not depend on the
    session time zone.
    """
    targets = {
        cols.vendor: T.IntegerType(),
        cols.passengers: T.IntegerType(),
        cols.amount: T.DoubleType(),
        cols.pickup: T.TimestampNTZType(),
        cols.dropoff: T.TimestampNTZType(),
    }
    return df.select(
        *[
            F.col(c).try_cast(targets[c]).alias(c) if c in targets else F.col(c)
            for c in df.columns
        ]
    )


def filter_not_null(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Drop rows with a null (or NaN) in any required column."""
    return df.na.drop(subset=cols.required)


def filter_positive_amount(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """``total_amount > 0`` (run after P3: ``NaN > 0`` is true in Spark)."""
    return df.filter(F.col(cols.amount) > 0)


def filter_positive_passengers(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """P5: ``passenger_count > 0`` on the int-cast column (0.5 -> 0 is dropped)."""
    return df.filter(F.col(cols.passengers) > 0)


def filter_chronology(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Dropoff strictly after pickup."""
    return df.filter(F.col(cols.dropoff) > F.col(cols.pickup))


def filter_date_window(
    df: DataFrame, window: DateWindow, cols: TripColumns = DEFAULT_COLUMNS
) -> DataFrame:
    """``start <= pickup < end`` (typed literals, pushable to Parquet)."""
    return df.filter(window_predicate(df, cols.pickup, window))


def dedup_exact(df: DataFrame) -> DataFrame:
    """Exact-row dedup over all columns, run last so it shuffles fewest rows."""
    return df.dropDuplicates()


def derive_month_hour(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """P10: ``trip_month`` (1-12) and ``pickup_hour`` (0-23) of the pickup wall clock."""
    return df.withColumn(cols.month, F.month(cols.pickup)).withColumn(
        cols.hour, F.hour(cols.pickup)
    )


YEAR_MONTH_COL = "trip_year_month"


def derive_year_month(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS,
                      name: str = YEAR_MONTH_COL) -> DataFrame:
    """``yyyyMM`` of the pickup as an int: the partition column to use when a
    window spans years (``trip_month`` alone merges January of two years)."""
    return df.withColumn(name, F.year(cols.pickup) * 100 + F.month(cols.pickup))


def clean(
    df: DataFrame, window: DateWindow | None = None, cols: TripColumns = DEFAULT_COLUMNS
) -> DataFrame:
    """P3-P7 then P9 on typed rows."""
    window = window or DateWindow()
    return (
        df.transform(lambda d: filter_not_null(d, cols))
        .transform(lambda d: filter_positive_amount(d, cols))
        .transform(lambda d: filter_positive_passengers(d, cols))
        .transform(lambda d: filter_chronology(d, cols))
        .transform(lambda d: filter_date_window(d, window, cols))
        .transform(dedup_exact)
    )


def raw_prefilter(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Rules restated on raw (pre-cast) columns so they reach the Parquet scan.

    A filter on ``try_cast(passenger_count AS INT) > 0`` cannot be pushed to
    the reader. For a numeric raw value x, ``trunc(x) >= 1`` iff ``x >= 1``
    (NaN and values too big for int pass here and are dropped later as
    nulls), so ``x >= 1`` is an exact pre-filter. Only added when the raw
    column is numeric; everything else is left to the typed rules.
    """
    dtype = df.schema[cols.passengers].dataType
    if isinstance(dtype, T.NumericType):
        return df.filter(F.col(cols.passengers) >= 1)
    return df


def to_silver(
    df: DataFrame, window: DateWindow | None = None, cols: TripColumns = DEFAULT_COLUMNS,
    carried: list[str] | None = None,
) -> DataFrame:
    """Projection -> type contract -> rules -> dedup -> month/hour.

    ``carried``: further columns to keep, such as a row's arrival; rows that differ in them are no copies.
    """
    return (
        df.transform(lambda d: select_required(d, cols, carried))
        .transform(lambda d: raw_prefilter(d, cols))
        .transform(lambda d: cast_types(d, cols))
        .transform(lambda d: clean(d, window, cols))
        .transform(lambda d: derive_month_hour(d, cols))
    )


def month_filter(df: DataFrame, month: int, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """``trip_month = m`` (a partition filter on a month-partitioned table)."""
    return df.filter(F.col(cols.month) == F.lit(month))


def window_from_months(months: DataFrame, month_col: str = "month") -> DataFrame:
    """``[start, end)`` of a relation of ``yyyy-MM`` strings.

    Order-free (min/max), and December rolls the year through ``add_months``.
    """
    first = F.to_date(F.concat(F.min(month_col), F.lit("-01")))
    last = F.to_date(F.concat(F.max(month_col), F.lit("-01")))
    return months.agg(first.alias("window_start"), F.add_months(last, 1).alias("window_end"))

"""Column-expression helpers.

All of them return ``Column`` objects built from built-in Catalyst
expressions, so they stay inside whole-stage codegen and can be pushed down
or constant-folded by the optimizer. None of them runs a Spark job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.config import MONTH_LABELS, DateWindow

EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def count_if(cond: Column) -> Column:
    """Number of rows where ``cond`` is true (nulls count as false, 0 on empty input)."""
    return F.count_if(cond)


def typed_literal(value: str, data_type: T.DataType) -> Column:
    """A literal of the column's own type, so comparisons need no cast on the column side
    (a cast on the column would stop Parquet predicate pushdown)."""
    return F.lit(value).cast(data_type)


def column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def window_predicate(df: DataFrame, ts_col: str, window: DateWindow) -> Column:
    """``start <= ts < end`` with literals typed like ``ts_col``."""
    dtype = column_type(df, ts_col)
    if not isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        dtype = T.TimestampNTZType()
    return (F.col(ts_col) >= typed_literal(window.start, dtype)) & (
        F.col(ts_col) < typed_literal(window.end, dtype)
    )


def month_label(month: Column, labels: dict[int, str] | None = None) -> Column:
    """Label of a month number with the number itself as the default."""
    labels = MONTH_LABELS if labels is None else labels
    pairs = []
    for number, label in sorted(labels.items()):
        pairs += [F.lit(number), F.lit(label)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), month), month.cast("string"))


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def nanos_to_timestamp_ntz(name: str) -> Column:
    """Wall clock from a bigint column of nanoseconds since the epoch.

    The value counts wall-clock time, so it is added to a zone-less epoch and
    02:30 stays 02:30 on every day. Whole-number arithmetic throughout; taking
    off ``pmod`` first makes the division round down before 1970, too.
    """
    c = quote(name)
    return F.expr(
        f"timestampadd(MICROSECOND, ({c} - pmod({c}, 1000L)) div 1000L, {EPOCH_NTZ})"
    )


def year_month(ts: Column) -> Column:
    """``yyyy-MM`` of a timestamp."""
    return F.date_format(ts, "yyyy-MM")

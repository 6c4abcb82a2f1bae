"""KPI and history documents as relations (one row, nested types, JSON text).

The KPI document holds Q1 per month, the global average and Q2 per hour of
one month. All three come from ONE scan of Silver through grouping sets
``(month), (hour), ()``; the second aggregation assembles at most
12 + 24 + 1 rows into arrays of structs, so nothing crosses to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.config import (
    AVG_AMOUNT,
    AVG_PASSENGERS,
    DEFAULT_COLUMNS,
    DOC_DISCARD_PCT,
    DOC_GLOBAL_AVG,
    DOC_HOUR,
    DOC_LANDING_ROWS,
    DOC_META,
    DOC_MONTH_NUM,
    DOC_NOTE,
    DOC_PERIOD,
    DOC_Q1,
    DOC_Q2,
    DOC_SILVER_ROWS,
    MONTH_ALIAS,
    PERIOD_SEPARATOR,
    RIDES,
    TripColumns,
)
from farebox.functions.columns import month_label

#: Marks the landing count among the grouping sets, whose ids are 0 to 3.
LANDING_SET = 9

DEFAULT_NOTE = "KPIs computed by farebox over the Silver layer."

Q1_ITEM = T.StructType([
    T.StructField(DOC_MONTH_NUM, T.IntegerType()),
    T.StructField(MONTH_ALIAS, T.StringType()),
    T.StructField(RIDES, T.LongType()),
    T.StructField(AVG_AMOUNT, T.DoubleType()),
])
Q2_ITEM = T.StructType([
    T.StructField(DOC_HOUR, T.IntegerType()),
    T.StructField(RIDES, T.LongType()),
    T.StructField(AVG_PASSENGERS, T.DoubleType()),
])
DOCUMENT_SCHEMA = T.StructType([
    T.StructField(DOC_META, T.StructType([
        T.StructField(DOC_SILVER_ROWS, T.LongType()),
        T.StructField(DOC_PERIOD, T.StringType()),
        T.StructField(DOC_NOTE, T.StringType()),
        T.StructField(DOC_LANDING_ROWS, T.LongType()),
        T.StructField(DOC_DISCARD_PCT, T.DoubleType()),
    ])),
    T.StructField(DOC_Q1, T.ArrayType(Q1_ITEM)),
    T.StructField(DOC_GLOBAL_AVG, T.DoubleType()),
    T.StructField(DOC_Q2, T.ArrayType(Q2_ITEM)),
])


def kpi_document(
    silver: DataFrame, month: int = 5, note: str = DEFAULT_NOTE, cols: TripColumns = DEFAULT_COLUMNS,
    landing: DataFrame | None = None,
) -> DataFrame:
    """K6 + A16 + A17: the KPI document as one row of nested columns.

    With ``landing`` (the raw rows Silver was cleaned from) ``meta`` also
    carries the landing row count and the discarded share (A15); the count is one
    more row of the grouping sets, so building the plan runs nothing.
    """
    m, h = F.col(cols.month), F.col(cols.hour)
    in_month = m == F.lit(month)
    sets = silver.groupingSets([[cols.month], [cols.hour], []], cols.month, cols.hour).agg(
        F.grouping_id().alias("_g"),
        F.count(F.lit(1)).alias("_n"),
        F.avg(cols.amount).alias("_avg_amount"),
        F.count_if(in_month).alias("_n_m"),
        F.avg(F.when(in_month, F.col(cols.passengers))).alias("_avg_pax_m"),
        # integer yyyyMM keeps this a hash aggregate (string min/max would sort)
        F.min(_ym_number(F.col(cols.pickup))).alias("_first"),
        F.max(_ym_number(F.col(cols.pickup))).alias("_last"),
    )
    if landing is not None:
        raw = landing.agg(F.count(F.lit(1)).alias("_n")).withColumn("_g", F.lit(LANDING_SET).cast("long"))
        sets = sets.unionByName(raw, allowMissingColumns=True)
    g = F.col("_g")
    by_month, by_hour, total = g == 1, g == 2, g == 3
    q1_item = F.struct(
        m.alias(DOC_MONTH_NUM), month_label(m).alias(MONTH_ALIAS), F.col("_n").alias(RIDES),
        F.round("_avg_amount", 2).alias(AVG_AMOUNT),
    )
    q2_item = F.struct(
        h.alias(DOC_HOUR), F.col("_n_m").alias(RIDES),
        F.round("_avg_pax_m", 3).alias(AVG_PASSENGERS),
    )
    return sets.agg(
        F.struct(
            F.coalesce(F.max(F.when(total, F.col("_n"))), F.lit(0)).alias(DOC_SILVER_ROWS),
            F.concat(_ym_text(F.max(F.when(total, F.col("_first")))), F.lit(PERIOD_SEPARATOR),
                     _ym_text(F.max(F.when(total, F.col("_last"))))).alias(DOC_PERIOD),
            F.lit(note).alias(DOC_NOTE),
            *([] if landing is None else _landing_meta(
                F.coalesce(F.max(F.when(g == LANDING_SET, F.col("_n"))), F.lit(0)),
                F.coalesce(F.max(F.when(total, F.col("_n"))), F.lit(0)))),
        ).alias(DOC_META),
        F.sort_array(F.collect_list(F.when(by_month, q1_item))).alias(DOC_Q1),
        F.max(F.when(total, F.round("_avg_amount", 2))).alias(DOC_GLOBAL_AVG),
        F.sort_array(F.collect_list(F.when(by_hour & (F.col("_n_m") > 0), q2_item))).alias(
            DOC_Q2),
    )


def _landing_meta(landing_rows, silver_rows) -> list:
    pct = F.try_divide((landing_rows - silver_rows) * 100.0, landing_rows)
    return [landing_rows.alias(DOC_LANDING_ROWS), F.round(pct, 2).alias(DOC_DISCARD_PCT)]


def _ym_number(ts):
    return F.year(ts) * 100 + F.month(ts)


def _ym_text(n):
    return F.format_string("%04d-%02d", (n / 100).cast("int"), n % 100)


def to_json_document(doc: DataFrame, column: str = "document") -> DataFrame:
    """The document as one JSON text column (field order as in the struct)."""
    return doc.select(F.to_json(F.struct(*[F.col(c) for c in doc.columns])).alias(column))


def read_kpi_json(spark, path: str) -> DataFrame:
    """Read the JSON document back with an explicit schema (no inference)."""
    return spark.read.schema(DOCUMENT_SCHEMA).json(path)


def parse_kpi_json(text: DataFrame, column: str = "document") -> DataFrame:
    """S10 for documents stored as text in a column: ``from_json`` with the schema."""
    return text.select(F.from_json(column, DOCUMENT_SCHEMA).alias("_d")).select("_d.*")


def monthly_rows(doc: DataFrame) -> DataFrame:
    """Q1 entries as rows; ``mes`` defaulted from ``mes_num`` when absent."""
    return doc.select(F.inline(DOC_Q1)).select(
        DOC_MONTH_NUM,
        F.coalesce(F.col(MONTH_ALIAS), month_label(F.col(DOC_MONTH_NUM))).alias(MONTH_ALIAS),
        RIDES,
        AVG_AMOUNT,
    )


def history_document(history: DataFrame) -> DataFrame:
    """K7: history rows as JSON objects with ISO-8601 timestamps."""
    return history.select(
        "version",
        F.to_json(F.struct(
            "version",
            F.date_format("committed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            "operation",
            F.col("metrics").alias("operationMetrics"),
        )).alias("document"),
    ).orderBy(F.desc("version"))


def kpi_diff_document(diff: DataFrame, key: str) -> DataFrame:
    """K7: a KPI diff (T3) as one JSON document, months in order."""
    row = F.struct(*[F.col(c) for c in diff.columns])
    return diff.agg(F.array_sort(F.collect_list(row)).alias("meses")).select(
        F.to_json(F.struct("meses")).alias("document"))

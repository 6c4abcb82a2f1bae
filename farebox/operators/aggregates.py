"""Business aggregates over the Silver table and KPIs derived from them.

Aggregates over Silver (A1-A13, A23) are partial + final hash aggregations:
each task pre-aggregates its rows, so only (#groups x #tasks) rows cross
the shuffle whatever the data size, and a hot month or hour costs nothing
extra. Derived KPIs (A16-A22) run on those tiny aggregates; the few window
functions below operate on at most 24 aggregated rows.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.config import (
    AVG_AMOUNT,
    AVG_PASSENGERS,
    AVG_PAX,
    AVG_TICKET,
    DEFAULT_COLUMNS,
    DOC_MONTH_NUM,
    GLOBAL_AVG,
    HOUR_ALIAS,
    MEAN,
    MEDIAN,
    MONTH_ALIAS,
    RIDES,
    ROWS,
    SUM_AMOUNT,
    TAIL_GAP,
    TRIPS,
    WEEKDAY,
    TripColumns,
)
from farebox.functions.columns import month_label


def monthly_revenue(
    silver: DataFrame, cols: TripColumns = DEFAULT_COLUMNS, with_total: bool = True
) -> DataFrame:
    """A1 (Q1): trips, average and total amount per month, month order."""
    metrics = [
        F.count(F.lit(1)).alias(TRIPS),
        F.round(F.avg(cols.amount), 2).alias(AVG_AMOUNT),
    ]
    if with_total:
        metrics.append(F.round(F.sum(cols.amount), 2).alias(SUM_AMOUNT))
    return silver.groupBy(cols.month).agg(*metrics).orderBy(cols.month)


MONTHLY_REVENUE_SQL = """
SELECT {month} AS {month_alias},
       COUNT(*) AS {trips},
       ROUND(AVG({amount}), 2) AS {avg},
       ROUND(SUM({amount}), 2) AS {sum}
FROM {view}
GROUP BY {month}
ORDER BY {month}
"""


def monthly_revenue_sql(spark, silver: DataFrame, view: str = "silver_trips",
                        cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """The same answer through a temp view and Spark SQL."""
    silver.createOrReplaceTempView(view)
    return spark.sql(
        MONTHLY_REVENUE_SQL.format(
            month=cols.month, trips=TRIPS, amount=cols.amount, avg=AVG_AMOUNT,
            sum=SUM_AMOUNT, view=view, month_alias=MONTH_ALIAS,
        )
    )


def bag_equality(left: DataFrame, right: DataFrame) -> DataFrame:
    """Compare two relations as bags (order-free, duplicates count).

    Each left row counts +1 and each right row -1; a group of equal rows whose
    sum is not 0 has that many rows on one side only. One pass over either side
    and one shuffle, with partial sums before it. One row: sizes, surplus rows
    of each side, and ``equal``.
    """
    cols = left.columns
    both = left.withColumn("_w", F.lit(1)).union(right.withColumn("_w", F.lit(-1)))  # by position
    groups = both.groupBy(*cols).agg(F.sum("_w").alias("_d"), F.count_if(F.col("_w") > 0).alias("_l"),
                                     F.count_if(F.col("_w") < 0).alias("_r"))

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0))

    return groups.agg(
        total(F.col("_l")).alias("left_rows"), total(F.col("_r")).alias("right_rows"),
        total(F.greatest(F.col("_d"), F.lit(0))).alias("only_left"),
        total(F.greatest(-F.col("_d"), F.lit(0))).alias("only_right"),
    ).withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def global_avg_amount(silver: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """A4: row-weighted average amount over the whole period."""
    return silver.agg(F.round(F.avg(cols.amount), 2).alias(GLOBAL_AVG))


def mean_of_monthly_means(q1: DataFrame) -> DataFrame:
    """A5: unweighted mean of the monthly averages (differs from A4)."""
    return q1.agg(F.round(F.avg(AVG_AMOUNT), 2).alias("media_das_medias_usd"))


def hourly_passengers(
    silver: DataFrame, month: int = 5, cols: TripColumns = DEFAULT_COLUMNS
) -> DataFrame:
    """A6 (Q2): trips and average passengers per stored pickup hour of one month."""
    return (
        silver.filter(F.col(cols.month) == F.lit(month))
        .groupBy(cols.hour)
        .agg(
            F.count(F.lit(1)).alias(TRIPS),
            F.round(F.avg(cols.passengers), 3).alias(AVG_PASSENGERS),
        )
        .orderBy(cols.hour)
    )


HOURLY_PASSENGERS_SQL = """
SELECT HOUR({pickup}) AS {hour_alias},
       COUNT(*) AS {trips},
       ROUND(AVG({passengers}), 3) AS {avg}
FROM {view}
WHERE {month_col} = {month}
GROUP BY HOUR({pickup})
ORDER BY {hour_alias}
"""


def hourly_passengers_sql(spark, silver: DataFrame, month: int = 5, view: str = "silver_trips",
                          cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Q2 in SQL, grouped by the ``HOUR(...)`` expression."""
    silver.createOrReplaceTempView(view)
    return spark.sql(
        HOURLY_PASSENGERS_SQL.format(
            pickup=cols.pickup, trips=TRIPS, passengers=cols.passengers, avg=AVG_PASSENGERS,
            view=view, month_col=cols.month, month=int(month), hour_alias=HOUR_ALIAS,
        )
    )


def trips_per_month(silver: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Rows per month."""
    return silver.groupBy(cols.month).count().orderBy(cols.month)


def profile_ranges(silver: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Min / max / average amount and min / max passengers in one pass."""
    return silver.select(  # these five names are fixed
        F.min(cols.amount).alias("min_amount"),
        F.max(cols.amount).alias("max_amount"),
        F.round(F.avg(cols.amount), 2).alias("avg_amount"),
        F.min(cols.passengers).alias("min_pax"),
        F.max(cols.passengers).alias("max_pax"),
    )


QUANTILE_PROBS = [0.5, 0.9, 0.99, 0.999]
QUANTILE_NAMES = ["p50", "p90", "p99", "p999"]


def quantiles_approx(
    silver: DataFrame,
    column: str | None = None,
    probs: list[float] | None = None,
    relative_error: float = 0.001,
) -> DataFrame:
    """A10: global approximate quantiles, kept distributed.

    ``percentile_approx`` merges fixed-size sketches (accuracy = 1 / relative
    error), so memory does not grow with the data, unlike collecting values.
    """
    column = column or DEFAULT_COLUMNS.amount
    probs = probs or QUANTILE_PROBS
    accuracy = max(1, int(round(1.0 / relative_error)))
    q = F.percentile_approx(column, F.array(*[F.lit(p) for p in probs]), accuracy)
    names = QUANTILE_NAMES if probs == QUANTILE_PROBS else [f"q{i}" for i in range(len(probs))]
    return silver.select(q.alias("_q")).select(
        *[F.col("_q")[i].alias(n) for i, n in enumerate(names)]
    )


def tail_distortion(silver: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Monthly mean vs (approximate) median and their difference."""
    median = F.percentile_approx(cols.amount, 0.5)
    return (
        silver.groupBy(cols.month)
        .agg(F.avg(cols.amount).alias("_avg"), median.alias("_median"))
        .select(
            F.col(cols.month).alias(MONTH_ALIAS),
            F.round("_avg", 2).alias(MEAN),
            F.round("_median", 2).alias(MEDIAN),
            F.round(F.col("_avg") - F.col("_median"), 2).alias(TAIL_GAP),
        )
        .orderBy(MONTH_ALIAS)
    )


# --- stored sketches: quantiles of any set of months without reading Silver again ---

SKETCH, SKETCH_ROWS, SKETCH_SUM = "sketch", "rows", "amount"
#: Size parameter of the sketches; its rank error is about 2.3 / K ** 0.9 (0.25 % at 2048).
SKETCH_K = 2048


def monthly_sketches(silver: DataFrame, cols: TripColumns = DEFAULT_COLUMNS, k: int = SKETCH_K) -> DataFrame:
    """A10 + A11: per month a mergeable quantile sketch of the amount, with its rows and sum.

    A month is one row of bounded size however many trips it has; sketches are made
    per task and merged behind the shuffle.
    """
    return silver.groupBy(cols.month).agg(
        F.kll_sketch_agg_double(F.col(cols.amount), k).alias(SKETCH), F.count(cols.amount).alias(SKETCH_ROWS),
        F.sum(cols.amount).alias(SKETCH_SUM))


def quantiles_of_sketches(sketches: DataFrame, probs: list[float] | None = None, k: int = SKETCH_K) -> DataFrame:
    """A10 over stored sketches: the quantiles of all their months together, from a row a month."""
    probs = probs or QUANTILE_PROBS
    names = QUANTILE_NAMES if probs == QUANTILE_PROBS else [f"q{i}" for i in range(len(probs))]
    whole = sketches.agg(F.kll_merge_agg_double(F.col(SKETCH), k).alias(SKETCH))
    return whole.select(*[F.kll_sketch_get_quantile_double(SKETCH, F.lit(p)).alias(n) for p, n in zip(probs, names)])


def tail_distortion_of_sketches(sketches: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """A11 over stored sketches: monthly mean, approximate median and their difference."""
    mean, median = F.try_divide(SKETCH_SUM, SKETCH_ROWS), F.kll_sketch_get_quantile_double(SKETCH, F.lit(0.5))
    return sketches.select(
        F.col(cols.month).alias(MONTH_ALIAS), F.round(mean, 2).alias(MEAN), F.round(median, 2).alias(MEDIAN),
        F.round(mean - median, 2).alias(TAIL_GAP)).orderBy(MONTH_ALIAS)


# --- measures that changes can be added to (M8) ---

MEASURE_ROWS, MEASURE_AMOUNT, MEASURE_PASSENGERS = "n", "amount", "passengers"
_EXACT = "decimal(38,6)"


def gold_measures(rows: DataFrame, sign=None, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """M8: count and sums per month and hour, which Q1 and Q2 follow from; ``sign`` weighs each row (+1 / -1).

    Amounts are summed as decimals of six places, so that taking a row away undoes
    adding it exactly.
    """
    sign = F.lit(1) if sign is None else sign
    amount = F.col(cols.amount).cast("decimal(26,6)")
    return rows.groupBy(cols.month, cols.hour).agg(
        F.sum(sign).cast("long").alias(MEASURE_ROWS), F.sum(amount * sign).cast(_EXACT).alias(MEASURE_AMOUNT),
        F.sum(F.col(cols.passengers) * sign).cast("long").alias(MEASURE_PASSENGERS))


def add_measures(stored: DataFrame, delta: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """M8: stored measures plus those of signed changes; groups that have no row left go. No trip is read."""
    both = stored.unionByName(delta).groupBy(cols.month, cols.hour).agg(
        F.sum(MEASURE_ROWS).alias(MEASURE_ROWS), F.sum(MEASURE_AMOUNT).cast(_EXACT).alias(MEASURE_AMOUNT),
        F.sum(MEASURE_PASSENGERS).alias(MEASURE_PASSENGERS))
    return both.filter(F.col(MEASURE_ROWS) != 0)


def monthly_of_measures(measures: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """A1 from measures."""
    n, amount = F.sum(MEASURE_ROWS), F.sum(MEASURE_AMOUNT).cast("double")
    return measures.groupBy(cols.month).agg(
        n.alias(TRIPS), F.round(amount / n, 2).alias(AVG_AMOUNT), F.round(amount, 2).alias(SUM_AMOUNT)).orderBy(cols.month)


def hourly_of_measures(measures: DataFrame, month: int = 5, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """A6 from measures."""
    n, passengers = F.sum(MEASURE_ROWS), F.sum(MEASURE_PASSENGERS)
    return measures.filter(F.col(cols.month) == month).groupBy(cols.hour).agg(
        n.alias(TRIPS), F.round(passengers / n, 3).alias(AVG_PASSENGERS)).orderBy(cols.hour)


def weekday_occupancy(
    silver: DataFrame, month: int = 5, cols: TripColumns = DEFAULT_COLUMNS
) -> DataFrame:
    """Trips and average passengers by weekday (1 = Sunday ... 7 = Saturday)."""
    return (
        silver.filter(F.col(cols.month) == F.lit(month))
        .groupBy(F.dayofweek(cols.pickup).alias(WEEKDAY))
        .agg(
            F.count(F.lit(1)).alias(RIDES),
            F.round(F.avg(cols.passengers), 3).alias(AVG_PAX),
        )
        .orderBy(WEEKDAY)
    )


def vendor_profile(silver: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Per vendor trips, average passengers and ticket; busiest first."""
    return (
        silver.groupBy(cols.vendor)
        .agg(
            F.count(F.lit(1)).alias(RIDES),
            F.round(F.avg(cols.passengers), 3).alias(AVG_PAX),
            F.round(F.avg(cols.amount), 2).alias(AVG_TICKET),
        )
        .orderBy(F.desc(RIDES), cols.vendor)
    )


def total_trips(q1: DataFrame) -> DataFrame:
    """Total trips as the sum of the monthly counts."""
    return q1.agg(F.sum(TRIPS).alias("total_corridas"))


def peak_month(q1: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Month of the highest average (the earliest month on ties)."""
    best = F.max_by(
        F.struct(F.col(cols.month).alias("mes_num"), F.col(AVG_AMOUNT)),
        F.struct(F.col(AVG_AMOUNT), -F.col(cols.month)),
    )
    return q1.agg(best.alias("_b")).select(
        F.col("_b.mes_num").alias(DOC_MONTH_NUM),
        month_label(F.col("_b.mes_num")).alias(MONTH_ALIAS),
        F.col(f"_b.{AVG_AMOUNT}").alias(AVG_AMOUNT),
    )


def peak_low_hour(q2: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Hours of the highest and lowest average passengers (earliest hour on ties)."""
    hour = F.col(cols.hour)
    avg = F.col(AVG_PASSENGERS)
    peak = F.max_by(F.struct(hour.alias("h"), avg.alias("v")), F.struct(avg, -hour))
    low = F.min_by(F.struct(hour.alias("h"), avg.alias("v")), F.struct(avg, hour))
    return q2.agg(peak.alias("_p"), low.alias("_l")).select(
        F.col("_p.h").alias("hora_pico"),
        F.col("_p.v").alias("media_pico"),
        F.col("_l.h").alias("hora_minima"),
        F.col("_l.v").alias("media_minima"),
    )


def weighted_passengers(q2: DataFrame) -> DataFrame:
    """Trip-weighted mean of the hourly averages."""
    return q2.agg(
        F.round(F.sum(F.col(AVG_PASSENGERS) * F.col(TRIPS)) / F.sum(TRIPS), 4).alias(
            "media_ponderada_pax"
        )
    )


def growth_first_last(q1: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Growth of the average from the first to the last month, in percent."""
    first = F.min_by(F.col(AVG_AMOUNT), F.col(cols.month))
    last = F.max_by(F.col(AVG_AMOUNT), F.col(cols.month))
    return q1.agg(
        F.min(cols.month).alias("mes_inicial"),
        F.max(cols.month).alias("mes_final"),
        F.round((last / first - F.lit(1.0)) * F.lit(100.0), 1).alias("crescimento_pct"),
    )


def demand_intensity(q2: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Each hour's trips relative to the busiest hour (window over <= 24 rows)."""
    busiest = F.max(TRIPS).over(Window.partitionBy())
    return q2.select(
        cols.hour, TRIPS, F.round(F.col(TRIPS) / busiest, 4).alias("intensidade")
    ).orderBy(cols.hour)


def monthly_and_hourly(
    silver: DataFrame, month: int = 5, cols: TripColumns = DEFAULT_COLUMNS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Q1 and Q2 from ONE scan: grouping sets ``(month), (hour)``.

    Returns ``(q1, q2, sets)``; ``sets`` is the small aggregated relation (at
    most 12 + 24 rows) both are selected from, so a caller writing both can
    persist it and scan Silver once.
    """
    in_month = F.col(cols.month) == F.lit(month)
    sets = silver.groupingSets([[cols.month], [cols.hour]], cols.month, cols.hour).agg(
        F.grouping_id().alias("_g"),
        F.count(F.lit(1)).alias("_n"),
        F.avg(cols.amount).alias("_avg_amount"),
        F.sum(cols.amount).alias("_sum_amount"),
        F.count_if(in_month).alias("_n_m"),
        F.avg(F.when(in_month, F.col(cols.passengers))).alias("_avg_pax_m"),
    )
    q1 = sets.filter(F.col("_g") == 1).select(
        cols.month,
        F.col("_n").alias(TRIPS),
        F.round("_avg_amount", 2).alias(AVG_AMOUNT),
        F.round("_sum_amount", 2).alias(SUM_AMOUNT),
    ).orderBy(cols.month)
    q2 = sets.filter((F.col("_g") == 2) & (F.col("_n_m") > 0)).select(
        cols.hour,
        F.col("_n_m").alias(TRIPS),
        F.round("_avg_pax_m", 3).alias(AVG_PASSENGERS),
    ).orderBy(cols.hour)
    return q1, q2, sets


def kpi_snapshot(silver: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Monthly trips / average plus the snapshot's total rows, in one scan."""
    per_month = silver.groupBy(cols.month).agg(
        F.count(F.lit(1)).alias(TRIPS), F.round(F.avg(cols.amount), 2).alias(AVG_AMOUNT)
    )
    return per_month.withColumn(ROWS, F.sum(TRIPS).over(Window.partitionBy())).orderBy(
        cols.month
    )


def quantiles_exact(
    df: DataFrame,
    column: str | None = None,
    probs: list[float] | None = None,
) -> DataFrame:
    """Exact continuous quantiles (linear interpolation between ranks), distributed.

    The column is reduced once to distinct values with their counts (partial
    aggregation, so a value holding a third of all rows is one row), dealt by
    value ranges and written with the number of its range. One count per range
    says which ranges hold the wanted ranks; only those are ranked, each by a
    running sum of counts. The same at any size.

    Returns one row ``p50, p90, ...`` (names as in ``quantiles_approx``).
    """
    from farebox.session import scratch_path

    column = column or DEFAULT_COLUMNS.amount
    probs = probs or QUANTILE_PROBS
    names = QUANTILE_NAMES if probs == QUANTILE_PROBS else [f"q{i}" for i in range(len(probs))]
    spark = df.sparkSession
    counted = df.select(F.col(column).cast("double").alias("v")).filter(
        F.col("v").isNotNull() & ~F.isnan("v")).groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    path = scratch_path(spark, "value-counts")
    counted.repartitionByRange("v").withColumn("part", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.schema("v double, c bigint, part int").parquet(path)
    # one row per range, in the order of the values
    sizes = dealt.groupBy("part").agg(F.sum("c").alias("n")).orderBy("part").collect()
    n = sum(r["n"] for r in sizes)
    if n == 0:
        return dealt.agg(*[F.max(F.lit(None).cast("double")).alias(nm) for nm in names])
    first = dict(zip([r["part"] for r in sizes], accumulate([0, *(r["n"] for r in sizes)])))
    ranks = {r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}
    holds = sorted({max(p for p, a in first.items() if a <= r) for r in ranks})
    w = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    start = F.try_element_at(F.create_map(*[F.lit(x) for p in holds for x in (p, first[p])]), F.col("part"))
    ranked = dealt.filter(F.col("part").isin(holds)).withColumn("upto", start + F.sum("c").over(w))

    def at(rank: int):
        return F.min(F.when(F.col("upto") > rank, F.col("v")))

    def quantile(p: float):
        low, high, share = math.floor(p * (n - 1)), math.ceil(p * (n - 1)), p * (n - 1) % 1
        return F.round(at(low) + (at(high) - at(low)) * F.lit(share), 4)

    return ranked.agg(*[quantile(p).alias(nm) for p, nm in zip(probs, names)])

"""Partitioned writes of the layers.

* Bronze: partitioned by source month, **dynamic** partition overwrite set
  per write, so re-landing one month replaces only that month (backfill). Its rows
  come by month from the landing files and are not shuffled.
* Silver / Gold fact: partitioned by ``trip_month``. A ``rebalance`` hint on
  the partition column replaces the usual ``repartition(col)``: rows of a
  month still go to the same writer(s), but AQE splits a month that is
  larger than the advisory partition size over several tasks (one file per
  month on small data, many bounded files on a 100 TB month instead of one
  task writing the whole month).
* Gold aggregates: tiny, one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from farebox.config import DEFAULT_COLUMNS, TripColumns


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: list[str],
    mode: str = "overwrite",
    dynamic: bool = True,
    fmt: str = "parquet",
    balance: bool = True,
) -> None:
    """K1/K2: partitioned write; ``dynamic`` replaces only the partitions present in ``df``."""
    out = df.hint("rebalance", *partition_cols) if balance else df
    writer = out.write.mode(mode).format(fmt).partitionBy(*partition_cols)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    writer.save(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                single_file: bool = False) -> None:
    """K3: plain (unpartitioned) write; ``single_file`` for small aggregates."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).format(fmt).save(path)


def write_silver(
    silver: DataFrame,
    path: str,
    cols: TripColumns = DEFAULT_COLUMNS,
    expectations=None,
    fmt: str = "parquet",
):
    """K2 + K5 + D8: staged write that observes the checks, gate, then publish.

    The rows are written once to the shared scratch folder while the checks ride
    along, so nothing is kept in executors. Only if the gate passes is the staged
    layer copied over ``path``, which therefore never holds rows that failed.
    Returns the check results.

    This is a full refresh (static overwrite): Spark clears the target before
    the copy, so a copy that dies part-way leaves the path empty and is run again.
    Where readers must never see that, use ``jobs.silver_publish_job``.
    """
    from farebox.operators.quality import gate, observe_checks, observed_results
    from farebox.session import remove_path, scratch_path

    spark = silver.sparkSession
    stage = scratch_path(spark, "silver-stage")
    try:
        checked, obs = observe_checks(silver, expectations, name=stage.rsplit("/", 1)[-1], cols=cols)
        write_partitioned(checked, stage, [cols.month], fmt=fmt)
        results = gate(observed_results(obs))
        staged = spark.read.format(fmt).schema(silver.schema).load(stage)
        write_partitioned(staged.select(*silver.columns), path, [cols.month], fmt=fmt, dynamic=False)
        return results
    finally:
        remove_path(spark, stage)


def write_gold(silver: DataFrame, gold_root: str, month: int = 5,
               cols: TripColumns = DEFAULT_COLUMNS, fmt: str = "parquet") -> dict[str, str]:
    """K3 + K4: the two aggregate tables and the granular fact table."""
    from farebox.operators.aggregates import monthly_and_hourly

    root = gold_root.rstrip("/")
    paths = {
        "agg_receita_mensal": f"{root}/agg_receita_mensal",
        "agg_passageiros_hora_maio": f"{root}/agg_passageiros_hora_maio",
        "trips": f"{root}/trips",
    }
    # Q1 and Q2 from one grouping-sets scan of Silver; the <= 36 aggregated
    # rows are cached so the two small writes do not scan Silver again.
    q1, q2, sets = monthly_and_hourly(silver, month, cols)
    sets.persist()
    try:
        write_table(q1, paths["agg_receita_mensal"], fmt=fmt, single_file=True)
        write_table(q2, paths["agg_passageiros_hora_maio"], fmt=fmt, single_file=True)
    finally:
        sets.unpersist()
    fact = silver.select(*cols.required, cols.month)
    write_partitioned(fact, paths["trips"], [cols.month], fmt=fmt, dynamic=False)
    return paths

"""File-arrival ingestion with Structured Streaming.

X1  Idempotent arrival: a file-source stream (explicit schema, no inference) hands each
    landing file over once; a ledger of months, met in ``foreachBatch``, keeps a month
    that is already present from being added again by a new delivery.
X2  Late data through the upsert: ``foreachBatch`` merges each micro-batch into a keyed
    Silver table by the gated incremental job. The arrival of a row's file decides which
    of two rows of a key is the newer one, so the table does not depend on how files
    fall into batches, nor on a replay.

Both run with ``trigger(availableNow=True)``: everything that has arrived is processed,
then the query stops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.config import DEFAULT_COLUMNS, DateWindow, TripColumns
from farebox.session import path_exists
from farebox.sinks.keyed import KeyedTable
from farebox.sources.landing import SOURCE_MONTH_PATTERN

#: Lineage columns of the stream: they tell which of two rows has arrived later.
ARRIVED, SOURCE_FILE, SOURCE_MONTH = "_arrived", "_source_file", "_source_month"
ARRIVAL_SEQUENCE = (ARRIVED, SOURCE_FILE)
BATCH = "_batch"


def landing_stream(spark: SparkSession, landing: str, schema: T.StructType,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    # Month files are directories of part files; the month comes from the file
    # path, so recurse instead of relying on key=value partition discovery.
    reader = (spark.readStream.schema(schema).format("parquet")
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(landing)
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path")).withColumn(
        SOURCE_MONTH, F.regexp_extract(F.col("_metadata.file_path"), SOURCE_MONTH_PATTERN, 1)
    ).withColumn(ARRIVED, F.col("_metadata.file_modification_time"))


def delivery(file: Column) -> Column:
    """The write that a landing file belongs to: part files of one write differ in their part number alone."""
    return F.regexp_replace(file, r"/part-\d+-([0-9a-f-]{36})[^/]*$", "/$1")


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """(month, delivery, arrived, batch): the delivery that each month was taken from."""
    schema = f"month string, delivery string, arrived timestamp, {BATCH} long"
    return spark.read.schema(schema).parquet(ledger) if path_exists(spark, ledger) else spark.createDataFrame([], schema)


def accept_months(found: DataFrame, ledger: DataFrame) -> DataFrame:
    """The months of ``found`` (month, delivery, arrived) that the ledger has not got, each with its first delivery."""
    new = found.join(ledger.select("month"), "month", "left_anti")
    return new.groupBy("month").agg(F.min(F.struct("arrived", "delivery")).alias("f")).select(
        "month", "f.delivery", "f.arrived")


def ingest_available(spark: SparkSession, landing: str, bronze: str, checkpoint: str,
                     schema: T.StructType, max_files_per_trigger: int | None = None) -> int:
    """Add the landing files of every month not yet present to Bronze; returns rows added.

    A month belongs to the delivery (see ``delivery``) that brought it first; further
    part files of that delivery are added in whichever batch they come, a month delivered
    again is skipped. Files without a month in their name stand for themselves. Bronze
    and the ledger (``<bronze>_ledger``) are partitioned by batch, so a batch that runs
    again after a failure replaces what it had written.
    """
    ledger_path = f"{bronze.rstrip('/')}_ledger"
    added: list[int] = []

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = delivery(F.col(SOURCE_FILE))
        rows = batch.withColumn("_delivery", own).withColumn(
            "_month", F.when(F.col(SOURCE_MONTH) == "", own).otherwise(F.col(SOURCE_MONTH)))
        # from the files' names and times alone: no data column is read for it
        found = rows.groupBy(F.col("_month").alias("month"), F.col("_delivery").alias("delivery")).agg(F.min(ARRIVED).alias("arrived"))
        before = read_ledger(spark, ledger_path).filter(F.col(BATCH) < batch_id).drop(BATCH)
        accept_months(found, before).withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(ledger_path)
        taken = read_ledger(spark, ledger_path).filter(F.col(BATCH) <= batch_id).select(
            F.col("month").alias("_month"), F.col("delivery").alias("_delivery"))
        counts = Observation()
        (rows.join(taken, ["_month", "_delivery"], "left_semi").drop("_month", "_delivery", ARRIVED)
         .withColumn("_ingested_at", F.current_timestamp()).withColumn(BATCH, F.lit(batch_id))
         .observe(counts, F.count(F.lit(1)).alias("rows"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(SOURCE_MONTH, BATCH).parquet(bronze))
        added.append(counts.get["rows"])

    _run(landing_stream(spark, landing, schema, max_files_per_trigger), add, checkpoint)
    return sum(added)


def upsert_available(spark: SparkSession, landing: str, table: KeyedTable, checkpoint: str,
                     schema: T.StructType, window: DateWindow, cols: TripColumns = DEFAULT_COLUMNS,
                     max_files_per_trigger: int | None = 64, tie_break: list[str] | None = None) -> int:
    """Every landing file not seen before, cleaned, gated and merged into ``table``.

    ``table.sequence`` is ``ARRIVAL_SEQUENCE``: the file that arrived last wins.
    ``max_files_per_trigger`` bounds a micro-batch and nothing else. Returns the
    cleaned rows merged. Each micro-batch's stage is removed when it is merged.
    """
    from farebox.plans.jobs import incremental_silver_job

    merged: list[int] = []

    def merge_batch(batch: DataFrame, _batch_id: int) -> None:
        merged.append(incremental_silver_job(batch.sparkSession, batch, table, window, tie_break)["source_rows"])

    _run(landing_stream(spark, landing, schema, max_files_per_trigger), merge_batch, checkpoint)
    return sum(merged)


def _run(stream: DataFrame, each, checkpoint: str) -> None:
    query = (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()

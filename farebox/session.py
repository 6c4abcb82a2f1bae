"""Session-level helpers: where to put scratch tables, and small conf guards.

Scratch output (sink queries, lineage cuts, stream checkpoints) goes to the
shared folder the cluster names in ``spark.checkpoint.dir``. Only when that
is unset (local tests) do we create a folder and register it ourselves.
"""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a folder of its own. On a
    cluster no folder of one machine would do, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not sc.master.split("[")[0] == "local":
                raise ValueError(f"set spark.checkpoint.dir to a folder that all of {sc.master} can reach")
            named = tempfile.mkdtemp(prefix="farebox-ckpt-")
        sc.setCheckpointDir(named)
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/farebox/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a (Hadoop-compatible) path exists, without raising through a read."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of our own and all below it; one that is not there is fine."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """The folders that a (Hadoop-compatible) glob pattern finds."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hpath)
    return sorted(f.getPath().toString() for f in found or [])


#: Beyond so many shuffle partitions the block table of a stage (maps x partitions) outgrows the driver.
MOST_SHUFFLE_PARTITIONS = 20_000


def cluster_settings(input_bytes: int, total_cores: int, shuffled_bytes: int | None = None,
                     target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Session settings sized for a large input (apply them when building the session).

    * Scan splits of ``target_partition_bytes``; a 400 MB monthly file is a couple of tasks.
    * Shuffle width from the bytes that are shuffled, not from the input: cleaning shuffles
      five narrow columns of the rows that pass the rules, by default taken as a fifth
      of the input. One partition per target size, at least twice the cores; when that
      is more than ``MOST_SHUFFLE_PARTITIONS``, partitions grow instead, and spill.
    * Skew-join splitting on, so a key holding a third of one side is cut into pieces.
    * Nanosecond timestamps as bigint, which the landing reader turns into wall clocks.
    """
    shuffled = input_bytes // 5 if shuffled_bytes is None else shuffled_bytes
    width = min(MOST_SHUFFLE_PARTITIONS, max(2 * total_cores, math.ceil(shuffled / target_partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.legacy.parquet.nanosAsLong": "true",
    }

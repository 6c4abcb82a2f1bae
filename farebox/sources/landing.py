"""Monthly landing files whose physical schema drifts, read into Bronze.

Months differ in integer widths (INT32 vs INT64), in integer vs double,
in timestamp unit (TIMESTAMP(NANOS) vs MICROS) and in column-name case
(``airport_fee`` / ``Airport_fee``), and some columns exist in one month
only. One scan over files of different physical types fails, so:

1. all part files of all months are grouped by the schema in their own footers, so drift
   inside a month is found too, and each group is ONE scan (a few scans instead of one per
   month, so no deep union);
2. each group casts drifting columns to their canonical (widest) type;
3. groups are unioned by name (case-insensitive, missing columns null);
4. ``*datetime*`` columns that arrived as bigint nanoseconds are turned
   back into wall-clock ``timestamp_ntz``;
5. lineage: source file and month are taken from ``_metadata.file_path``
   *before* the union (the hidden column does not survive a union), the
   month anchored on the file name, not on any directory that looks like a
   month.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.config import CANONICAL_NAMES, CANONICAL_TYPES, LANDING_FILE_PREFIX
from farebox.functions.columns import nanos_to_timestamp_ntz

SOURCE_MONTH_PATTERN = LANDING_FILE_PREFIX + r"(\d{4}-\d{2})\.parquet(?:/|$)"


def landing_path(landing: str, month: str, template: str = LANDING_FILE_PREFIX + "{month}.parquet"
                 ) -> str:
    return f"{landing.rstrip('/')}/{template.format(month=month)}"


def normalise_types(df: DataFrame, canonical: dict[str, str] | None = None) -> DataFrame:
    """Each drifting column that exists, in its canonical type (one projection).

    A value that does not fit becomes null instead of ending the load; ``lost_values`` counts them.
    """
    wanted = _wanted(df, canonical)
    return df.select(*[F.col(f"`{c}`").try_cast(wanted[c]).alias(c) if c in wanted else F.col(f"`{c}`")
                       for c in df.columns])


def lost_values(df: DataFrame, canonical: dict[str, str] | None = None) -> DataFrame:
    """One row: for each drifting column, how many values ``normalise_types`` turns into null."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(t).isNull()).alias(c)
                    for c, t in _wanted(df, canonical).items()])


def _wanted(df: DataFrame, canonical: dict[str, str] | None) -> dict[str, str]:
    types = {k.lower(): v for k, v in (CANONICAL_TYPES if canonical is None else canonical).items()}
    return {c: types[c.lower()] for c in df.columns if c.lower() in types}


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """S3: UNION ALL by (case-insensitive) name; a column missing on one side is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def recover_nanos(df: DataFrame, marker: str = "datetime") -> DataFrame:
    """``*datetime*`` columns of bigint nanoseconds back to wall-clock timestamps.

    Other columns, and datetime columns already typed as timestamps, pass
    through untouched.
    """
    out = []
    for f in df.schema.fields:
        if marker in f.name.lower() and isinstance(f.dataType, T.LongType):
            out.append(nanos_to_timestamp_ntz(f.name).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def source_month(path_col) -> F.Column:
    """``yyyy-MM`` from the landing file name (empty string when absent)."""
    return F.regexp_extract(path_col, SOURCE_MONTH_PATTERN, 1)


def _with_lineage(df: DataFrame) -> DataFrame:
    """S5 + S6 on one scan (``_metadata`` is only available before a union)."""
    return df.withColumn("_source_file", F.col("_metadata.file_path")).withColumn(
        "_source_month", source_month(F.col("_metadata.file_path"))
    )


def part_files(spark: SparkSession, path: str) -> list[str]:
    """The data files of a landing month: the file itself, or all files below the folder."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    if not fs.getFileStatus(root).isDirectory():
        return [path]
    found, files = fs.listFiles(root, True), []
    while found.hasNext():
        file = found.next().getPath()
        if not file.getName().startswith(("_", ".")):
            files.append(file.toString())
    return sorted(files)


def footer_schema(spark: SparkSession, file: str) -> str:
    """The schema that a Parquet file's footer states; no row is read and no Spark job runs."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(at)
    try:
        return reader.getFooter().getFileMetaData().getSchema().toString().split("\n", 1)[1]  # without the writer's name for it
    finally:
        reader.close()


def group_by_schema(spark: SparkSession, paths: list[str], threads: int = 32) -> list[list[str]]:
    """Group landing paths by the physical schema of their files.

    Every footer of every part file is read, overlapped by a thread pool on the driver, so
    no Spark job is started however many months there are. A month whose files agree
    stays one path; one whose files differ is given file by file. Group order follows the
    first path of each group.
    """
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(paths)))) as pool:
        files = list(pool.map(lambda p: part_files(spark, p), paths))
        flat = [(k, f) for k, own in enumerate(files) for f in own]
        schemas = list(pool.map(lambda x: footer_schema(spark, x[1]), flat))
    kinds: dict[int, set[str]] = {}
    for (k, _), schema in zip(flat, schemas):
        kinds.setdefault(k, set()).add(schema)
    groups: dict[str, list[str]] = {}
    for (k, file), schema in zip(flat, schemas):
        own = groups.setdefault(schema, [])
        path = paths[k] if len(kinds[k]) == 1 else file
        if not own or own[-1] != path:
            own.append(path)
    return list(groups.values())


def read_landing(
    spark: SparkSession,
    landing: str,
    months: list[str],
    template: str = LANDING_FILE_PREFIX + "{month}.parquet",
    lineage: bool = True,
    canonical: dict[str, str] | None = None,
) -> DataFrame:
    """The configured months' landing files as one Bronze relation.

    Columns: all source columns (canonical types, nanos recovered), then
    ``_source_file``, ``_ingested_at`` and ``_source_month`` when
    ``lineage``. Files with TIMESTAMP(NANOS) columns need the session setting
    ``spark.sql.legacy.parquet.nanosAsLong`` (in ``session.cluster_settings``).
    """
    paths = [landing_path(landing, m, template) for m in months]
    frames = []
    for group in group_by_schema(spark, paths):
        scan = spark.read.parquet(*group)
        if lineage:
            scan = _with_lineage(scan)
        # nanos are recovered per group: a bigint column cannot be unioned
        # with the timestamp column of a microsecond month
        frames.append(canonical_names(recover_nanos(normalise_types(scan, canonical))))
    df = union_by_name(frames)
    if lineage:
        lineage_cols = ["_source_file", "_source_month"]
        df = df.select(
            *[c for c in df.columns if c not in lineage_cols],
            "_source_file",
            F.current_timestamp().alias("_ingested_at"),
            "_source_month",
        )
    return df


def canonical_names(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Spell case-variant columns one way (``Airport_fee`` -> ``airport_fee``)."""
    names = CANONICAL_NAMES if names is None else names
    by_lower = {n.lower(): n for n in names}
    return df.select(*[F.col(f"`{c}`").alias(by_lower.get(c.lower(), c)) for c in df.columns])


def write_bronze(df: DataFrame, bronze: str, fmt: str = "parquet") -> None:
    """K1: Bronze partitioned by source month, dynamic overwrite (per-month backfill).

    A landing file holds one month, so the tasks that read the files write the months as
    they are: nothing is shuffled, and a month gets a file for each task that read some of it.
    """
    from farebox.sinks.layout import write_partitioned

    write_partitioned(df, bronze, ["_source_month"], dynamic=True, fmt=fmt, balance=False)

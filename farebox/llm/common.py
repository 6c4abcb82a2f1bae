"""Helpers shared by the training-data operators."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.session import scratch_path

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing)
    and gives the reader exact sizes, so Spark broadcasts only what is small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def private(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (compared without case)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also when ``body`` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes the built-in fast path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def row_key(df: DataFrame) -> tuple[Column, Column]:
    """Two independent hashes over all columns; rows that agree on both are copies of one row.

    Map columns can't be hashed by Spark, so they are hashed through their JSON text.
    """
    cols = [F.to_json(F.col(f"`{f.name}`")) if f.dataType.typeName() == "map" else F.col(f"`{f.name}`")
            for f in df.schema.fields]
    return F.xxhash64(*cols), F.hash(*cols)


def doc_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text modulo ``modulus`` (null counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus

"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding.

Each stage is one of the operators of ``farebox.llm``, takes (spark, docs, sf_dir) and
returns a DataFrame; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm import decontam, langid, mixing, queries, simhash
from farebox.llm.common import doc_bucket, materialize, table

#: The least posterior probability with which a document's language is accepted.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that have a language: some letter, and a prediction of at least LEAST_SCORE."""
    model = langid.train(docs.filter(doc_bucket(F.col("doc_id"), queries.LEARN_LANG) != 1))
    return langid.accepted(docs, model, LEAST_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one with the least doc_id, of each SimHash component."""
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without a benchmark window."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; those of sources below their target weight again in later passes.

    The rows are written in the order of the mixture, which is that of the files and of the rows in them.
    """
    mixed = mixing.mix(docs)
    slot, place = mixed.columns[-6], mixed.columns[-1]
    return mixed.repartitionByRange(slot, place).sortWithinPartitions(slot, place).select(*[F.col(f"`{c}`") for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The placement of every row of the mixture; each shard keeps the mixture's order."""
    return queries.placement(docs, queries.file_order(docs))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mix_sources", mix_sources), ("shard", shard)]

#: No SQL for naive Bayes, SimHash or the block schedule; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each result written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

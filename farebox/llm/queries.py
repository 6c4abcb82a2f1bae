"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm import chat, decontam, langid, lm, milquality, mixing, pii, sharding, simhash, topk, trie, urlfilter, whitening
from farebox.llm.common import doc_bucket, materialize, table
from farebox.session import scratch_path

#: Fixed rules of the URL query, then the pattern rules that judge what they leave.
URL_RULES = [
    urlfilter.Rule("allow", "org", "/"),
    urlfilter.Rule("block", "example.org", "/es/"),
    urlfilter.Rule("block", "example.org", "/en/1"),
    urlfilter.Rule("allow", "com", "/fr/"),
    urlfilter.Rule("block", "com", "/de/"),
    urlfilter.Rule("block", pattern=r"(?:^|\.)spam-farm\.", sure=("spam", "farm")),
    urlfilter.Rule("block", pattern=r"(?:^|\.)cheap-pills\.", sure=("cheap", "pills")),
    urlfilter.Rule("block", pattern=r"(?:^|\.)casino-[a-z]+\.", sure=("casino",)),
    urlfilter.Rule("block", pattern=r"(?:^|\.)adult-[a-z]+\.", sure=("adult",)),
    urlfilter.Rule("block", pattern=r"(?:^|\.)free-bets\.", sure=("free", "bets")),
    urlfilter.Rule("block", pattern=r"(?:^|\.)ads-track\.", sure=("ads", "track")),
]
OLD_SHARDS, SHARDS = 16, 16
LEARN_LANG, LEARN_LM, LEARN_QUALITY = 3, 10, 5
EXTRA_TEXT = "\\### Assistant: </turn> ok"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*pii.BASE_KINDS))
    found = pii.find_pii(table(spark, sf_dir, "documents"))

    def number_of(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[number_of(k) for k in pii.KINDS],
        F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(spans).alias("spans"),
        F.array_min(F.transform(spans, lambda s: s["score"])).alias("least_score"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    mixed = mixing.mix(docs)
    return mixed.select("doc_id", "source", *[F.col(f"__{c}").alias(c) for c in (
        "slot", "place", "block", "epoch", "release", "deadline")])


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.col("n_hit").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def old_shards():
    """The layout to mend: every source whole in the shard that its name's crc32 gives."""
    return F.crc32(F.coalesce("source", F.lit("")).cast("binary")) % OLD_SHARDS


def placement(docs: DataFrame, order: tuple[Column, Column] | None = None) -> DataFrame:
    """The placement of every row, whose shards are then written below the shared scratch folder, sorted by slot."""
    placed = materialize(sharding.reshard(docs, old_shards(), SHARDS, order=order), "placement")
    path = scratch_path(docs.sparkSession, "shards")
    affected = sharding.rewrite_affected(docs, placed, path)
    untouched = [s for s in range(SHARDS) if s not in affected]
    if not placed.filter(F.col("shard").isin(untouched)).isEmpty():  # the given table is not laid out: these have no files yet
        sharding.write_shards(docs, placed, path, untouched)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "old_shard", "moved")


#: Rows of a file that are numbered together.
FILE_BLOCK = 4096


def file_order(docs: DataFrame) -> tuple[Column, Column] | None:
    """The order in which the rows were written, if ``docs`` is read from Spark's part files; else None."""
    try:
        docs.select("_metadata.file_name", "_metadata.row_index")
    except AnalysisException:
        return None
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).try_cast("int")
    return F.struct(part.alias("part"), F.floor(F.col("_metadata.row_index") / FILE_BLOCK).alias("block")), F.col("_metadata.row_index")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placement(table(spark, sf_dir, "documents"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = doc_bucket(F.col("doc_id"), LEARN_LANG) == 1
    model = langid.train(docs.filter(~held))
    return langid.predict(docs, model, {"doc_id": F.col("doc_id"), "held_out": held})


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), {"doc_id": F.col("doc_id")}, "doc_id")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("least").alias("component_id"))


def op8_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = doc_bucket(F.col("doc_id"), LEARN_LM) == 0
    return lm.score(docs, ~held, {"doc_id": F.col("doc_id"), "held_out": held})


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kinds = dict(rows.dtypes)
    own = spark.range(2).select(
        F.lit(-7).cast(kinds["conv_id"]).alias("conv_id"), F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA_TEXT).alias("text"))
    made = chat.format_conversations(rows.unionByName(own)).select(
        "*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss_text(F.col("segments")).alias("loss_text"))
    return made.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""),
               256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid", F.col("refused_at").cast("long").alias("refused_at"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = doc_bucket(F.col("doc_id"), LEARN_QUALITY) == 0
    model = milquality.train(docs.filter(~held), table(spark, sf_dir, "labels"))
    scored = milquality.predict(docs, model, {"doc_id": F.col("doc_id"), "held_out": held})
    return scored.withColumn("predicted", F.when(F.col("score") >= milquality.THRESHOLD, 1).otherwise(0))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_pii, op2_mixing, op3_decontamination, op4_topk, op5_sharding, op6_langid, op7_simhash, op8_urlfilter,
        op9_lm, op10_chat, op11_prefix_trie, op12_quality, op13_whitening)}

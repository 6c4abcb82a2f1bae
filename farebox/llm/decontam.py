"""Benchmark decontamination by winnowing.

A window is ``WINDOW`` consecutive item words (a shorter item is one window). Both
sides hash every ``GRAM`` consecutive words and keep the least hash of each run of
``WINDOW - GRAM + 1`` grams, so any shared span of ``WINDOW`` words shares a kept
hash. Kept hashes of the documents meet those of the benchmark; each hit is extended
to the at most ``WINDOW - GRAM + 1`` windows that hold it, whose hashes it carries, and
a window counts only if its hash (64 bits, over the grams that cover it) is one of
the benchmark's. Items of fewer words have no kept gram; each such length is met gram
by gram instead.

Everything is DataFrame expressions. The benchmark side is broadcast only after
its size has been counted (``BROADCAST_ROWS``); otherwise both sides shuffle on
the hash, and one side of every join is unique in its key. A document is known by
its id and a hash of its text, so repeated rows give a row each. Null text has no
words. An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import let, lower_ascii, materialize, private

WINDOW, GRAM = 10, 5
#: The benchmark's tables are broadcast if it has at most so many pairs of item and window (16-200 bytes each).
BROADCAST_ROWS = 100_000
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEED = "struct<pos:int,kind:int,fp:bigint,wins:array<bigint>>"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _run(values: Column, i: Column, k: int) -> list[Column]:
    """``k`` entries from the 0-based place ``i`` on; far cheaper than ``slice`` inside a lambda."""
    return [F.get(values, i + j) for j in range(k)]


def _places(values: Column, k: int) -> Column:
    """0-based places of all runs of ``k`` entries."""
    return F.when(F.size(values) >= k, F.sequence(F.lit(0), F.size(values) - k)).otherwise(F.array().cast("array<int>"))


def _grams(h: Column, k: int) -> Column:
    """Hash of every ``k`` consecutive entries of ``h``: the same as the hash of an array of them."""
    return F.transform(_places(h, k), lambda i: F.xxhash64(*_run(h, i, k)))


def _winnowed(g: Column, w: int) -> Column:
    """Distinct 1-based places of the leftmost least entry of every ``w`` consecutive entries.

    The place differs from the window before only if the least entry does, or if that entry has just left.
    """
    def changes(least: Column) -> Column:
        at = F.filter(_places(g, w), lambda i: (i == 0) | (F.get(least, i) != F.get(least, i - 1)) | (
            F.get(least, i) == F.get(g, i - 1)))
        return F.transform(at, lambda i: i + F.array_position(F.array(*_run(g, i, w)), F.get(least, i)).cast("int"))

    return let(F.transform(_places(g, w), lambda i: F.least(*_run(g, i, w))), changes)


def _window_hash(g: Column, i: Column) -> Column:
    """Hash of the window at the 0-based place ``i``, over grams that cover it end to end."""
    return F.xxhash64(*[F.get(g, i + j) for j in (*range(0, WINDOW - GRAM, GRAM), WINDOW - GRAM)])


def _seeds(h: Column, short: list[int]) -> Column:
    """A document's kept grams, each with the hashes of the windows that may hold it (null beyond the text's
    ends), and its grams of the short items' lengths."""
    span = WINDOW - GRAM + 1

    def seed(pos, kind, fp, wins) -> Column:
        return F.struct(pos.alias("pos"), F.lit(kind).alias("kind"), fp.alias("fp"), wins.alias("wins"))

    def kept(g: Column) -> Column:
        windows = F.transform(_places(g, span), lambda i: _window_hash(g, i))
        return let(windows, lambda w: F.transform(_winnowed(g, span), lambda p: seed(
            p, 0, F.get(g, p - 1), F.array(*_run(w, p - span, span)))))

    none = F.lit(None).cast("array<bigint>")

    def whole(k: int) -> Column:
        return F.transform(_grams(h, k), lambda fp, i: seed(i + 1, k, fp, none))

    return F.concat(let(_grams(h, GRAM), kept), *map(whole, short))


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item, kind, len, whash, fp): kind 0 for full windows, else the short item's length."""
    w = items.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("w")).filter(F.size("w") > 0)

    def window(kind, length, whash, fp):
        return F.struct(kind.alias("kind"), length.alias("len"), whash.alias("whash"), fp.alias("fp"))

    def of(h: Column) -> Column:
        span = WINDOW - GRAM + 1
        full = let(_grams(h, GRAM), lambda g: F.transform(_places(g, span), lambda i: window(
            F.lit(0), F.lit(WINDOW), _window_hash(g, i), F.least(*_run(g, i, span)))))
        only = F.array(window(F.size(h), F.size(h), F.xxhash64(h), F.xxhash64(h)))
        return F.when(F.size(h) >= WINDOW, full).otherwise(only)

    return w.select("item_id", F.explode(let(_hashes(F.col("w")), of)).alias("x")).select("item_id", "x.*").distinct()


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id") -> DataFrame:
    """One row per document row: doc id, text_hash, n_words, n_hit, items (sorted item ids as strings)."""
    bench = materialize(benchmark_windows(items, item_col), "bench-windows")
    prints = bench.select("fp").distinct().withColumn("known", F.lit(True))
    windows = bench.groupBy("len", "whash").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("window_items"))
    if bench.count() <= BROADCAST_ROWS:  # bounds the entries of both, long item lists included
        prints, windows = F.broadcast(prints), F.broadcast(windows)
    short = sorted(r["kind"] for r in bench.filter("kind > 0").select("kind").distinct().collect())  # under WINDOW

    text = F.col(f"`{text_col}`")
    own = F.xxhash64(F.lit(0), text)
    # each document also sends one row of kind -1, so that it is present without any hit
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), own.alias("text_hash"), let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), F.concat(
            F.array(F.struct(F.lit(0).alias("pos"), F.lit(-1).alias("kind"), own.alias("fp"),
                             F.lit(None).cast("array<bigint>").alias("wins"))).cast(f"array<{SEED}>"),
            let(_hashes(w), lambda h: _seeds(h, short)).cast(f"array<{SEED}>")).alias("seeds"))).alias("x")
    ).select("id", "text_hash", F.col("x.n").alias("n_words"), F.inline("x.seeds"))
    met = rows.join(prints, "fp", "left").filter("known or kind = -1")

    # the windows of a kept gram start at pos - (WINDOW - GRAM) and after; a null hash meets none
    found = F.struct(F.lit(None).cast("int").alias("start"), F.lit(0).alias("len"), F.lit(None).cast("long").alias("whash"))
    tries = F.when(F.col("kind") == -1, F.array(found)).when(F.col("kind") > 0, F.array(F.struct(
        F.col("pos").alias("start"), F.col("kind").alias("len"), F.col("fp").alias("whash")))).otherwise(
        F.transform("wins", lambda x, j: F.struct(
            (F.col("pos") - (WINDOW - GRAM) + j).alias("start"), F.lit(WINDOW).alias("len"), x.alias("whash"))))
    hits = met.select("id", "text_hash", "n_words", F.inline(tries)).join(
        windows, ["len", "whash"], "left").filter("window_items is not null or len = 0")

    spans = F.collect_set(F.when(F.col("len") > 0, F.col("start").cast("long") * 16 + F.col("len")))
    each = hits.groupBy("id", "text_hash").agg(
        F.max("n_words").alias("n_words"), F.count_if(F.col("len") == 0).alias("copies"),
        spans.alias("spans"), F.collect_set("window_items").alias("sets"))

    def cover(acc: Column, x: Column) -> Column:
        last = F.floor(x / 16) + x % 16 - 1
        return F.struct(
            (acc["n"] + F.greatest(last - F.greatest(acc["last"], F.floor(x / 16) - 1), F.lit(0))).alias("n"),
            F.greatest(acc["last"], last).alias("last"))

    covered = F.aggregate(F.sort_array("spans"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("last")), cover)["n"]
    return each.select(
        F.col("id").alias(id_col), "text_hash", "n_words", covered.alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("sets"))).alias("items"),
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copy")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, n_words) of the documents that hold a benchmark window.

    The word count stays in the result on purpose: without it the optimizer takes the struct of
    words apart and evaluates the winnowing again in a filter pushed below its explode.
    """
    return contamination(docs, items, id_col, text_col).filter("n_hit > 0").select(id_col, "text_hash", "n_words").distinct()


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, without those that hold a benchmark window."""
    mark, own, id_ = (private(docs, x) for x in ("text_hash", "dirty_hash", "dirty_id"))
    dirty = materialize(contaminated(docs, items, id_col, text_col), "contaminated").select(
        F.col(id_col).alias(id_), F.col("text_hash").alias(own))
    return docs.withColumn(mark, F.xxhash64(F.lit(0), F.col(f"`{text_col}`"))).join(
        dirty, (F.col(mark) == F.col(own)) & F.col(f"`{id_col}`").eqNullSafe(F.col(id_)), "left_anti").drop(mark)

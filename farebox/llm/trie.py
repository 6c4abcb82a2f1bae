"""Prefix trie of conversations, with subtree totals by a depth-band rollup.

A node is a distinct sequence of the first d turns (role, text); the root has depth 0 and
no turn. Sequences are told apart by a 128-bit hash which is a sum over places and turns,
so the hashes of all prefixes are running sums: a conversation of any length is cut into
chunks by a range sort, summed chunk by chunk, and the chunks' totals are added up. No
conversation, and no node's members, are gathered in one place.

Subtree totals: bands are ``BAND`` depths high. Each node knows the keys of its ancestors
from the start of its band on (1 to ``BAND``) and explodes to them alone, once. Band roots
are then nodes of a trie whose depths are ``BAND`` times smaller; it is rolled up in the
same way, band by band of bands, and each completed band-root total explodes to the
ancestors in the band above it. So a row becomes at most ``BAND + 1`` rows, and the
rounds are the logarithm of the greatest depth to the base ``BAND``.

Turns are ordered by ``turn`` (null first), then role, then the SHA-256 of the text; rows
that agree on all of them are copies and interchangeable. Null role and text are empty.
Rows with a null conversation id belong to no conversation and take no part. Repeated rows
are repeated turns. An empty table gives no node, not even a root. Other columns are not
looked at. A text, like the list of the keys above a node, must fit in a task.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import materialize

BAND = 16
#: Conversation c takes its first crc32(c) % HEADS turns from conversation c - c % FAMILY.
FAMILY, HEADS = 20, 4
#: Conversation ids whose decimal text is joined in one piece.
PIECE = 1 << 16
WORDS = r"[^\x20\x09-\x0D]+"
KEY = ["depth", "k1", "k2"]
NO_IDS = hashlib.sha256(b"").hexdigest()


def narrow(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, sha, words) of every row with a conversation."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    return rows.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), F.unhex(F.sha2(text, 256)).alias("sha"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"))


def chunked(rows: DataFrame) -> DataFrame:
    """The narrow rows with a chunk number that rises with a conversation's turns; no chunk holds a large share of all rows."""
    rows = materialize(narrow(rows), "trie-turns").withColumn("copy", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange("conv", F.col("turn").asc_nulls_first(), "role", "sha", "copy")
    return materialize(dealt.withColumn("chunk", F.spark_partition_id()).drop("copy"), "trie-chunks")


def running(of: str, by: list[str], order: list[Column | str], before: bool = False) -> Column:
    over = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    return F.coalesce(F.sum(of).over(over), F.lit(0))


def conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per chunk (conv, chunk, before) and per conversation (conv, base, total, h, taken: turns that base gives)."""
    sizes = turns.groupBy("conv", "chunk").agg(F.count("*").alias("n"))
    chunks = materialize(sizes.withColumn("before", running("n", ["conv"], ["chunk"], before=True)), "trie-chunk-sizes")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    convs = chunks.groupBy("conv").agg(F.sum("n").alias("total")).withColumn("h", h).withColumn("base", F.col("conv") - F.col("conv") % FAMILY)
    bases = convs.select(F.col("conv").alias("base"), F.col("total").alias("held"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("held", F.lit(0))))
    length = F.col("taken") + F.greatest(F.col("total") - F.col("h"), F.lit(0))
    return chunks, materialize(convs.select("conv", "base", "h", "taken", length.alias("length")), "trie-conversations")


SUMS = ["s1", "s2", "s3", "s4"]


def marks(depth: Column) -> list[Column]:
    """Four 32-bit hashes of a turn at its place, as longs, so that sums of billions of them fit."""
    a, b = F.xxhash64(depth, "i1", "i2"), F.xxhash64(F.lit("second"), "i2", depth, "i1")
    mask = F.lit(0xFFFFFFFF)
    return [x.alias(s) for s, x in zip(SUMS, (a.bitwiseAND(mask), F.shiftrightunsigned(a, 32), b.bitwiseAND(mask), F.shiftrightunsigned(b, 32)))]


def keys() -> list[Column]:
    """The 128-bit key of a sequence from the sums of its marks."""
    return [F.xxhash64("depth", *SUMS).alias("k1"), F.xxhash64(F.lit("second"), *reversed(SUMS), "depth").alias("k2")]


def paths(rows: DataFrame) -> DataFrame:
    """(conv, depth, k1, k2, words, ends) for every place of every rebuilt conversation, the root included."""
    turns = chunked(rows)
    chunks, convs = conversations(turns)
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha")]
    place = F.row_number().over(Window.partitionBy("conv", "chunk").orderBy(*order))
    known = chunks.select("conv", "chunk", "before").join(convs, "conv")
    ranked = turns.withColumn("rank", place).join(known, ["conv", "chunk"]).select(
        "conv", "chunk", (F.col("before") + F.col("rank")).alias("place"), "h", "taken", "length", "words",
        F.xxhash64("role", "sha").alias("i1"), F.xxhash64(F.lit("second"), "sha", "role").alias("i2"))
    # of the first turns of a conversation that others may share, and of its own turns after those that it takes over
    kept = ranked.filter((F.col("place") > F.col("h")) | ((F.col("place") < HEADS) & (F.col("conv") % FAMILY == 0)))
    depth = (F.col("place") - F.col("h") + F.col("taken")).alias("depth")
    kept = materialize(kept.select("*", depth), "trie-ranked")
    heads = kept.filter((F.col("place") < HEADS) & (F.col("conv") % FAMILY == 0)).select(
        F.col("conv").alias("base"), F.col("place").alias("depth"), "i1", "i2", "words")
    taken = convs.join(heads, "base").filter(F.col("depth") <= F.col("taken"))
    taken = taken.select("conv", "depth", "words", "length", *marks(F.col("depth")))
    heads_of = taken.groupBy("conv").agg(*[F.sum(s).alias(f"h{s}") for s in SUMS])  # at most HEADS - 1 turns
    taken = taken.select("conv", "depth", "words", "length", *[running(s, ["conv"], ["depth"]).alias(s) for s in SUMS])

    own = kept.filter(F.col("place") > F.col("h")).select("conv", "chunk", "depth", "words", "length", *marks(F.col("depth")))
    totals = own.groupBy("conv", "chunk").agg(*[F.sum(s).alias(s) for s in SUMS])
    offsets = totals.join(heads_of, "conv", "left").select("conv", "chunk", *[
        (running(s, ["conv"], ["chunk"], before=True) + F.coalesce(f"h{s}", F.lit(0))).alias(f"o{s}") for s in SUMS])
    own = own.select("conv", "chunk", "depth", "words", "length", *[running(s, ["conv", "chunk"], ["depth"]).alias(s) for s in SUMS])
    own = own.join(offsets, ["conv", "chunk"]).select(
        "conv", "depth", "words", "length", *[(F.col(s) + F.col(f"o{s}")).alias(s) for s in SUMS])
    zero = F.lit(0).cast("long")
    root = convs.select("conv", zero.alias("depth"), zero.alias("words"), "length", *[zero.alias(s) for s in SUMS])
    every = own.unionByName(taken).unionByName(root)
    return materialize(every.select("conv", "depth", *keys(), "words", (F.col("depth") == F.col("length")).alias("ends")), "trie-paths")


def above(path: DataFrame, step: int, carried: list[str], band: int = BAND) -> DataFrame:
    """Rows at depths that are multiples of ``step``, each with ``above``: the keys of its ancestors there, from its band's start on.

    A row of band height * i depths belongs to two groups, as the lowest of one band and the top of the next.
    """
    t = F.floor(F.col("depth") / step)
    at = path.filter(F.col("depth") % step == 0).withColumn("t", t)
    entry = F.struct("depth", "k1", "k2", *carried)
    own_band = F.floor((F.col("t") - 1) / band)  # -1 for the root, which has no ancestor
    member = at.select("conv", own_band.alias("band"), entry.alias("x")).filter("band >= 0")
    top = at.filter(F.col("t") % band == 0).select("conv", F.floor(F.col("t") / band).alias("band"), entry.alias("x"))
    groups = member.unionByName(top).groupBy("conv", "band").agg(F.array_sort(F.collect_list("x")).alias("xs"))  # BAND + 1 rows at most
    rows = groups.filter(F.size("xs") > 1).select("conv", "xs", F.explode(F.sequence(F.lit(2), F.size("xs"))).alias("i"))
    x = F.element_at("xs", F.col("i"))
    up = F.transform(F.slice("xs", 1, F.col("i") - 1), lambda y: F.struct(y["k1"].alias("k1"), y["k2"].alias("k2")))
    return rows.select("conv", *[x[c].alias(c) for c in (*KEY, *carried)], up.alias("above"))


def nodes_of(path: DataFrame, band: int = BAND) -> DataFrame:
    """A row per node: key, least member, members, words of the last text, members that end there, ancestors in the band."""
    none = F.array().cast("array<struct<k1:bigint,k2:bigint>>")
    root = path.filter("depth = 0").select("conv", *KEY, "words", "ends", none.alias("above"))
    rows = above(path, 1, ["words", "ends"], band).unionByName(root)
    # what follows from the key alone is the same in all rows of a node
    return rows.groupBy(*KEY).agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.first("words").alias("words"),
                                  F.count_if("ends").alias("n_ends"), F.first("above").alias("above"))


TOTALS = ["n_leaves", "saved_tokens"]


def exploded(nodes: DataFrame, step: int, values: list[Column]) -> DataFrame:
    """``values`` sent from each node to the ancestors in its band: (depth, k1, k2, nearest, values...)."""
    sent = nodes.select("depth", F.size("above").alias("m"), F.posexplode("above").alias("i", "a"), *values)
    back = F.col("m") - F.col("i")
    names = [c for c in sent.columns if c not in ("depth", "m", "i", "a")]
    return sent.select((F.col("depth") - back * step).alias("depth"), F.col("a.k1").alias("k1"), F.col("a.k2").alias("k2"),
                       (back == 1).alias("nearest"), *names)


def rolled_up(path: DataFrame, nodes: DataFrame, deepest: int, step: int = 1, band: int = BAND) -> DataFrame:
    """Subtree totals (key, n_leaves, saved_tokens) of ``nodes`` (key, above, n_leaves, saved_tokens of their own).

    ``nodes`` are the trie nodes at depths that are multiples of ``step``.
    """
    is_root = (F.col("depth") / step) % band == 0
    own = nodes.select(*KEY, *TOTALS)
    inner = exploded(nodes.filter(~is_root), step, [F.col(c) for c in TOTALS]).select(*KEY, *TOTALS)
    within = own.unionByName(inner).groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in TOTALS])
    if deepest // step < band:
        return within
    within = materialize(within, "trie-band")
    up = above(path, step * band, [], band).groupBy(*KEY).agg(F.first("above").alias("above"))
    roots = materialize(within.filter(is_root).join(up, KEY, "left").withColumn(
        "above", F.coalesce("above", F.array().cast("array<struct<k1:bigint,k2:bigint>>"))), "trie-roots")
    whole = materialize(rolled_up(path, roots, deepest, step * band, band), "trie-root-totals")
    # completed band roots add to the band above them; their own totals are complete already
    below = nodes.filter(is_root & (F.col("depth") > 0)).select(*KEY, "above").join(whole, KEY)
    added = exploded(below, step, [F.col(c) for c in TOTALS]).filter((F.col("depth") / step) % band != 0).select(*KEY, *TOTALS)
    rest = within.filter(~is_root).unionByName(added).groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in TOTALS])
    return rest.unionByName(whole)


def end_hashes(path: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the nodes where conversations end.

    Ids are joined in pieces of at most ``PIECE``, which a task then reads in order and hashes one after another.
    """
    ends = path.filter("ends").select(*KEY, "conv", F.floor(F.col("conv") / PIECE).alias("piece"))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    pieces = ends.groupBy(*KEY, "piece").agg(ids.alias("ids"))
    ordered = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece")

    def scan(batches):
        at, digest, done = None, None, []

        def out():
            names = [*KEY, "ends_sha256"]
            return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.int64() if i < 3 else pa.string()) for i in range(4)], names)

        for b in batches:
            for *key, ids in zip(*[b.column(i).to_pylist() for i in range(4)]):
                if key != at:
                    if at is not None:
                        done.append((*at, digest.hexdigest()))
                    at, digest = key, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            yield out()
            done.clear()
        if at is not None:
            done.append((*at, digest.hexdigest()))
            yield out()

    return ordered.select(*KEY, "ids").mapInArrow(scan, "depth long, k1 long, k2 long, ends_sha256 string")


def prefix_trie(rows: DataFrame, band: int = BAND) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    path = paths(rows)
    deepest = path.agg(F.max("depth")).first()[0] or 0
    nodes = materialize(nodes_of(path, band).withColumns({
        "n_leaves": F.when(F.col("n_ends") == F.col("n_convs"), 1).otherwise(0).cast("long"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}), "trie-nodes")
    totals = rolled_up(path, nodes, deepest, 1, band)
    parent = F.element_at("above", -1)
    children = nodes.filter("depth > 0").select((F.col("depth") - 1).alias("depth"), parent["k1"].alias("k1"), parent["k2"].alias("k2"))
    counted = children.groupBy(*KEY).agg(F.count("*").alias("n_children"))
    own = nodes.select(*KEY, "conv_id", "n_convs", (F.col("depth") - 1).alias("up"), parent["k1"].alias("u1"), parent["k2"].alias("u2"))
    made = own.join(totals, KEY).join(counted, KEY, "left").join(end_hashes(path), KEY, "left")
    # every node below the first turns finds its parent's least member by the parent's key; the root's is the least of all
    first = nodes.filter("depth = 0").select("conv_id").first()
    least = F.lit(first["conv_id"] if first else None).cast("long")
    parents = nodes.filter("depth > 0 and n_ends < n_convs").select(
        F.col("depth").alias("up"), F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("conv_id").alias("parent_conv_id"))
    deep = made.filter("depth > 1").join(parents, ["up", "u1", "u2"])
    flat = made.filter("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, least))
    return deep.unionByName(flat).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"))

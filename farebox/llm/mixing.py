"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in hash order and again from the start (``epoch`` counts the
passes), form one endless row of blocks of ``block_rows``; every block is full, so a
source's share of the rows is its share of the blocks. Weights are
shares of a frame of ``frame`` slots (whole numbers that sum to ``frame``, at least
one each). Block i (from 0) of a source with share a may go no earlier than slot
floor(i * frame / a) and must be done by slot ceil((i + 1) * frame / a). Of the
blocks released, the one with the earliest deadline goes next (ties: the source
first in name order). Shares sum to the frame, so every deadline holds and after any
number of slots each source is less than one block away from its due.
The frame's order repeats, so one frame is scheduled and a block's slot follows
from its number.

More than ``frame / 2`` sources are dealt, by number, to groups of at most ``frame / 4``.
The groups share the frame's slots by the sums of their weights, and each has a frame of
its own in which its sources share the group's blocks in the same way; many groups are
grouped again. Each level adds less than one block to the deviation. A block's release
and deadline are then those among the blocks of its group.

``until="all"`` runs until every document has been placed once; ``until="first"`` stops
when a source has no whole fresh block.

Ranks within a source come from buckets of about ``BUCKET_ROWS`` rows each, so a
source with a third of all rows is spread like any other. Schedules are broadcast while
they hold at most ``FEW`` rows (``frame`` each), and joined by shuffle beyond. Null sources
form one source, first in name order. Rows that agree in all columns are interchangeable.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import materialize, private, row_key

FRAME, BLOCK_ROWS, ALPHA = 1000, 16, 0.7
#: Rows in a rank bucket, and the most buckets that the offset table may have.
BUCKET_ROWS, MAX_BUCKETS = 1024, 1_000_000
#: Rows of a schedule, and of the source table, that are broadcast.
FEW = 100_000


def weighted(counts: DataFrame, alpha: float, weights: dict[str | None, float] | None) -> DataFrame:
    """(src, n, s, w): s numbers the sources in name order; the weight is the given one, or the row count to the power ``alpha``."""
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(alpha))
    else:
        weight = F.coalesce(*[F.when(F.col("src").eqNullSafe(F.lit(k)), F.lit(float(v))) for k, v in weights.items()],
                            F.lit(0.0))
    return counts.select("src", "n", (F.row_number().over(Window.orderBy(F.col("src").asc_nulls_first())) - 1).cast("long").alias("s"),
                         weight.alias("w"))  # a row per source


def shares_of(weights: DataFrame, frame: int) -> DataFrame:
    """(g, s, share): whole shares of a frame within each group g by largest remainder; one slot each is set aside first."""
    every = Window.partitionBy("g")  # at most ``frame`` rows
    due = F.when(F.sum("w").over(every) > 0, F.col("w") / F.sum("w").over(every)).otherwise(
        1 / F.count("*").over(every)) * (frame - F.count("*").over(every))
    rest = F.lit(frame) - F.count("*").over(every) - F.sum("whole").over(every)
    out = weights.withColumn("due", due).withColumn("whole", F.floor("due").cast("int")).withColumn(
        "place", F.row_number().over(every.orderBy((F.col("due") - F.col("whole")).desc(), "s")))
    return out.select("g", "s", (F.lit(1) + F.col("whole") + F.when(F.col("place") <= rest, 1).otherwise(0)).cast("int").alias("share"))


def release(i: Column, share: Column, frame: int) -> Column:
    return F.floor(i * F.lit(frame) / share).cast("long")


def deadline(i: Column, share: Column, frame: int) -> Column:
    return F.ceil((i + 1) * F.lit(frame) / share).cast("long")


def schedule(shares: DataFrame, frame: int = FRAME) -> DataFrame:
    """(s, share, i, slot) of each group's frame: earliest deadline first among released blocks."""
    one = shares.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("s", "share"))).alias("of")).select(
        "of", F.transform("of", lambda x: x["share"]).alias("a"))

    def place(acc: Column, t: Column) -> Column:
        ready = F.transform(F.col("a"), lambda a, s: F.when(
            (F.element_at(acc["c"], s + 1) < a) & (release(F.element_at(acc["c"], s + 1), a, frame) <= t),
            F.struct(deadline(F.element_at(acc["c"], s + 1), a, frame).alias("d"), s.alias("s"))))
        best = F.array_min(ready)["s"]
        return F.transform(F.array(best), lambda b: F.struct(
            F.transform(acc["c"], lambda c, s: c + F.when(s == b, 1).otherwise(0)).alias("c"),
            F.concat(acc["out"], F.array(b)).alias("out")))[0]

    run = F.aggregate(F.sequence(F.lit(0), F.lit(frame - 1)), F.struct(
        F.transform(F.col("a"), lambda a: F.lit(0)).alias("c"), F.array().cast("array<int>").alias("out")), place)
    order = one.select("of", F.posexplode(run["out"]).alias("slot", "at")).select(F.get("of", F.col("at")).alias("x"), "slot")
    return order.select("x.s", "x.share", (F.row_number().over(Window.partitionBy("x.s").orderBy("slot")) - 1).alias("i"), "slot")


def levels(weights: DataFrame, count: int, frame: int) -> list[tuple[int, DataFrame]]:
    """(number of groups, written schedule of their frames) from the sources up; the last level has one group."""
    out, most = [], max(2, frame // 4)
    while True:
        groups = 1 if count <= max(2, frame // 2) else -(-count // most)
        numbered = weights.withColumn("g", F.pmod("s", F.lit(groups)))
        out.append((groups, materialize(schedule(shares_of(numbered, frame), frame), "schedule")))
        if groups == 1:
            return out
        weights, count = numbered.groupBy(F.col("g").alias("s")).agg(F.sum("w").alias("w")), groups


def slot_of(blocks: DataFrame, plan: list[tuple[int, DataFrame]], frame: int, sources: int) -> DataFrame:
    """``blocks`` (s, number, ...) with ``at``, the slot of each block, and release and deadline among its group's blocks."""
    out = blocks.withColumns({"_s": F.col("s"), "at": F.col("number")})
    for k, (groups, frames) in enumerate(plan):
        frames = frames.select(F.col("s").alias("_s"), F.col("share").alias("_share"), F.col("i").alias("_i"), F.col("slot").alias("_slot"))
        if frame * groups <= FEW:
            frames = F.broadcast(frames)
        own = sources if k == 0 else plan[k - 1][0]
        share = frames.select("_s", "_share").distinct()
        share = F.broadcast(share) if own <= FEW else share
        out = out.join(share, "_s").withColumn("_i", (F.col("at") % F.col("_share")).cast("int")).join(frames.drop("_share"), ["_s", "_i"])
        if k == 0:
            out = out.withColumns({"release": release(F.col("number"), F.col("_share"), frame),
                                   "deadline": deadline(F.col("number"), F.col("_share"), frame)})
        out = out.withColumn("at", F.floor(F.col("at") / F.col("_share")).cast("long") * frame + F.col("_slot")).withColumn(
            "_s", F.pmod("_s", F.lit(groups))).drop("_share", "_i", "_slot")
    return out.drop("_s")


def mix(docs: DataFrame, source_col: str = "source", weights: dict[str | None, float] | None = None,
        alpha: float = ALPHA, frame: int = FRAME, block_rows: int = BLOCK_ROWS, until: str = "all") -> DataFrame:
    """All columns of ``docs`` plus __slot, __epoch, __block, __release, __deadline, __place.

    Read in the order of (slot, place), the result is the mixture. Rows move once, to (source, bucket).
    """
    h1, h2 = row_key(docs)
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{source_col}`").alias("src"), h1.alias("h1"), h2.alias("h2"))
    counts = materialize(base.groupBy("src").agg(F.count("*").alias("n")), "source-counts")  # one scan for all uses
    sources, total = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    named = materialize(weighted(counts, alpha, weights), "source-weights")
    plan = levels(named.select("s", "w"), sources, frame)
    per_bucket = max(BUCKET_ROWS, -(-total // MAX_BUCKETS))

    # the mixture ends after the last source's last fresh row, or before the first source's first block that is not all fresh
    last = (F.floor((F.col("n") - 1) / block_rows) if until == "all" else F.floor(F.col("n") / block_rows)).cast("long")
    ends = slot_of(named.select("s", last.alias("number")), plan, frame, sources)
    end = ends.agg(F.max("at") + 1 if until == "all" else F.min("at")).first()[0] or 0

    unit = F.shiftrightunsigned("h1", 12).cast("double") / F.lit(float(2 ** 52))
    info = named.select(F.col("src").alias("of"), "n", "s", F.ceil(F.col("n") / per_bucket).cast("long").alias("buckets"))
    info = F.broadcast(info) if sources <= FEW else info
    base = base.join(info, F.col("src").eqNullSafe(F.col("of"))).withColumn(
        "bucket", F.floor(unit * F.col("buckets")).cast("long")).drop("src", "of", "buckets")
    offsets = base.groupBy("s", "bucket").agg(F.count("*").alias("c")).select(
        "s", "bucket", (F.sum("c").over(Window.partitionBy("s").orderBy("bucket")) - F.col("c")).alias("before"))
    ranked = base.withColumn("r", F.row_number().over(Window.partitionBy("s", "bucket").orderBy("h1", "h2")) - 1).join(
        offsets, ["s", "bucket"]).withColumn("r", F.col("r") + F.col("before"))

    # no block beyond this number has a slot before the end
    bound = F.broadcast(blocks_before(named.select("s"), plan, end, frame, sources)) if sources <= FEW else blocks_before(
        named.select("s"), plan, end, frame, sources)
    passes = F.greatest(F.floor((F.col("most") * block_rows - 1 - F.col("r")) / F.col("n")).cast("long"), F.lit(0).cast("long"))
    out = ranked.join(bound, "s").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), passes))).withColumn(
        "position", F.col("r") + F.col("epoch") * F.col("n")).withColumn("number", F.floor(F.col("position") / block_rows).cast("long"))
    names = {n: private(docs, n) for n in ("slot", "epoch", "block", "release", "deadline", "place")}
    return slot_of(out, plan, frame, sources).filter(F.col("at") < end).select(
        "row.*", F.col("at").alias(names["slot"]), F.col("epoch").alias(names["epoch"]),
        F.col("number").alias(names["block"]), F.col("release").alias(names["release"]),
        F.col("deadline").alias(names["deadline"]), (F.col("position") % block_rows).alias(names["place"]))


def blocks_before(ids: DataFrame, plan: list[tuple[int, DataFrame]], end: int, frame: int, sources: int) -> DataFrame:
    """(s, most): more blocks than ``most`` of a source are not placed before slot ``end``.

    From the top level down: of ``end`` slots an entry gets those of the frames begun.
    """
    out = None
    for k in reversed(range(len(plan))):
        groups, frames = plan[k]
        shares = frames.select("s", "share").distinct().withColumn("g", F.pmod("s", F.lit(groups)))
        slots = F.lit(end) if out is None else F.col("most")
        at = shares if out is None else shares.join(out.select(F.col("s").alias("g"), "most"), "g")
        out = at.select("s", ((F.floor(slots / frame).cast("long") + 1) * F.col("share")).alias("most"))
    return out

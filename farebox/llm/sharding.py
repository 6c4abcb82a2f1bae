"""Resharding by minimum-cost flow.

From the bytes of the old shards and the capacities of the new ones, a minimum-cost
flow (cost: bytes that change shard) says how many bytes each old shard keeps and
hands to each new one. An old shard's rows lie on a line; the flow cuts the line
into runs, one per new shard, and a row goes where its middle byte lies. So sizes
differ from the capacities by about a row per run, and rows that may stay do.

Rows with equal texts (null texts, too) are a group. A group that fits in a new shard lies whole on one
line, that of the old shard which holds most of its bytes; larger groups stay where
they are. On a line rows are ordered by text hash, a group side by side. A group of at
most ``WHOLE`` of a shard's bytes goes as one where its middle byte lies; a larger one
parts only where a run ends inside it. A group however large is spread over cells by row
hash. Offsets come from cells of about ``BUCKET_ROWS`` rows. The driver holds one number per
old shard (``MAX_SHARDS`` at most) and the flow. Rows get their slots in the order of the
line, or in a given order.

Size: UTF-8 bytes of the text (null: none) plus 1. Rows with a null old shard are
new rows: they may go anywhere at the same cost. Copies of a row are
interchangeable. An empty table gives an empty result.

The rewrite needs no id: the plan carries hashes of the whole row (``KEY``). Every row
of the plan takes the content of its key, one copy of which is kept, so repeated rows
and rows with a null id are written as often as the plan has them. All columns are
written; if one is called ``shard`` or ``slot`` already, the layout's own columns get other
names (see ``layout_names``), unless the caller says that it is the old layout's.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import materialize, private, row_key

BUCKET_ROWS, MAX_BUCKETS, MAX_SHARDS = 1024, 1_000_000, 1024
#: Shards are written once and read often.
ZSTD_LEVEL = 9
#: Slots of a shard that are written by one task.
RANGE_ROWS = 1 << 15
#: Groups of equal texts up to this share of a shard's bytes are never cut.
WHOLE = 1 / 32
#: The old shard of rows that had none.
UNPLACED = -1
#: Hashes of a row: two over its values, one over its nulls and nested values (the first two skip nulls).
KEY = ["__h1", "__h2", "__h3"]


def content_key(docs: DataFrame) -> list[Column]:
    """The columns KEY; rows that agree in all of them are copies of one row."""
    nested = [F.to_json(F.col(f"`{f.name}`")) for f in docs.schema.fields if f.dataType.typeName() in ("array", "struct")]
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "0").otherwise("1") for c in docs.columns])
    return [x.alias(k) for x, k in zip((*row_key(docs), F.xxhash64(nulls, *[F.coalesce(x, F.lit("")) for x in nested])), KEY)]


def min_cost_flow(arcs: list[tuple[str, str, int, int]], source: str, sink: str) -> list[int]:
    """Flow on each arc (from, to, capacity, cost >= 0) of a greatest flow of least cost.

    Successive shortest augmenting paths; potentials keep the residual costs non-negative for Dijkstra.
    """
    ends = [x for u, v, _, _ in arcs for x in (v, u)]  # of arc 2k and its reverse 2k + 1
    room = [x for _, _, cap, _ in arcs for x in (cap, 0)]
    price = [x for _, _, _, cost in arcs for x in (cost, -cost)]
    out: dict[str, list[int]] = {}
    for k, (u, v, _, _) in enumerate(arcs):
        out.setdefault(u, []).append(2 * k)
        out.setdefault(v, []).append(2 * k + 1)
    potential = dict.fromkeys(out, 0)
    while source in out and sink in out:
        dist, via, done, heap = {source: 0}, {}, set(), [(0, source)]
        while heap:
            d, u = heapq.heappop(heap)
            if u in done:
                continue
            done.add(u)
            for e in out[u]:
                if room[e] and (n := d + price[e] + potential[u] - potential[v := ends[e]]) < dist.get(v, n + 1):
                    dist[v], via[v] = n, e
                    heapq.heappush(heap, (n, v))
        if sink not in done:
            break
        for u in out:
            potential[u] += min(dist.get(u, dist[sink]), dist[sink])
        path, at = [], sink
        while at != source:
            path.append(via[at])
            at = ends[via[at] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount
    return [room[2 * k + 1] for k in range(len(arcs))]


def plan_transfers(supply: dict[int, int], capacity: dict[int, int]) -> dict[tuple[int, int], int]:
    """(old shard, new shard) -> bytes, moving as few bytes as the capacities allow.

    Bytes that stay cost nothing; all others pass one exchange node at cost 1 (0 for unplaced
    rows), which keeps the graph as small as the number of shards.
    """
    total = sum(supply.values())
    if total > sum(capacity.values()):
        raise ValueError("the capacities cannot hold all bytes")
    arcs = [("source", f"old {o}", n, 0) for o, n in supply.items()]
    arcs += [("exchange", f"new {s}", total, 0) for s in capacity]
    arcs += [(f"new {s}", "sink", c, 0) for s, c in capacity.items()]
    stay = [o for o in supply if o in capacity]
    arcs += [(f"old {o}", f"new {o}", total, 0) for o in stay]
    arcs += [(f"old {o}", "exchange", total, int(o != UNPLACED)) for o in supply]
    flow = dict(zip([a[:2] for a in arcs], min_cost_flow(arcs, "source", "sink")))
    out = {(o, o): flow[f"old {o}", f"new {o}"] for o in stay}
    gives = [[o, flow[f"old {o}", "exchange"]] for o in supply]
    for s in capacity:
        need = flow["exchange", f"new {s}"]
        while need:
            if not gives[-1][1]:
                gives.pop()
                continue
            n = min(need, gives[-1][1])
            out[gives[-1][0], s] = out.get((gives[-1][0], s), 0) + n
            gives[-1][1] -= n
            need -= n
    return {k: v for k, v in out.items() if v}


def even_capacities(total: int, shards: int) -> dict[int, int]:
    return {i: total // shards + (i < total % shards) for i in range(shards)}


def runs_of(flow: dict[tuple[int, int], int]) -> dict[int, list[tuple[int, int]]]:
    """Old shard -> [(end byte on its line, new shard)], what stays first."""
    out: dict[int, list[tuple[int, int]]] = {}
    for (old, new), amount in sorted(flow.items(), key=lambda x: (x[0][0], x[0][0] != x[0][1], x[0][1])):
        line = out.setdefault(old, [])
        line.append((amount + (line[-1][0] if line else 0), new))
    return out


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def reshard(docs: DataFrame, old_shard: Column, shards: int = 16, capacities: dict[int, int] | None = None,
            id_col: str = "doc_id", text_col: str = "text", order: tuple[Column, Column] | None = None) -> DataFrame:
    """One row per document row: id, size, text_crc32, old_shard, shard, slot (gapless from 0 in its shard), moved, KEY.

    Only (id, size, hashes) is shuffled, never the text. ``order`` (a block of bounded size, the place in it)
    gives the order of the rows in each shard.
    """
    text = F.col(f"`{text_col}`")
    h1, h2, h3 = content_key(docs)
    block, place = order or (F.lit(0), F.lit(0))
    rows = materialize(docs.select(
        F.col(f"`{id_col}`").alias("id"), size_of(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"), F.xxhash64(text).alias("th"),
        h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), F.coalesce(old_shard.cast("int"), F.lit(UNPLACED)).alias("from"),
        block.alias("block"), place.alias("place")), "reshard-rows")
    held = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("n")).first()
    per_bucket = max(BUCKET_ROWS, -(-held["n"] // MAX_BUCKETS))
    shard_bytes = min((capacities or even_capacities(held["bytes"], shards)).values(), default=0)
    # groups of equal texts: the old shard that holds most of them, and whether they go as one or are spread over cells
    parts = rows.groupBy("th", "from").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    groups = materialize(parts.groupBy("th").agg(
        F.max(F.struct("bytes", (-F.col("from")).alias("o")))["o"].alias("o"), F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).filter(
        "n > 1").select("th", F.when(F.col("bytes") <= shard_bytes, -F.col("o")).alias("home"), (F.col("bytes") <= shard_bytes * WHOLE).alias("whole"),
                        F.when(F.col("n") > per_bucket, F.ceil(F.col("n") / per_bucket).cast("long")).alias("parts")), "text-groups")
    # large groups, at most MAX_BUCKETS, come to their rows; only rows of the others meet their groups by shuffle
    large = F.broadcast(groups.filter("parts is not null"))
    grouped = rows.join(large, "th", "left_anti").join(groups.filter("parts is null"), "th", "left").unionByName(rows.join(large, "th"))
    rows = materialize(grouped.withColumns({
        "old": F.coalesce("home", "from"), "whole": F.coalesce("whole", F.lit(False)) & F.col("parts").isNull(),
        "hot": F.when(F.col("parts").isNotNull(), F.col("th")), "sub": F.pmod("h1", F.coalesce("parts", F.lit(1)))}).drop(
        "home", "parts"), "reshard-grouped")
    old = {r["old"]: (r["bytes"], r["n"]) for r in rows.groupBy("old").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n")).limit(MAX_SHARDS + 2).collect()}
    if len(old) > MAX_SHARDS + 1 or shards > MAX_SHARDS:
        raise ValueError(f"more than {MAX_SHARDS} shards")
    supply = {k: v[0] for k, v in sorted(old.items())}
    runs = runs_of(plan_transfers(supply, capacities or even_capacities(sum(supply.values()), shards)))

    buckets = F.create_map(*[F.lit(x) for k, (_, n) in old.items() for x in (k, -(-n // per_bucket))]) if old else F.create_map(
        F.lit(0), F.lit(1))
    unit = F.shiftrightunsigned("th", 12).cast("double") / F.lit(float(2 ** 52))
    rows = rows.withColumn("b", F.floor(unit * F.try_element_at(buckets, F.col("old"))).cast("long")).withColumn(
        "hot", F.coalesce("hot", F.lit(0).cast("long")))
    cell = ["old", "b", "hot", "sub"]
    before = rows.groupBy(*cell).agg(F.sum("size").alias("bytes")).select(*cell, (F.sum("bytes").over(
        Window.partitionBy("old").orderBy("b", "hot", "sub")) - F.col("bytes")).alias("before"))
    line = Window.partitionBy(*cell).orderBy("th", "h1", "h2", "id", "size", "from")
    group = Window.partitionBy(*cell, "th")
    placed = rows.withColumns({
        "rn": F.row_number().over(line),
        "upto": F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0))}).withColumns({
            "first": F.min(F.col("upto") - F.col("size")).over(group), "last": F.max("upto").over(group)}).join(before, cell)
    # twice the middle byte of the row, or of its group
    middle = 2 * F.col("before") + F.when(F.col("whole"), F.col("first") + F.col("last")).otherwise(2 * F.col("upto") - F.col("size"))
    ends = F.create_map(*[x for k, v in runs.items() for x in (F.lit(k), F.array(*[
        F.struct(F.lit(e).cast("long").alias("end"), F.lit(s).alias("shard")) for e, s in v]))]) if runs else F.create_map(
        F.lit(0), F.array(F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).alias("shard"))))
    placed = placed.withColumn("shard", F.filter(F.try_element_at(ends, F.col("old")), lambda x: middle < 2 * x["end"])[0]["shard"])
    placed = materialize(placed.select("id", "size", "crc", "shard", "from", "rn", "h1", "h2", "h3", "block", "place", *cell), "reshard-placed")
    if order is None:
        first = placed.groupBy("shard", *cell).agg(F.min("rn").alias("rn0"), F.count("*").alias("n")).select(
            "shard", *cell, "rn0", (F.sum("n").over(Window.partitionBy("shard").orderBy(*cell)) - F.col("n")).alias("at"))
        numbered = placed.join(first, ["shard", *cell]).withColumn("slot", F.col("at") + F.col("rn") - F.col("rn0"))
    else:
        in_block = Window.partitionBy("shard", "block").orderBy("place", "h1", "h2", "id")
        first = placed.groupBy("shard", "block").agg(F.count("*").alias("n")).select(
            "shard", "block", (F.sum("n").over(Window.partitionBy("shard").orderBy("block")) - F.col("n")).alias("at"))
        numbered = placed.withColumn("k", F.row_number().over(in_block) - 1).join(first, ["shard", "block"]).withColumn(
            "slot", F.col("at") + F.col("k"))
    return numbered.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.col("from").alias("old_shard"), "shard",
        F.col("slot").cast("long").alias("slot"), (F.col("from") != F.col("shard")).alias("moved"),
        *[F.col(k.strip("_")).alias(k) for k in KEY])


def _delete(docs: DataFrame, folder: str) -> None:
    spark = docs.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def layout_names(docs: DataFrame, replaces: tuple[str, ...] = ()) -> tuple[str, str]:
    """What the layout calls its shard (the partition folder) and slot: names that no other column of ``docs`` has."""
    others = docs.drop(*replaces)
    taken = {c.lower() for c in others.columns}
    return tuple(n if n not in taken else private(others, n) for n in ("shard", "slot"))


def with_content(docs: DataFrame, target: DataFrame, replaces: tuple[str, ...] = ()) -> DataFrame:
    """The columns of the rows of ``docs``, but for those replaced, at the shards and slots that ``target`` (KEY, shard, slot)
    gives their keys; dealt to ranges of ``RANGE_ROWS`` slots and sorted.

    Copies of a row travel once to each range that has some of them.
    """
    shard, slot = layout_names(docs, replaces)
    cell = ["shard", "range"]
    body = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in replaces]).alias("row"), *content_key(docs))
    wanted = target.withColumn("range", F.floor(F.col("slot") / RANGE_ROWS)).groupBy(*KEY, *cell).agg(F.collect_list("slot").alias("slots"))
    met = wanted.join(body.groupBy(*KEY).agg(F.first("row").alias("row")), KEY).select("row", *cell, "slots")
    return met.repartition(*cell).select("row.*", F.col("shard").alias(shard), F.explode("slots").alias(slot)).sortWithinPartitions(shard, slot)


def write_shards(docs: DataFrame, plan: DataFrame, path: str, shards: list[int], replaces: tuple[str, ...] = ()) -> set[int]:
    """Replace these shards below ``path/shard=N`` by what ``plan`` puts there; returns those that get rows."""
    target = plan.filter(F.col("shard").isin(shards)).select(*KEY, "shard", "slot")
    with_content(docs, target, replaces).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "compression", "zstd").option("parquet.compression.codec.zstd.level", ZSTD_LEVEL).partitionBy(layout_names(docs, replaces)[0]).parquet(path)
    return {r[0] for r in target.select("shard").distinct().collect()}


def rewrite_affected(docs: DataFrame, plan: DataFrame, path: str, replaces: tuple[str, ...] = ()) -> list[int]:
    """Rewrite, below ``path/shard=N``, only shards that lose or gain a row; returns them.

    ``plan`` is from :func:`reshard` over the same rows and columns as ``docs``. ``replaces`` names columns of ``docs``
    that come from the old layout (its partition column, its slots) and make way for the new ones. Files of other shards
    are not touched. Folders of shards that lose all rows, and of rows that had no shard, go once the others are written.
    """
    moved = plan.filter("moved")
    left = {r[0] for r in moved.select("old_shard").distinct().collect()}
    affected = sorted((left | {r[0] for r in moved.select("shard").distinct().collect()}) - {UNPLACED})
    if affected:
        shard = layout_names(docs, replaces)[0]
        kept = write_shards(docs, plan, path, affected, replaces)
        for gone in sorted(left - kept):
            _delete(docs, f"{path}/{shard}={'__HIVE_DEFAULT_PARTITION__' if gone == UNPLACED else gone}")
    return affected

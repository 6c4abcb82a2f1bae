"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

Fingerprint: A-Z lower-cased, words split at ASCII white space, every run of
``shingle`` words (repeats count; fewer words: all of them) hashed by XXH64 with
seed 42; a bit is set if it is set in more than half of the hashes. No words: zero.
Null text has no words. Fingerprints link at ``bits`` or fewer differing bits,
empty texts like any other.

The distinct fingerprints form a binary trie. Its top (a count per 16-bit prefix, and
below prefixes that hold more than ``FULL_LEAF``, four bits at a time, of their children)
is cut into leaves; pairs of leaves are walked together, adding up the bits in which
their prefixes differ, and a pair is dropped once the budget is exceeded. Each pair
left is one task group that walks its two sub-tries in the same way, bit by bit.
A group returns a spanning forest of the links it found, at most one link per
fingerprint, never all pairs. Components then come from rounds of large-star and
small-star joins, each written to the shared folder.

Copies collapse into their fingerprint before anything is joined; the joins back
to rows have one unique side, so Spark can split a hot key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import materialize, private, row_key

SHINGLE, BITS = 3, 2
#: The driver's part of the trie: prefixes of so many bits, and about so many leaves while these are not too full.
TOP_BITS, LEAVES, LEAST_LEAF = 16, 128, 2048
#: A leaf with more fingerprints is cut on, so that a pair of leaves takes some 100 MB however many documents there are.
FULL_LEAF = 1 << 21
#: Fingerprints dealt to their groups at a time.
DEAL_ROWS = 4096
#: Node pairs and fingerprint pairs expanded at a time inside a group.
STEP = 1 << 17


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text, in pieces of ``STEP`` shingles however long it is."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for a in range(0, n, STEP):
        some = words[a:a + STEP + shingle - 1]
        joined = zip(*(some[k:] for k in range(shingle))) if len(words) >= shingle else [words]
        h = np.array([xxhash.xxh64_intdigest(b" ".join(s), 42) for s in joined], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n).view(">u8")[0])


def fingerprints(docs: DataFrame, keys: dict[str, Column], text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The key columns and ``fp`` (the fingerprint's bits as a signed long) of every row; no shuffle."""
    narrow = docs.select(F.col(f"`{text_col}`").cast("binary").alias("__text"), *[c.alias(k) for k, c in keys.items()])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema.fields[1:])

    def scan(batches):
        for b in batches:
            fp = np.array([fingerprint(x.as_py(), shingle) for x in b.column(0)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(fp)], [*b.schema.names[1:], "fp"])

    return narrow.mapInArrow(scan, f"{kinds}, fp bigint")


# -- the top of the trie, on the driver ------------------------------------------------------------

def cut(counts: dict[int, int], leaf: int, depth: int = TOP_BITS, root: tuple[int, int] = (0, 0)) -> list[tuple[int, int]]:
    """Leaves (bits, prefix) of the trie over ``depth``-bit prefixes below ``root``, split while they hold more than ``leaf``."""
    out, stack = [], [(*root, sorted(counts.items()))]
    while stack:
        bits, prefix, inside = stack.pop()
        if bits == depth or sum(n for _, n in inside) <= leaf:
            out.append((bits, prefix))
            continue
        for bit in (1, 0):
            child = 2 * prefix + bit
            if some := [x for x in inside if x[0] >> (depth - bits - 1) == child]:
                stack.append((bits + 1, child, some))
    return out


def leaf_pairs(leaves: list[tuple[int, int]], budget: int) -> list[tuple[int, int]]:
    """Pairs (i <= j) of leaves whose common prefix bits differ in at most ``budget`` places.

    The leaves' trie is walked against itself; a leaf met by an inner node waits while that node is opened.
    """
    kids: dict[tuple[int, int], list] = {}
    at = {x: i for i, x in enumerate(leaves)}
    for bits, prefix in leaves:
        while bits and (bits, prefix) not in kids.get((bits - 1, prefix >> 1), ()):
            kids.setdefault((bits - 1, prefix >> 1), []).append((bits, prefix))
            bits, prefix = bits - 1, prefix >> 1
    out, stack = set(), [((0, 0), (0, 0))] if leaves else []
    while stack:
        a, b = stack.pop()
        shared = min(a[0], b[0])
        if bin((a[1] >> (a[0] - shared)) ^ (b[1] >> (b[0] - shared))).count("1") > budget:
            continue
        if a in at and b in at:
            out.add((min(at[a], at[b]), max(at[a], at[b])))
        else:
            left, right = kids.get(a, [a]), kids.get(b, [b])
            stack += [(x, y) for x in left for y in right if a != b or x <= y]
    return sorted(out)


# -- inside a group ---------------------------------------------------------------------------------

def _middle(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """Where the node [lo, hi) of a sorted array parts at ``bit``: its values agree in all bits above."""
    edge = (values[lo] >> np.uint64(bit) | np.uint64(1)) << np.uint64(bit)
    return np.clip(np.searchsorted(values, edge), lo, hi)


def close_pairs(a: np.ndarray, b: np.ndarray, same: bool, budget: int):
    """Yield arrays (i, j) of places in the sorted arrays with at most ``budget`` differing bits.

    A stack of blocks of node pairs (alo, ahi, blo, bhi, spent), each block at one bit; blocks stay below ``STEP``.
    """
    if not len(a) or not len(b):
        return
    stack = [(63, tuple(np.array([x]) for x in (0, len(a), 0, len(b), 0)))]
    while stack:
        bit, block = stack.pop()
        if len(block[0]) > STEP:
            half = len(block[0]) // 2
            stack += [(bit, tuple(x[half:] for x in block)), (bit, tuple(x[:half] for x in block))]
            continue
        alo, ahi, blo, bhi, spent = block
        area = (ahi - alo) * (bhi - blo)
        few = (area <= 16) if bit >= 0 else area > 0
        if few.any():
            yield from _compare(a, b, alo[few], ahi[few], blo[few], bhi[few], same, budget)
        alo, ahi, blo, bhi, spent = (x[~few] for x in block)
        if not len(alo):
            continue
        am, bm = _middle(a, alo, ahi, bit), _middle(b, blo, bhi, bit)
        parts = [(alo, am, blo, bm, spent), (am, ahi, bm, bhi, spent), (alo, am, bm, bhi, spent + 1)]
        back = (am, ahi, blo, bm, spent + 1)
        own = (alo == blo) & (ahi == bhi) if same else np.zeros(len(alo), bool)
        parts.append(tuple(x[~own] for x in back))
        new = tuple(np.concatenate(x) for x in zip(*parts))
        keep = (new[0] < new[1]) & (new[2] < new[3]) & (new[4] <= budget)
        stack.append((bit - 1, tuple(x[keep] for x in new)))


def _compare(a, b, alo, ahi, blo, bhi, same, budget):
    """Expand small node pairs into fingerprint pairs, ``STEP`` at a time, and compare whole fingerprints."""
    width = bhi - blo
    area = (ahi - alo) * width
    ends = np.cumsum(area)
    for start in range(0, int(ends[-1]), STEP):
        k = np.arange(start, min(start + STEP, int(ends[-1])))
        pair = np.searchsorted(ends, k, side="right")
        inside = k - (ends[pair] - area[pair])
        i, j = alo[pair] + inside // width[pair], blo[pair] + inside % width[pair]
        ok = np.bitwise_count(a[i] ^ b[j]) <= budget
        if same:
            ok &= i < j
        if ok.any():
            yield i[ok], j[ok]


def union(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of i and j in ``parent`` (kept flat: every entry points at its set's least member)."""
    while True:
        ri, rj = parent[i], parent[j]
        open_ = ri != rj
        if not open_.any():
            return
        i, j, ri, rj = i[open_], j[open_], ri[open_], rj[open_]
        np.minimum.at(parent, np.maximum(ri, rj), np.minimum(ri, rj))
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up


def forest(a: np.ndarray, b: np.ndarray, same: bool, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, least fingerprint of its set in this group) that span what the group linked."""
    values = a if same else np.concatenate([a, b])
    order = np.argsort(values, kind="stable")
    values = values[order]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    parent = np.arange(len(values))
    for i, j in close_pairs(a, b, same, budget):
        union(parent, place[i], place[j if same else j + len(a)])
    linked = parent != np.arange(len(values))
    return values[linked], values[parent[linked]]


# -- on Spark --------------------------------------------------------------------------------------

def leaves_of(distinct: DataFrame) -> list[tuple[int, int]]:
    """Leaves of the trie, in order; none holds more than ``FULL_LEAF`` fingerprints.

    The driver gets a count per 16-bit prefix, then one per child of the few prefixes that are too full.
    """
    def counted(depth: int, among: DataFrame) -> dict[int, int]:
        prefix = F.shiftrightunsigned("fp", 64 - depth) if depth < 64 else F.col("fp")
        return {r["p"] % (1 << 64): r["count"] for r in among.groupBy(prefix.alias("p")).count().collect()}

    counts, depth = counted(TOP_BITS, distinct), TOP_BITS
    leaf = min(FULL_LEAF, max(LEAST_LEAF, sum(counts.values()) // LEAVES))
    leaves = cut(counts, leaf)
    while full := [(bits, p) for bits, p in leaves if bits == depth < 64 and counts[p] > FULL_LEAF]:
        inside = distinct.filter(F.shiftrightunsigned("fp", 64 - depth).isin([p for _, p in full]))
        counts = counted(depth + 4, inside)
        below = {x: {p: n for p, n in counts.items() if p >> 4 == x[1]} for x in full}
        leaves = [y for x in leaves for y in (cut(below[x], leaf, depth + 4, x) if x in below else [x])]
        depth += 4
    return leaves


def links(distinct: DataFrame, budget: int = BITS) -> DataFrame:
    """(u, v): links among distinct fingerprints ``fp`` that connect all within ``budget`` bits of each other; some repeat."""
    leaves = leaves_of(distinct)
    pairs = leaf_pairs(leaves, budget)
    starts = np.array([p << (64 - bits) for bits, p in leaves], np.uint64)  # rising, and every fingerprint lies in a leaf
    ends = np.array(pairs, np.int32).reshape(-1, 2)
    lone = ends[:, 0] == ends[:, 1]
    # the (group, side) of every leaf, laid end to end: those of leaf k are first[k] .. first[k + 1]
    owner = np.concatenate([ends[:, 0], ends[~lone, 1]])
    order = np.argsort(owner, kind="stable")
    group = np.concatenate([np.arange(len(ends)), np.flatnonzero(~lone)])[order].astype(np.int32)
    side_of = (order >= len(ends)).astype(np.int8)
    first = np.searchsorted(owner[order], np.arange(len(leaves) + 1))
    sent = distinct.sparkSession.sparkContext.broadcast((starts, group, side_of, first, lone))  # some numbers per leaf

    def deal(batches):
        leaf_at, to, side, start, _ = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, DEAL_ROWS):
                fp = batch.column(0).slice(at, DEAL_ROWS).to_numpy(zero_copy_only=False)
                leaf = np.searchsorted(leaf_at, fp.view(np.uint64), "right") - 1
                times = start[leaf + 1] - start[leaf]
                upto = np.cumsum(times)
                place = np.arange(upto[-1]) + np.repeat(start[leaf] - (upto - times), times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to[place]), pa.array(side[place]), pa.array(np.repeat(fp, times))], ["g", "side", "fp"])

    def solve(key, rows):
        side, own = rows.column("side").to_numpy(), bool(sent.value[4][key[0].as_py()])
        fp = rows.column("fp").to_numpy().view(np.uint64)
        a = np.sort(fp[side == 0])
        u, v = forest(a, a if own else np.sort(fp[side == 1]), own, budget)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    return distinct.select("fp").mapInArrow(deal, "g int, side tinyint, fp bigint").groupBy("g").applyInArrow(
        solve, "u bigint, v bigint")


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Large star: hang a node's greater neighbours on its least one; small star: its lesser ones and itself."""
    both = edges if small else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialize(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "star-least")
    met = both.join(least, "u")
    if small:
        out = met.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
    else:
        out = met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return materialize(out.filter("u <> v").distinct(), "star")


def settled(edges: DataFrame) -> bool:
    """Whether distinct edges (u > v) are stars: no u has two edges or is the v of another. One row per node and task is shuffled."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("below")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("below")))).alias("e")).select("e.*")
    nodes = ends.groupBy("node").agg(F.sum("below").alias("below"), F.min("below").alias("least"))
    return nodes.filter((F.col("below") > 1) | ((F.col("below") == 1) & (F.col("least") == 0))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(u, root): every linked node and the least node of its component (edges have u > v).

    Alternates the two stars until every component is a star around its least node; each
    round is a written table, and links that are stars already need none.
    """
    edges = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while not settled(edges):
        edges = _star(_star(edges, small=False), small=True)
    return edges.withColumnRenamed("v", "root")


def near_duplicates(docs: DataFrame, keys: dict[str, Column], pick: str | None = None, text_col: str = "text",
                    shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The key columns of every row, its ``fp``, and ``least``: the least key (or ``pick`` key) in its component."""
    best = F.min(F.col(pick) if pick else F.struct(*keys)).alias("least")
    rows = materialize(fingerprints(docs, keys, text_col, shingle), "fingerprints")
    each = materialize(rows.groupBy("fp").agg(best), "distinct-fingerprints")
    roots = components(links(each, bits))
    rooted = materialize(each.join(roots, each["fp"] == roots["u"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    whole = materialize(rooted.groupBy("root").agg(F.min("least").alias("least")), "component-least")
    of = materialize(rooted.select("fp", "root").join(whole, "root").select("fp", "least"), "fingerprint-least")
    return rows.join(of, "fp")


#: Row keys of so many dropped rows are broadcast; beyond, rows and keys meet by shuffle.
BROADCAST_KEYS = 1 << 18


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The documents, all columns, one of each component: the row with the least id (then the least row hash).

    Rows meet the keys of those to drop, and only rows that are there several times are
    shuffled to keep one of them; the texts of all others stay where they are while these
    keys are few (``BROADCAST_KEYS``).
    """
    h1, h2 = row_key(docs)
    found = near_duplicates(docs, {"id": F.col(f"`{id_col}`"), "h1": h1, "h2": h2}, None, text_col, shingle, bits)
    a, b = private(docs, "h1"), private(docs, "h2")
    chosen = (F.col("h1") == F.col("least.h1")) & (F.col("h2") == F.col("least.h2"))
    marks = materialize(found.groupBy(F.col("h1").alias(a), F.col("h2").alias(b)).agg(
        F.bool_or(chosen).alias("kept"), F.count("*").alias("n")), "marks")
    n_gone, n_many = marks.agg(F.count_if(~F.col("kept")), F.count_if(F.col("kept") & (F.col("n") > 1))).first()

    def keys_of(rows: DataFrame, n: int) -> DataFrame:
        rows = rows.select(a, b)
        return F.broadcast(rows) if n <= BROADCAST_KEYS else rows

    left = docs.withColumns({a: h1, b: h2}).join(keys_of(marks.filter("not kept"), n_gone), [a, b], "left_anti")
    if n_many:
        many = keys_of(marks.filter("kept and n > 1"), n_many)
        left = left.join(many, [a, b], "left_anti").unionByName(left.join(many, [a, b], "left_semi").dropDuplicates([a, b]))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])

"""Exact top-k inner products by a Voronoi kNN join.

The greatest inner products are the nearest neighbours once every candidate x gets
one more coordinate sqrt(M - |x|^2) (M: the greatest squared norm) and a query gets
0 there: |q - x|^2 = |q|^2 + M - 2 q.x. Pivots split both sides into cells.

Round one solves each query within its own cell. The k-th distance it finds there, or
the bound that follows from the cells' summaries (their k + 1 least distances) if that is
less, is the query's reach. By the triangle inequality, and by the plane between two
pivots, another cell p can hold a better candidate only if neither
|q, p| - (greatest |x, p|), (least |x, p|) - |q, p| nor
(|q, p|^2 - |q, c|^2) / (2 |p, c|) exceeds that reach (c: the query's pivot); in round two
the query goes to those cells, and to no other.

Candidates are dealt once a round to shares of about ``DATA_ROWS`` rows of their cell by row
number, so a cell full of copies is no large task; the queries, the smaller side, travel
to the shares. Beyond ``QUERY_ROWS`` queries both are dealt in blocks of queries. Each share
gives its best k with exact integer scores; the best k of those are the answer. Every
query is answered exactly; bounds have slack for rounding, and ties go to the smaller id.

Components become floor(64 * x). Vectors that are null, empty, or hold null or
non-finite components take no part, nor do rows with a null id; only vectors of equal length are compared. A
row is told from its copies by its row number in the prepared table. Scores must
fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import materialize

SCALE = 64
#: Pivots are chosen farthest first from so many vectors at most (least by hash); they only steer the work.
PIVOTS, PIVOT_SAMPLE = 48, 768
QUERY_ROWS, DATA_ROWS = 4096, 32_768
SLACK = 1e-6


def prepare(vectors: DataFrame, every: int, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(rid, id, v array<bigint>, dim, norm2, is_query) of the rows that take part, written once."""
    x = F.transform(F.col(f"`{vec_col}`"), lambda c: c.cast("double"))
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    ok = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), x.alias("x")).filter(
        F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)).filter(fine)
    v = ok.select("id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))
    return materialize(v.select(
        F.monotonically_increasing_id().alias("rid"), "id", "v", F.size("v").alias("dim"),
        F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")).alias("norm2"),
        F.coalesce(F.col("id") % every == 0, F.lit(False)).alias("is_query")), "vectors")


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def lifted(v: np.ndarray, norm2: float, query: bool) -> np.ndarray:
    v = v.astype(np.float64)
    own = np.zeros(len(v)) if query else np.sqrt(np.maximum(norm2 - (v * v).sum(axis=1), 0))
    return np.column_stack([v, own])


def distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (p * p).sum(axis=1)[None] - 2 * x @ p.T, 0))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    picked, far = [0], distances(sample, sample[:1])[:, 0]
    while len(picked) < min(count, len(sample)) and far.max() > 0:
        picked.append(int(far.argmax()))
        far = np.minimum(far, distances(sample, sample[picked[-1:]])[:, 0])
    return sample[picked]


def reaches(pivots: np.ndarray, radius: np.ndarray, nearest: list, k: int) -> np.ndarray:
    """For each query cell, a distance within which each of its queries has k candidates, from the cells' summaries."""
    apart = distances(pivots, pivots)
    out = np.full(len(pivots), np.inf)
    for c in range(len(pivots)):
        reach = np.sort(np.concatenate([apart[p, c] + radius[c] + np.asarray(d) for p, d in enumerate(nearest) if len(d)] or [[]]))
        if len(reach) > k:
            out[c] = reach[k]  # k + 1 candidates: one may be the query's own row
    return out


def cells_in_reach(to_pivots: np.ndarray, own: np.ndarray, reach: np.ndarray, apart: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """[query, cell] whether a cell may hold a candidate within the query's reach; cells without candidates have least > most."""
    near = to_pivots[np.arange(len(own)), own]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (to_pivots ** 2 - (near ** 2)[:, None]) / (2 * apart[own])
    plane[np.arange(len(own)), own] = 0.0
    bound = np.maximum(np.maximum(to_pivots - most, least - to_pivots), np.nan_to_num(plane, nan=0.0, posinf=0.0))
    slack = SLACK * (1 + to_pivots + np.where(np.isfinite(reach), reach, 0)[:, None])
    return (bound <= reach[:, None] + slack) & (least <= most)


def best_k(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest scores, ties to the earlier place, greatest first."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > edge)
        keep = np.concatenate([above, np.flatnonzero(scores == edge)[:k - len(above)]])
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((keep, -scores[keep]))]


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: by floating point while every partial sum is below 2 ** 53."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most < 2 ** 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def _solve(k: int, dim: int):
    def solve(queries, data):
        q, x = matrix(queries["v"], dim), matrix(data["v"], dim)
        ids, rids = data["id"].to_numpy(zero_copy_only=False), data["rid"].to_numpy()
        order = np.lexsort((rids, ids))
        x, ids, rids = x[order], ids[order], rids[order]
        out = []
        for a in range(0, len(q), 64):
            for i, row in enumerate(products(q[a:a + 64], x), a):
                own = queries["rid"][i].as_py()
                best = best_k(row, k + 1)
                best = best[rids[best] != own][:k]
                out.append((own, queries["id"][i].as_py(), ids[best], row[best]))
        n = [len(o[2]) for o in out]
        return pa.table({
            "rid": pa.array(np.repeat([o[0] for o in out], n).astype(np.int64)),
            "query_id": pa.array(np.repeat([o[1] for o in out], n).astype(np.int64)),
            "vec_id": pa.array(np.concatenate([o[2] for o in out] or [[]]).astype(np.int64)),
            "score": pa.array(np.concatenate([o[3] for o in out] or [[]]).astype(np.int64))})
    return solve


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = prepare(vectors, every, id_col, vec_col, scale)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims = [r["dim"] for r in rows.filter("is_query").select("dim").distinct().orderBy("dim").collect()]
    found = [_top_k_of(rows.filter(F.col("dim") == d), d, k) for d in dims]
    for f in found:
        empty = empty.unionByName(f)
    return found[0] if len(found) == 1 else empty


def _top_k_of(rows: DataFrame, dim: int, k: int) -> DataFrame:
    stats = rows.agg(F.max("norm2").alias("m"), F.count("*").alias("n")).first()
    norm2, parts = stats["m"], max(1, -(-4 * stats["n"] // DATA_ROWS))
    # distinct vectors with the least hashes: only hashes are shuffled to find them
    mark = F.xxhash64("v")
    marks = rows.select(mark.alias("h")).distinct().orderBy("h").limit(PIVOT_SAMPLE).agg(F.max("h")).first()[0]
    sample = rows.filter(mark <= marks).select("v").dropDuplicates().orderBy(mark).limit(PIVOT_SAMPLE).toArrow()
    pivots = choose_pivots(lifted(matrix(sample["v"], dim), norm2, query=False), PIVOTS)

    def assign(batches):
        for b in batches:
            v = matrix(b.column(2), dim)
            query = b.column(3).to_numpy(zero_copy_only=False)
            # a query row is a candidate of the other queries, too
            for part, is_q in ((np.arange(len(v)), False), (np.flatnonzero(query), True)):
                d = distances(lifted(v[part], norm2, is_q), pivots)
                cell = d.argmin(axis=1)
                some = b.take(pa.array(part))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), some.column(2), pa.array(np.full(len(part), is_q)),
                     pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(part)), cell])],
                    ["rid", "id", "v", "is_query", "cell", "dist"])

    cells = materialize(rows.select("rid", "id", "v", "is_query").mapInArrow(
        assign, "rid long, id long, v array<bigint>, is_query boolean, cell int, dist double"), "voronoi")
    radius, least, most, counts = np.zeros(len(pivots)), np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf), np.zeros(len(pivots), np.int64)
    nearest: list = [[] for _ in pivots]
    asked = 0
    for r in cells.groupBy("cell", "is_query").agg(F.count("*").alias("n"), F.min("dist").alias("l"), F.max("dist").alias("u")).collect():
        if r["is_query"]:
            radius[r["cell"]], asked = r["u"], asked + r["n"]
        else:
            counts[r["cell"]], least[r["cell"]], most[r["cell"]] = r["n"], r["l"], r["u"]
    # the k + 1 nearest of each cell: first within each of many parts of a cell, so that a full cell is no single task
    part = F.pmod(F.xxhash64("rid"), F.lit(parts))
    close = cells.filter("not is_query").select("cell", "dist", part.alias("part"))
    for by in (["cell", "part"], ["cell"]):
        close = close.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("dist"))).filter(F.col("r") <= k + 1)
    for r in close.select("cell", "dist").collect():  # pivots x (k + 1) numbers
        nearest[r["cell"]].append(r["dist"])
    known, apart = reaches(pivots, radius, nearest, k), distances(pivots, pivots)
    shares = np.maximum(1, -(-counts // DATA_ROWS))
    blocks = max(1, -(-asked // QUERY_ROWS))
    data, queries = cells.filter("not is_query"), cells.filter("is_query")
    to = ["cell", "share", "block"]
    schema = "cell int, share int, block int, rid long, id long, v array<bigint>"
    found = "rid long, query_id long, vec_id long, score long"

    def dealt(b, place, cell, share, block):
        """Rows of a batch (rid, id, v first) with where they go."""
        some = b.take(pa.array(place))
        return pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(share.astype(np.int32)), pa.array(block.astype(np.int32)),
                                           *some.columns[:3]], [*to, "rid", "id", "v"])

    def each_share(b, place, cell):
        """Queries to all shares of a cell."""
        times = shares[cell]
        share = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        place, cell = np.repeat(place, times), np.repeat(cell, times)
        return dealt(b, place, cell, share, b.column(0).to_numpy()[place] % 1_000_003 % blocks)

    def deal_data(batches):
        for b in batches:
            cell, rid = b.column(3).to_numpy(), b.column(0).to_numpy()
            place = np.repeat(np.arange(b.num_rows), blocks)
            yield dealt(b, place, cell[place], (rid % 999_983 % shares[cell])[place], np.tile(np.arange(blocks), b.num_rows))

    def first_round(batches):
        for b in batches:
            yield each_share(b, np.arange(b.num_rows), b.column(3).to_numpy())

    def second_round(batches):
        for b in batches:
            if not b.num_rows:
                continue
            v, own = matrix(b.column(2), dim), b.column(3).to_numpy()
            x = lifted(v, norm2, True)
            # the k-th score as a distance; a query with fewer than k candidates in its cell has none
            kth = b.column(4).to_numpy(zero_copy_only=False).astype(float)
            square = (x * x).sum(axis=1) + norm2 - 2 * kth
            reach = np.fmin(np.sqrt(np.maximum(square, 0)), known[own])
            go = cells_in_reach(distances(x, pivots), own, reach, apart, least, most)
            go[np.arange(len(own)), own] = False
            place, cell = np.nonzero(go)
            for a in range(0, len(place), 4096):
                yield each_share(b, place[a:a + 4096], cell[a:a + 4096])

    def solved(asked):
        there = data.select("rid", "id", "v", "cell").mapInArrow(deal_data, schema)
        return asked.groupBy(*to).cogroup(there.groupBy(*to)).applyInArrow(_solve(k, dim), found)

    by_score = Window.partitionBy("rid").orderBy(F.col("score").desc(), "vec_id")

    def best(df):
        return df.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)

    one = materialize(best(solved(queries.select("rid", "id", "v", "cell").mapInArrow(first_round, schema))).drop("rank"), "round-one")
    kth = one.groupBy("rid").agg(F.min("score").alias("kth"), F.count("*").alias("n")).filter(F.col("n") == k).select("rid", "kth")
    reach = queries.join(kth, "rid", "left").select("rid", "id", "v", "cell", F.col("kth").cast("double"))
    two = solved(reach.mapInArrow(second_round, schema))
    return best(one.unionByName(two)).select("query_id", "rank", "vec_id", "score")

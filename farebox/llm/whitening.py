"""Embedding whitening by QR, bidiagonalisation and qd iterations.

Each entry c becomes the integer x = floor(64 * c) + 1000000. The fit list holds each
distinct x vector once; all means and covariances are over it, with divisor n. Tasks
reduce the centred rows of their blocks to triangular factors (QR), which are merged in
a tree until one R with R'R = n * covariance is left. Householder reflections make R
bidiagonal, dqds finds its singular values to high relative accuracy, and a twisted
factorisation at each of them gives the direction. Only sums, triangular factors and
small moments are merged; the driver gets a few of them at a time (``FOLD_BYTES``).

Rows take no part if their vector is null, empty, or holds null, NaN, infinite or huge
(``MOST`` and beyond) entries. Vectors of different lengths are fitted apart. Repeated
rows each give their rows; a null id stays null; other columns are not looked at. A
direction is given only if its singular value is at least ``RANK_TOL`` of the greatest
(a constant dimension or too few rows leave fewer), so a list of one vector gives no
rows, nor does an empty table. Directions of equal eigenvalues are any orthonormal set
of their space. ``deviation`` is exact, or null if a long can't hold it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import materialize

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Entries of so great a magnitude have no exact integer form after scaling.
MOST = float(1 << 46)
RANK_TOL = 1e-10
#: Summaries are merged on the driver while they hold no more bytes than this.
FOLD_BYTES = 1 << 26
#: Rows factored at a time.
BLOCK = 4096
EPS = float(np.finfo(float).eps)


def prepare(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x array<bigint>, dim) of the rows that take part, written once."""
    v = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.transform(F.col(f"`{vec_col}`"), lambda c: c.cast("double")).alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < MOST))
    ok = v.filter(F.col("v").isNotNull() & (F.size("v") > 0)).filter(fine)
    return materialize(ok.select("id", F.transform("v", lambda c: F.floor(c * SCALE) + OFFSET).alias("x"),
                                 F.size("v").alias("dim")), "whitening-rows")


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def merged(parts: DataFrame, fold: Callable[[list[list[float]]], list[float]]) -> list[float] | None:
    """One summary out of many: ``parts`` has one column ``m`` (array<double>); ``fold`` merges summaries.

    Many summaries are merged in groups of bounded bytes by tasks, round after round, before the driver merges the rest.
    """
    parts = materialize(parts, "whitening-parts")
    while True:
        s = parts.agg(F.count("*").alias("n"), F.max(F.size("m")).alias("w")).first()
        if not s["n"]:
            return None
        fan = max(2, FOLD_BYTES // (8 * s["w"]))
        if s["n"] <= fan:
            return fold([r["m"] for r in parts.collect()])

        def some(table: pa.Table) -> pa.Table:
            return pa.table({"m": pa.array([fold(table["m"].to_pylist())], pa.list_(pa.float64()))})

        dealt = parts.select("m", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(-(-s["n"] // fan))).alias("g"))
        parts = materialize(dealt.groupBy("g").applyInArrow(some, "m array<double>"), "whitening-parts")


def sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Rows and exact sums of each dimension."""
    def scan(batches):
        n, total = 0, [0] * dim
        for b in batches:
            x = matrix(b.column(0), dim)
            n += len(x)
            # halves of 32 bits, so that no sum of a batch can overflow
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            total = [t + (int(h) << 32) + int(s) for t, h, s in zip(total, high, low)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dim + 1), pa.int32()),
                                          pa.array([*total, n], pa.decimal128(38, 0))], ["k", "s"])

    got = fit.select("x").mapInArrow(scan, "k int, s decimal(38,0)").groupBy("k").agg(F.sum("s").alias("s")).collect()
    by = {r["k"]: int(r["s"]) for r in got}  # dim + 1 numbers
    return by.get(dim, 0), [by.get(k, 0) for k in range(dim)]


@dataclass(frozen=True)
class Centre:
    """The mean S / n as whole part and fraction, so that x - S / n is rounded once."""

    whole: np.ndarray
    part: np.ndarray

    @staticmethod
    def of(n: int, total: list[int]) -> Centre:
        return Centre(np.array([s // n for s in total], np.int64), np.array([(s % n) / n for s in total]))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.part


def triangle(rows: np.ndarray) -> np.ndarray:
    """R of the QR factorisation, filled with zero rows if there are fewer rows than columns."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))]) if len(r) < rows.shape[1] else r


def factor(fit: DataFrame, dim: int, centre: Centre) -> np.ndarray:
    """The triangular factor of all centred rows."""
    def scan(batches):
        r, any_rows = np.zeros((dim, dim)), False
        for b in batches:
            y = centre(matrix(b.column(0), dim))
            any_rows |= len(y) > 0
            for a in range(0, len(y), BLOCK):
                r = triangle(np.vstack([r, y[a:a + BLOCK]]))
        if any_rows:
            yield pa.RecordBatch.from_arrays([pa.array([r.ravel()], pa.list_(pa.float64()))], ["m"])

    def fold(some):
        r = np.zeros((dim, dim))
        for x in some:
            r = triangle(np.vstack([r, np.reshape(x, (dim, dim))]))
        return r.ravel().tolist()

    return np.reshape(merged(fit.select("x").mapInArrow(scan, "m array<double>"), fold), (dim, dim))


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right reflections (as one orthogonal matrix) of Householder's bidiagonal form."""
    a, n = r.copy(), len(r)
    right = np.eye(n)

    def reflector(x):
        """Unit v with (1 - 2vv')x along the first axis; None if it lies there already."""
        rest = np.abs(x[1:]).max(initial=0.0)
        if rest == 0.0:
            return None
        v = x / max(rest, abs(x[0]))
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        return v / np.linalg.norm(v)

    for k in range(n):
        if (v := reflector(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k + 2 < n and (v := reflector(a[k, k + 1:])) is not None:
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ v, v)
            right[:, k + 1:] -= 2 * np.outer(right[:, k + 1:] @ v, v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), right


def qd_pass(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], int]:
    """One differential qd pass with a shift; the last number is the place of the first negative pivot, or -1."""
    d, qq, ee, bad = q[0] - shift, [], [], -1
    if d < 0:
        return [d], ee, 0
    for k in range(len(e)):
        p = d + e[k]
        t = q[k + 1] / p
        qq.append(p)
        ee.append(e[k] * t)
        d = d * t - shift
        if d < 0:
            bad = k + 1
            break
    return [*qq, d], ee, bad


def dqds(q: list[float], e: list[float]) -> list[float]:
    """Eigenvalues of B'B for the bidiagonal B with squared entries q (diagonal) and e (beside it).

    Shifts are eigenvalues of the last 2 x 2 corner; a shift that makes the last pivot negative
    is lowered by that pivot, any other failing shift is quartered, at last to zero.
    """
    out, stack = [], [(list(q), list(e), 0.0)]
    tiny = EPS * EPS
    while stack:
        q, e, sigma = stack.pop()
        if 1.5 * q[0] < q[-1]:  # the small end belongs at the bottom; a flipped B has the same singular values
            q, e = q[::-1], e[::-1]
        while len(q) > 1:
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= tiny * (sigma + min(q[k], q[k + 1]))
                        or e[k] <= np.finfo(float).tiny), None)
            if cut is not None:
                stack.append((q[:cut + 1], e[:cut], sigma))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            # BB' has the diagonal q + e and squared neighbours q[k + 1] * e[k]
            a, b, c2 = q[-2] + e[-1], q[-1], q[-1] * e[-1]
            half = (a - b) / 2
            shift = max(0.0, min(a, b) - c2 / (abs(half) + np.sqrt(half * half + c2)))
            while True:
                qq, ee, bad = qd_pass(q, e, shift)
                if bad < 0 or shift == 0.0:
                    break
                lower = shift + qq[-1] if bad == len(q) - 1 else 0.0
                shift = lower if 0 < lower < shift * (1 - 8 * EPS) else shift / 4 if shift > EPS * (sigma + q[-1]) else 0.0
            q, e, sigma = qq, ee, sigma + shift
        out.append(q[0] + sigma)
    return out


def twisted(q: np.ndarray, e: np.ndarray, g: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of the tridiagonal B'B (q, e squared entries, g its neighbours) at an eigenvalue.

    Stationary factors from the top and progressive ones from the bottom meet where the twist is least.
    """
    n, least = len(q), EPS * EPS * max(float(q.max() + e.max(initial=0.0)), 1e-300)

    def safe(x):
        return x if abs(x) > least else least if x >= 0 else -least

    s, low = np.empty(n), np.empty(max(n - 1, 0))
    s[0] = -value
    for k in range(n - 1):
        d = safe(s[k] + q[k])
        low[k] = g[k] / d
        s[k + 1] = e[k] / d * s[k] - value
    p, up = np.empty(n), np.empty(max(n - 1, 0))
    p[-1] = q[-1] - value
    for k in range(n - 2, -1, -1):
        r = safe(e[k] + p[k + 1])
        up[k] = g[k] / r
        p[k] = p[k + 1] * (q[k] / r) - value
    at = int(np.abs(s + p + value).argmin())
    z = np.zeros(n)
    z[at] = 1.0
    for k in range(at - 1, -1, -1):
        z[k] = -low[k] * z[k + 1]
    for k in range(at, n - 1):
        z[k + 1] = -up[k] * z[k]
    return z / np.linalg.norm(z)


def _close_vectors(q, e, g, values, first) -> list[np.ndarray]:
    """Vectors of a cluster: inverse iteration from the twisted one, kept orthogonal within the cluster."""
    t = np.diag(q + np.concatenate([[0.0], e])) + np.diag(g, 1) + np.diag(g, -1)
    rng, out = np.random.default_rng(first), []
    for value in values:
        z = twisted(q, e, g, value)
        for _ in range(4):
            for o in out:
                z = z - o * (o @ z)
            if np.linalg.norm(z) < 0.5:
                z = rng.standard_normal(len(q))
                for o in out:
                    z = z - o * (o @ z)
            z /= np.linalg.norm(z)
            off = 4 * EPS * max(abs(value), EPS * np.abs(t).max()) * rng.uniform(0.5, 1.0)
            try:
                y = np.linalg.solve(t - (value + off) * np.eye(len(q)), z)
            except np.linalg.LinAlgError:
                break
            z = y / np.linalg.norm(y)
        for o in (*out, *out):
            z = z - o * (o @ z)
        out.append(z / np.linalg.norm(z))
    return out


def spectrum(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a triangular factor, falling, and its right singular vectors as columns."""
    scale = np.abs(r).max(initial=0.0)
    if not scale:
        return np.zeros(len(r)), np.eye(len(r))
    a, b, right = bidiagonal(r / scale)
    # entries that rounding can't tell from zero part the matrix into blocks
    b[np.abs(b) <= EPS * (np.abs(a[:-1]) + np.abs(a[1:]))] = 0.0
    edges = [0, *(np.flatnonzero(b == 0) + 1), len(a)]
    values, vectors = np.empty(len(a)), np.zeros((len(a), len(a)))
    for i, j in zip(edges, edges[1:]):
        q, e, g = a[i:j] ** 2, b[i:j - 1] ** 2, a[i:j - 1] * b[i:j - 1]
        own = sorted(dqds(q.tolist(), e.tolist()), reverse=True)
        k = 0
        while k < len(own):
            m = k + 1
            while m < len(own) and own[m - 1] - own[m] <= 1e-3 * own[k]:
                m += 1
            found = [twisted(q, e, g, own[k])] if m == k + 1 else _close_vectors(q, e, g, own[k:m], k)
            for x, z in enumerate(found, k):
                values[i + x], vectors[i:j, i + x] = own[x], z
            k = m
    order = np.argsort(-values, kind="stable")
    return values[order] * scale * scale, right @ vectors[:, order]


@dataclass(frozen=True)
class Whitener:
    n: int
    total: list[int]
    centre: Centre
    values: np.ndarray  # eigenvalues of the covariance, falling
    trace: float
    directions: np.ndarray  # dimensions x components
    identity_error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre(x) @ self.directions / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum over the dimensions of (n * x - S) ** 2."""
        far = max((abs(int(m) * self.n - s) for e in (x.max(axis=0), x.min(axis=0)) for m, s in zip(e, self.total)), default=0) if len(x) else 0
        if x.shape[1] * far * far < 2 ** 63 and all(abs(s) < 2 ** 63 for s in self.total) and np.abs(x).max(initial=0) * self.n < 2 ** 63:
            d = x * np.int64(self.n) - np.array(self.total, np.int64)
            return pa.array((d * d).sum(axis=1), pa.int64())
        exact = [sum((int(c) * self.n - s) ** 2 for c, s in zip(row, self.total)) for row in x]
        return pa.array([v if v < 2 ** 63 else None for v in exact], pa.int64())


def fit_list(rows: DataFrame) -> DataFrame:
    """Each distinct vector once; copies meet in the partial aggregate of each task."""
    return materialize(rows.groupBy("x").agg(F.max("dim").alias("dim")), "whitening-fit")


def fit(distinct: DataFrame, dim: int, components: int = COMPONENTS) -> Whitener:
    """Learn the whitening of the distinct vectors of length ``dim``."""
    n, total = sums(distinct, dim)
    centre = Centre.of(n, total)
    squares, vectors = spectrum(factor(distinct, dim, centre))
    kept = int((np.sqrt(squares[:components]) > RANK_TOL * np.sqrt(squares[0])).sum()) if squares[0] > 0 else 0
    w = Whitener(n, total, centre, squares[:kept] / n, float(squares.sum()) / n, np.ascontiguousarray(vectors[:, :kept]))
    return Whitener(**{**w.__dict__, "identity_error": identity_error(distinct, dim, w) if kept else 0.0})


def identity_error(distinct: DataFrame, dim: int, w: Whitener) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(w.values)

    def join(a, b):
        """Merge (rows, mean, centred products) of two parts."""
        n = a[0] + b[0]
        if not n:
            return a
        apart = b[1] - a[1]
        return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)

    def pack(s):
        return [float(s[0]), *s[1], *s[2].ravel()]

    def unpack(m):
        return m[0], np.array(m[1:k + 1]), np.reshape(m[k + 1:], (k, k))

    def none():
        return 0.0, np.zeros(k), np.zeros((k, k))

    def scan(batches):
        s = none()
        for b in batches:
            y = w.whitened(matrix(b.column(0), dim))
            if len(y):
                mean = y.mean(axis=0)
                s = join(s, (float(len(y)), mean, (y - mean).T @ (y - mean)))
        if s[0]:
            yield pa.RecordBatch.from_arrays([pa.array([pack(s)], pa.list_(pa.float64()))], ["m"])

    def fold(some):
        s = none()
        for m in some:
            s = join(s, unpack(m))
        return pack(s)

    n, _, products = unpack(merged(distinct.select("x").mapInArrow(scan, "m array<double>"), fold))
    return float(np.abs(products / n - np.eye(k)).max())


OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def transform(rows: DataFrame, dim: int, w: Whitener) -> DataFrame:
    """A row for each vector and component."""
    k = len(w.values)
    sent = rows.sparkSession.sparkContext.broadcast(w)  # dimensions x components

    def scan(batches):
        w = sent.value
        for b in batches:
            x = matrix(b.column(1), dim)
            m = len(x)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, w.n, np.int64)), w.deviation(x).take(each), pa.array(w.whitened(x).ravel()),
                pa.array(np.tile(w.values / w.trace, m)), pa.array(np.full(m * k, w.identity_error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("id", "x").mapInArrow(scan, OUT)


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every row that takes part."""
    rows = prepare(vectors, id_col, vec_col)
    distinct = fit_list(rows)
    out = vectors.sparkSession.createDataFrame([], OUT)
    found = []
    for dim in [r["dim"] for r in distinct.select("dim").distinct().orderBy("dim").collect()]:
        w = fit(distinct.filter(F.col("dim") == dim), dim, components)
        if len(w.values):
            found.append(transform(rows.filter(F.col("dim") == dim), dim, w))
    for f in found:
        out = out.unionByName(f)
    return found[0] if len(found) == 1 else out

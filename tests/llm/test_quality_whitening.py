"""Quality classifier: gradients, held-out accuracy, edge rows. Whitening: solver and rows against numpy."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from farebox.llm import milquality, queries, whitening

SF = "/root/testdata/sf0.1"
LABELS = "doc_id bigint, quality int, toxic int"


# --- quality classifier

def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((9, milquality.FEATURES)) / 8
    starts, y, weight = np.array([0, 2, 3, 7]), np.array([0.0, 1, 1, 0]), np.array([1.0, 0.5, 2, 1])
    m = {k: v.astype(float) for k, v in milquality.fresh().items()}
    m["b"] = rng.standard_normal(milquality.HIDDEN)

    def loss():
        h, _, _, a = milquality.attend(m, x)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0) / np.add.reduceat(a, starts)[:, None]
        p = milquality.sigmoid(z @ m["b"] + m["c"])
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean()

    got = milquality.gradients(m, x, starts, y, weight)
    for k, v in m.items():
        at = tuple(rng.integers(0, n) for n in v.shape)
        old, step = v[at], 1e-5
        v[at] = old + step
        more = loss()
        v[at] = old - step
        less = loss()
        v[at] = old
        assert got[k][at] == pytest.approx((more - less) / (2 * step), abs=2e-7), k


def plain_score(text, m):
    """One document at a time, all its passages at once."""
    text = text or ""
    parts = [text[i:i + milquality.PASSAGE] for i in range(0, len(text), milquality.PASSAGE)] or [""]
    x = np.concatenate([milquality.encode(np.array([len(p)]), np.frombuffer(p.encode("utf-32-le", "replace"), np.uint32)) for p in parts])
    h = np.tanh(x @ m["W"] + m["Wb"])
    e = (np.tanh(h @ m["V"]) / (1 + np.exp(-(h @ m["U"])))) @ m["w"]
    a = np.exp(e - e.max()) / np.exp(e - e.max()).sum()
    return 1 / (1 + np.exp(-(a @ h @ m["b"] + m["c"][0])))


def test_word_counts_of_a_passage():
    text = "a b b c  a-b\nb b"
    x = milquality.encode(np.array([len(text)]), np.frombuffer(text.encode("utf-32-le"), np.uint32))[0]
    words = text.split()
    once, twice = (sum(a == b for a, b in zip(words[k:], words)) / len(words) for k in (1, 2))
    assert x[-6:-2] == pytest.approx([len(set(words)) / len(words), once, twice, words.count("b") / len(words)])


def test_scores_are_those_of_whole_texts(monkeypatch):
    r, m = random.Random(2), milquality.fresh()
    m["b"] = np.random.default_rng(4).standard_normal(milquality.HIDDEN).astype(np.float32)
    texts = ["", None, " ", "x", "The end. " * 5000, "#!" * 300, "é" * 513, "\U0001f600 \ud800 ok"]
    texts += ["".join(r.choice("ab C,.\n!é1") for _ in range(r.randrange(1, 3000))) for _ in range(40)]
    want = [plain_score(t, m) for t in texts]
    assert milquality.score_batch(texts, m) == pytest.approx(want, abs=1e-5)
    monkeypatch.setattr(milquality, "STEP", 3 * milquality.PASSAGE)  # a long text in many blocks
    assert milquality.score_batch(texts, m) == pytest.approx(want, abs=1e-5)


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in queries.op12_quality(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    held = [x for x in labels if x["doc_id"] in got and zlib.crc32(str(x["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 500 and all(got[x["doc_id"]]["held_out"] for x in held)
    right = [got[x["doc_id"]]["predicted"] == x["quality"] for x in held]
    assert sum(right) / len(right) > 0.985
    for q in (0, 1):
        own = [got[x["doc_id"]]["predicted"] == q for x in held if x["quality"] == q]
        assert sum(own) / len(own) > 0.95
    scores = np.array([got[x["doc_id"]]["score"] for x in held])
    y = np.array([x["quality"] for x in held])
    rank = scores.argsort().argsort()
    assert (rank[y == 1].mean() - rank[y == 0].mean()) / len(y) + 0.5 > 0.995


def test_labels_of_held_out_rows_are_not_learned(spark, docs):
    """Turning the labels of held-out ids round changes no score."""
    ids = [r["doc_id"] for r in docs.select("doc_id").distinct().collect() if r["doc_id"] is not None]
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0

    def scores(flip):
        rows = [(i, (i % 3 == 0) ^ (flip and zlib.crc32(str(i).encode()) % 5 == 0), 0) for i in ids]
        labels = spark.createDataFrame([(a, int(b), c) for a, b, c in rows], LABELS)
        m = milquality.train(docs.filter(~held), labels, epochs=1)
        return sorted((r["k"] or -1, r["score"]) for r in milquality.predict(docs, m, {"k": F.col("doc_id")}).collect())

    assert scores(False) == scores(True)


def test_quality_edge_rows(spark, docs, crowded, no_docs):
    keys = {"doc_id": F.col("doc_id")}
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (3, 1, 0), (3, 0, 1), (5, None, 0), (6, 7, 0)], LABELS)
    m = milquality.train(docs, labels, epochs=2)
    scored = milquality.predict(docs, m, keys)
    plain = sorted(((r["doc_id"] is None, r["doc_id"]), r["score"]) for r in scored.fillna(-1, "doc_id").collect())
    again = sorted(((r["doc_id"] is None, r["doc_id"]), r["score"]) for r in milquality.predict(
        crowded, milquality.train(crowded, labels.select("*", F.lit("x").alias("text")), epochs=2), keys).fillna(-1, "doc_id").collect())
    assert len(plain) == docs.count() and [p[0] for p in plain] == [p[0] for p in again]
    assert [p[1] for p in plain] == pytest.approx([p[1] for p in again], abs=1e-6)
    no_labels = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in milquality.predict(docs, milquality.train(docs, no_labels), keys).collect()} == {0.5}
    assert milquality.predict(no_docs, milquality.train(no_docs, labels), keys).collect() == []
    taken, sizes = milquality.sample(docs, labels, 1000)
    ids = {r["doc_id"] for r in labels.collect()}
    assert sum(sizes.values()) == docs.filter(F.col("doc_id").isin([i for i in ids if i is not None and i < 60 and i not in (3,)])).count()
    assert taken.count() == taken.distinct().count() and set(taken.columns) == {"y", "text"}


def test_sample_is_bounded(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t "), "id").alias("text"))
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 4 != 0).cast("int").alias("quality"))
    found, sizes = milquality.sample(docs, labels, 200)
    n = {r["y"]: r["count"] for r in found.groupBy("y").count().collect()}
    assert sizes == {0: 1000, 1: 3000} and all(140 < n[k] < 270 for k in (0, 1))


# --- whitening

def matrices():
    rng = np.random.default_rng(3)
    copy = np.zeros((20, 8))
    copy[:, 3] = copy[:, 5] = rng.standard_normal(20)
    return {"random": rng.standard_normal((300, 64)), "graded": rng.standard_normal((300, 40)) * np.logspace(0, -6, 40),
            "few rows": rng.standard_normal((7, 20)), "unit": np.eye(12), "centred unit": np.eye(12) - 1 / 12, "copied": copy,
            "one column": rng.standard_normal((9, 1)), "alike": np.linalg.qr(rng.standard_normal((99, 16)))[0] * (1 + 1e-9 * np.arange(16)),
            "zero": np.zeros((5, 5)), "whole": np.floor(rng.standard_normal((50, 6)) * 10)}


@pytest.mark.parametrize("name", matrices())
def test_solver_equals_svd(name):
    y = matrices()[name]
    values, vectors = whitening.spectrum(whitening.triangle(y))
    want = np.zeros(y.shape[1])
    found = np.linalg.svd(y, compute_uv=False) ** 2
    want[:len(found)] = found
    assert values == pytest.approx(want, rel=1e-10, abs=1e-14 * max(1e-300, want[0]))
    kept = vectors[:, values > 1e-20 * max(values[0], 1e-300)]
    assert np.abs(kept.T @ kept - np.eye(kept.shape[1])).max(initial=0.0) < 1e-9
    assert np.abs(y.T @ (y @ kept) - kept * values[:kept.shape[1]]).max(initial=0.0) <= 1e-12 * max(values[0], 1e-300)


def test_qd_iterations_keep_small_values_accurate():
    a, b = np.logspace(0, -8, 30), np.full(29, 1e-3) * np.logspace(0, -7, 29)
    got = sorted(np.sqrt(whitening.dqds((a * a).tolist(), (b * b).tolist())), reverse=True)
    assert got == pytest.approx(np.linalg.svd(np.diag(a) + np.diag(b, 1), compute_uv=False), rel=1e-8)


def plain_whitening(rows, components=16):
    keep = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    out = {}
    for dim in {len(v) for _, v in keep}:
        own = [(i, np.floor(64 * np.array(v, float)).astype(np.int64) + 1_000_000) for i, v in keep if len(v) == dim]
        fit = np.unique(np.stack([x for _, x in own]), axis=0)
        n, s = len(fit), fit.sum(axis=0)
        y = (n * fit - s) / n
        values, vectors = np.linalg.eigh(y.T @ y / n)
        out[dim] = own, n, s, values[::-1], vectors[:, ::-1]
    return out


def check_rows(got, rows):
    want = plain_whitening(rows)
    total = 0
    for dim, (own, n, s, values, vectors) in want.items():
        k = min(16, int((values > 1e-12 * values.sum()).sum())) if n > 1 else 0
        x = np.stack([x for _, x in own])
        ids = [i for i, _ in own]
        white = (n * x - s) / n @ vectors[:, :k] / np.sqrt(values[:k])
        mine = {}
        for r in got:
            if r["n"] == n:
                mine.setdefault(r["component"], []).append(r)
        assert len(mine) == k
        for c in range(k):
            assert sorted(r["vec_id"] for r in mine[c + 1]) == sorted(ids)
            assert mine[c + 1][0]["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-8)
            by = {r["vec_id"]: r for r in mine[c + 1]}
            sign = np.sign(sum(by[i]["whitened"] * w for i, w in zip(ids, white[:, c])))
            assert [by[i]["whitened"] for i in ids] == pytest.approx(list(sign * white[:, c]), abs=1e-6)
            assert [by[i]["deviation"] for i in ids] == [int(((n * v - s) ** 2).sum()) for v in x]
        total += k * len(ids)
    assert len(got) == total and all(r["identity_error"] < 1e-4 for r in got)


def test_registered_whitening(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check_rows(queries.op13_whitening(spark, sf).collect(), rows)


SCHEMA = "vec_id bigint, embedding array<float>"


def test_whitening_edge_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(c)) for c in rng.standard_normal(5) * [1, 2, 3, 0.5, 0.1]]) for i in range(70)]
    rows += [(100 + i, rows[4][1]) for i in range(40)]  # copies count once in the fit
    rows += [(200, None), (201, []), (202, [1.0, None, 2.0, 1.0, 1.0]), (203, [float("nan")] * 5), (204, [float("inf")] + [0.0] * 4)]
    rows += [(300 + i, [float(i), float(i * i % 7), 1.0]) for i in range(9)]  # another length, one constant dimension
    rows += [(400, [1.0, 2.0])]  # alone: no direction
    df = spark.createDataFrame(rows, SCHEMA).repartition(6).select("*", *[F.lit(1).alias(c) for c in ("x", "id", "dim", "n", "m", "g", "v")])
    check_rows(whitening.whiten(df).collect(), rows)
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    null_id = whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [0.5, 1.0])], SCHEMA)).collect()
    assert sorted((r["vec_id"] is None, r["component"]) for r in null_id) == [(False, 1)] * 3 + [(False, 2)] * 3 + [(True, 1), (True, 2)]


def test_summaries_are_merged_in_rounds(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(c)) for c in rng.standard_normal(6)]) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(24)
    monkeypatch.setattr(whitening, "FOLD_BYTES", 700)  # three factors at a time
    distinct = whitening.fit_list(whitening.prepare(df, "vec_id", "embedding")).repartition(24)
    w = whitening.fit(distinct, 6)
    (own, n, s, values, _), = plain_whitening(rows).values()
    assert w.n == n and w.total == s.tolist() and w.values == pytest.approx(values, rel=1e-10) and w.identity_error < 1e-10


def test_deviation_is_exact_or_null():
    w = whitening.Whitener(3, [3_000_005], whitening.Centre.of(3, [3_000_005]), np.ones(1), 1.0, np.ones((1, 1)))
    x = np.array([[1_000_000], [1_000_000 + 10 ** 9], [1_000_000 + 2 ** 50]])
    want = [(3 * int(v) - 3_000_005) ** 2 for v in x[:, 0]]
    assert w.deviation(x).to_pylist() == [want[0], want[1] if want[1] < 2 ** 63 else None, None]
    assert w.deviation(x[:1]).to_pylist() == want[:1]

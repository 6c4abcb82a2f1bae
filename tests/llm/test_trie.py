"""The prefix trie against a plain trie of Python tuples."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from farebox.llm import queries, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_trie(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).digest(), text or ""))
    turns = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in convs.items()}
    nodes, ends, kids = {}, {}, {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        path = tuple(turns.get(base, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
            if d:
                kids.setdefault(path[:d - 1], set()).add(path[:d])
        ends.setdefault(path, []).append(c)

    out = {}
    for node in sorted(nodes, key=len, reverse=True):  # children first, so that no call goes deep
        below = [out[k] for k in kids.get(node, ())]
        words = len([w for w in re.split(r"[\x20\x09-\x0D]+", node[-1][1]) if w]) if node else 0
        out[node] = (sum(b[0] for b in below) or 1, (len(nodes[node]) - 1) * words + sum(b[1] for b in below))
    return sorted((min(m), len(n), min(nodes[n[:-1]]) if n else -1, len(m), len(kids.get(n, ())), *out[n],
                   sha(",".join(map(str, sorted(ends.get(n, [])))))) for n, m in nodes.items())


def got_trie(df, band=trie.BAND):
    return sorted(tuple(-1 if v is None else v for v in r) for r in trie.prefix_trie(df, band).select(*COLUMNS).collect())


def make_rows(seed=5, convs=120, deep=70):
    r = random.Random(seed)
    said = ["a", "b c", "", None, "x \n y\tz", "\xa0 é", "word " * 9]
    rows = []
    for c in range(convs):
        c = c if c % 7 else c * 3 + 1
        for t in range(r.choice([1, 2, 3, 5, 8])):
            rows.append((c, t if r.random() < 0.95 else None, r.choice(["user", "assistant", None]), r.choice(said)))
    for c in (2000, 2001, 2002, 2020, 2021):  # long paths that part late
        rows += [(c, t, "user", "same" if t < deep - 5 else f"own {c} {t}") for t in range(deep)]
    rows += [(c, t, "user", "hot") for c in range(3000, 3060) for t in range(3)]  # many equal conversations
    rows += [(None, 0, "user", "no conversation"), (40_000, 1, "user", "alone"), (-7, 0, "user", "hot"), (-7, 0, "user", "hot")]
    return rows


@pytest.mark.parametrize("band", [2, 4, 16])
def test_trie_equals_plain_trie(spark, band):
    rows = make_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got_trie(df, band) == plain_trie(rows)


def test_one_long_conversation_is_cut_into_chunks(spark):
    rows = [(20, t, "user", f"turn {t % 11}") for t in range(900)] + [(21, t, "user", f"turn {t % 11}") for t in range(5)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert trie.chunked(df).filter("conv = 20").select("chunk").distinct().count() > 3
        assert got_trie(df, 8) == plain_trie(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_row_becomes_no_more_rows_than_a_band_holds(spark):
    df = spark.createDataFrame([(c, t, "user", f"{c}") for c in range(3) for t in range(200)], SCHEMA)
    nodes = trie.nodes_of(trie.paths(df), 8)
    assert nodes.agg(F.max(F.size("above"))).first()[0] == 8


def test_ids_in_several_pieces(spark):
    ids = [1, 5, 70_000, 70_001, 9_000_000_000, -3]
    rows = [(c, 0, "user", f"{t}") for c in ids for t in ("x",)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got_trie(df) == plain_trie(rows)


def test_empty_and_crowded_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(empty).collect() == []
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).collect() == []
    rows = make_rows(seed=9, convs=30, deep=20)
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in (
        "depth", "k1", "chunk", "conv", "words", "copy", "sha", "place", "h", "s1", "band")])
    assert got_trie(df) == plain_trie(rows)
    nulls = [(1, None, None, None), (1, None, None, None), (2, None, "user", None)]
    assert got_trie(spark.createDataFrame(nulls, SCHEMA)) == plain_trie(nulls)


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(tuple(-1 if v is None else v for v in r) for r in queries.op11_prefix_trie(spark, sf).select(*COLUMNS).collect())
    assert got == plain_trie(rows)

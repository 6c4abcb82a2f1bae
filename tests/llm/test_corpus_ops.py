"""Decontamination, SimHash, LM scoring, mixing, sharding, top-k and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from farebox.llm import decontam, lm, mixing, queries, sharding, simhash, topk

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- decontamination -------------------------------------------------------------------------------

def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_contamination(text, items):
    w = words(text)
    hit, which = set(), set()
    for item, t in items:
        iw = words(t)
        n = min(10, len(iw))
        windows = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(w) - n + 1) if n else ():
            if tuple(w[i:i + n]) in windows:
                hit |= set(range(i, i + n))
                which.add(str(item))
    return len(w), len(hit), sorted(which)


def some_items(doc_rows):
    long = [words(r[1]) for r in doc_rows if len(words(r[1])) >= 30]
    return [(1, " ".join(long[0][3:22])), (2, "Totally New, words that are in none of the documents at all here"),
            (3, " ".join(long[1][:10]).upper()), (4, " ".join(long[2][5:14])), (5, "the river"), (6, None), (7, "..."),
            (10, " ".join(long[0][3:22])), (11, "été"), (12, " ".join(long[3][-25:])), (13, "word " * 40),
            (14, " ".join(long[4][2:8]))]


def test_contamination_equals_plain_search(spark, docs, doc_rows):
    items = some_items(doc_rows)
    bench = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, doc_id int").repartition(2)
    got = decontam.contamination(docs, bench).collect()
    assert len(got) == len(doc_rows)
    want = Counter((d, *map(str, plain_contamination(t, items))) for d, t, *_ in doc_rows)
    assert Counter((r["doc_id"], str(r["n_words"]), str(r["n_hit"]), str(r["items"])) for r in got) == want
    assert any(r["n_hit"] for r in got) and not all(r["n_hit"] for r in got)


@pytest.mark.parametrize("limit", [0, 100_000])
def test_random_windows(spark, limit, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", limit)
    r = random.Random(1)
    text = lambda n: " ".join(r.choice("a b c".split()) for _ in range(n))
    rows = [(i, text(r.randrange(0, 40))) for i in range(60)]
    items = [(i, text(r.randrange(5, 16))) for i in range(25)]
    got = decontam.contamination(spark.createDataFrame(rows, "doc_id long, text string"),
                                 spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(x["doc_id"], x["n_words"], x["n_hit"], tuple(x["items"])) for x in got} == {
        (d, a, b, tuple(c)) for d, t in rows for a, b, c in [plain_contamination(t, items)]}


def test_decontaminate_keeps_clean_rows(spark, crowded, no_docs, doc_rows):
    items = some_items(doc_rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.decontaminate(crowded, bench)
    assert got.columns == crowded.columns
    clean = Counter(str(d) for d, t, *_ in doc_rows if not plain_contamination(t, items)[1])
    assert Counter(str(r["doc_id"]) for r in got.collect()) == clean
    assert decontam.contamination(no_docs, bench).collect() == []
    assert decontam.decontaminate(crowded, bench.limit(0)).count() == len(doc_rows)


def test_contaminated_splits_texts_once(spark):
    sf = "/root/testdata/sf0.001"
    found = decontam.contaminated(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


# -- SimHash ---------------------------------------------------------------------------------------

def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return 0
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def plain_components(fps, bits=2):
    """Class of each place: least place linked, by all pairs."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= bits:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_near_duplicates_equal_all_pairs(docs, doc_rows, no_docs):
    fps = [plain_fingerprint(r[1]) for r in doc_rows]
    classes = plain_components(fps)
    least = defaultdict(list)
    for r, c in zip(doc_rows, classes):
        if r[0] is not None:
            least[c].append(r[0])
    want = Counter((str(r[0]), f, min(least[c], default=None)) for r, f, c in zip(doc_rows, fps, classes))
    got = simhash.near_duplicates(docs, {"doc_id": F.col("doc_id")}, "doc_id").collect()
    assert Counter((str(r["doc_id"]), r["fp"] % 2 ** 64, r["least"]) for r in got) == want
    assert simhash.near_duplicates(no_docs, {"doc_id": F.col("doc_id")}, "doc_id").collect() == []


def test_drop_near_duplicates(crowded, doc_rows):
    fps = [plain_fingerprint(r[1]) for r in doc_rows]
    got = simhash.drop_near_duplicates(crowded)
    assert got.columns == crowded.columns
    rows = got.collect()
    assert len(rows) == len(set(plain_components(fps)))
    assert len({r["doc_id"] for r in rows}) == len(rows)


def test_fingerprint_in_pieces(monkeypatch):
    text = " ".join(random.Random(2).choice("ab cd ef".split()) for _ in range(500))
    whole = simhash.fingerprint(text.encode())
    assert whole == plain_fingerprint(text)
    monkeypatch.setattr(simhash, "STEP", 7)
    assert simhash.fingerprint(text.encode()) == whole


def clustered(n, seed=5):
    r = random.Random(seed)
    out = {0, 2 ** 64 - 1}
    while len(out) < n:
        c = r.getrandbits(64)
        for _ in range(r.choice([1, 1, 3, 20])):
            x = c
            for _ in range(r.randrange(4)):
                x ^= 1 << r.randrange(64)
            out.add(x)
            if r.random() < 0.3:
                c = x
    return sorted(out)


@pytest.mark.parametrize("step,leaf,full", [(1 << 17, 2048, 1 << 21), (50, 40, 1 << 21), (50, 40, 12)])
def test_trie_join_finds_every_link(spark, monkeypatch, step, leaf, full):
    monkeypatch.setattr(simhash, "STEP", step)
    monkeypatch.setattr(simhash, "LEAST_LEAF", leaf)
    monkeypatch.setattr(simhash, "FULL_LEAF", full)
    fps = clustered(700)
    signed = [x - (x >> 63 << 64) for x in fps]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    got = {r["u"]: r["root"] for r in simhash.components(edges).collect()}
    classes = plain_components(fps)
    root = [got.get(x, x) for x in signed]
    for i, j in itertools.combinations(range(len(fps)), 2):
        assert (root[i] == root[j]) == (classes[i] == classes[j])
    u = np.array(fps, np.uint64)
    pairs = {tuple(p) for i, j in simhash.close_pairs(u, u, True, 2) for p in zip(i.tolist(), j.tolist())}
    assert pairs == {(i, j) for i, j in itertools.combinations(range(len(fps)), 2) if (fps[i] ^ fps[j]).bit_count() <= 2}


def test_leaves_are_cut_below_sixteen_bits(spark, monkeypatch):
    """All fingerprints under one prefix: no leaf holds more than the bound, and no link is lost."""
    monkeypatch.setattr(simhash, "FULL_LEAF", 25)
    monkeypatch.setattr(simhash, "LEAST_LEAF", 25)
    r = random.Random(9)
    fps = sorted({0xABCD << 48 | x % 2 ** 20 for x in clustered(400)} | {0xABCD << 48 | r.getrandbits(48) for _ in range(200)})
    df = spark.createDataFrame([(x - (x >> 63 << 64),) for x in fps], "fp long")
    leaves = simhash.leaves_of(df)
    inside = [sum(x >> (64 - bits) == p for x in fps) for bits, p in leaves]
    assert sum(inside) == len(fps) and max(inside) <= 25 and max(bits for bits, _ in leaves) > 16
    assert [p << (64 - bits) for bits, p in leaves] == sorted(p << (64 - bits) for bits, p in leaves)
    got = {x["u"]: x["root"] for x in simhash.components(simhash.links(df)).collect()}
    root = [got.get(x - (x >> 63 << 64), x - (x >> 63 << 64)) for x in fps]
    classes = plain_components(fps)
    for i, j in itertools.combinations(range(len(fps)), 2):
        assert (root[i] == root[j]) == (classes[i] == classes[j])


def test_dropped_rows_by_shuffle_too(crowded, monkeypatch):
    few = sorted(str(r) for r in simhash.drop_near_duplicates(crowded).collect())
    monkeypatch.setattr(simhash, "BROADCAST_KEYS", 0)
    assert sorted(str(r) for r in simhash.drop_near_duplicates(crowded).collect()) == few


def test_leaf_pairs_lose_no_pair():
    counts = Counter(x >> 48 for x in clustered(3000, 9))
    leaves = simhash.cut(counts, 60)
    of = lambda x: next(i for i, (b, p) in enumerate(leaves) if x >> (16 - b) == p)
    pairs = set(simhash.leaf_pairs(leaves, 2))
    some = list(counts)[:300]
    for x, y in itertools.combinations_with_replacement(some, 2):
        if (x ^ y).bit_count() <= 2:
            assert (min(of(x), of(y)), max(of(x), of(y))) in pairs


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5001, 5000)]
    got = {r["u"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and all(got[1000 + i] == 1000 for i in range(1, 300)) and got[5001] == 5000


# -- LM --------------------------------------------------------------------------------------------

def tokens(text):
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))] + [None]


def plain_lm(train, texts, frequent=10 ** 9, every=None, alpha=0.1):
    """Token counts and scores by dictionaries, one token at a time; ``every``: the texts that frequent words are counted in."""
    c = Counter(t for x in train for t in tokens(x))
    n, v = sum(c.values()), len(c)
    seen = Counter(t for x in (texts if every is None else every) for t in tokens(x) if t is not None)
    level = Counter(math.floor(4 * math.log2(k)) for k in seen.values())
    room, kept = frequent, set()
    for lv in sorted(level, reverse=True):
        if level[lv] > room:
            break
        room -= level[lv]
        kept |= {w for w, k in seen.items() if math.floor(4 * math.log2(k)) == lv}
    rare = [k for w, k in c.items() if w is not None and w not in kept]
    mass = n + alpha * (len(kept) + 2)

    def p(w):
        return (c[w] + alpha if w is None or w in kept else (sum(rare) + alpha) / (len(rare) + 1)) / mass

    pairs, states = Counter(), Counter()
    for x in train:
        state = "START"
        for w in tokens(x):
            pairs[state, w] += 1
            states[state] += 1
            state = w
    out = []
    for x in texts:
        base = s = 0.0
        state, known = "START", 0
        for w in tokens(x):
            known += c[w] > 0
            base += math.log10((c[w] + alpha) / (n + alpha * (v + 1)))
            k = states[state] ** 0.95
            s += math.log10((pairs[state, w] + k * p(w)) / (states[state] + k) if states[state] else p(w))
            state = w
        out.append((len(tokens(x)), known, n, base, s))
    return out


def same_scores(got, rows, want):
    a = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 3), r["base_score"], r["score"]) for r in got)
    b = sorted((str(r[0]), *w[:3], round(w[3], 3), *w[3:]) for r, w in zip(rows, want, strict=True))
    for x, y in zip(a, b, strict=True):
        assert x[:4] == y[:4] and x[5] == pytest.approx(y[5], rel=1e-9, abs=1e-6) and x[6] == pytest.approx(y[6], rel=1e-6, abs=1e-5)


@pytest.mark.parametrize("frequent,top,size", [(1 << 18, 1024, 1 << 20), (8, 3, 1 << 20), (1 << 18, 0, 300), (0, 0, 1 << 20), (12, 4, 64)])
def test_lm_equals_plain_model(docs, doc_rows, monkeypatch, frequent, top, size):
    """With all bigrams by broadcast, none, or some; texts whole or cut into many slices."""
    for name, value in (("FREQUENT", frequent), ("TOP", top), ("SLICE", size), ("HELD", 500)):
        monkeypatch.setattr(lm, name, value)
    learn = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(False))
    got = lm.score(docs, learn, {"doc_id": F.col("doc_id")}).collect()
    train = [r[1] for r in doc_rows if r[0] is not None and r[0] % 3 != 0]
    same_scores(got, doc_rows, plain_lm(train, [r[1] for r in doc_rows], frequent))


@pytest.mark.parametrize("sent,top,size", [(0, 0, 1 << 20), (8, 3, 1 << 20), (12, 4, 64), (2, 1024, 300)])
def test_lm_scores_do_not_depend_on_what_is_sent(docs, doc_rows, monkeypatch, sent, top, size):
    """Words that are not broadcast keep their own counts, also next to each other."""
    for name, value in (("SENT", sent), ("TOP", top), ("SLICE", size), ("HELD", 500), ("PIECE", 3)):
        monkeypatch.setattr(lm, name, value)
    learn = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(False))
    got = lm.score(docs, learn, {"doc_id": F.col("doc_id")}).collect()
    train = [r[1] for r in doc_rows if r[0] is not None and r[0] % 3 != 0]
    same_scores(got, doc_rows, plain_lm(train, [r[1] for r in doc_rows]))


def test_lm_has_no_cap_on_words(spark):
    """280,000 words, most of them once: seen in training or not, they don't have equal shares."""
    r = random.Random(4)
    order = [f"w{i}" for i in range(280_000) for _ in range(2 if i % 3 == 0 else 1)]
    r.shuffle(order)
    rows = [(i, " ".join(order[k:k + 500])) for i, k in enumerate(range(0, len(order), 500))]
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") % 4 != 0, {"doc_id": F.col("doc_id")}).collect()
    same_scores(got, rows, plain_lm([t for i, t in rows if i % 4], [t for _, t in rows]))


def test_lm_query_has_no_cap_on_states(spark, tmp_path):
    r = random.Random(8)
    order = [f"w{i}" for i in range(3000)]  # each word has one follower
    rows = [(i, " ".join(order[k:k + 40]), "en", "s", 0) for i, k in enumerate(r.randrange(2960) for _ in range(900))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = queries.op9_lm(spark, str(tmp_path)).collect()
    held = {x["doc_id"]: x["held_out"] for x in got}
    same_scores(got, rows, plain_lm([t for i, t, *_ in rows if not held[i]], [t for _, t, *_ in rows]))


def test_lm_without_training_or_documents(docs, no_docs):
    got = lm.score(docs, F.lit(False), {"doc_id": F.col("doc_id")}).collect()
    assert len(got) == docs.count() and {r["train_tokens"] for r in got} == {0}
    assert all(r["n_known"] == 0 and r["base_score"] == pytest.approx(0, abs=1e-6) for r in got)
    assert lm.score(no_docs, F.lit(True), {"doc_id": F.col("doc_id")}).collect() == []


def test_lm_chances_sum_to_one(spark):
    """Over a closed vocabulary and one word that was never seen, after every state."""
    train = ["a b a c", "b b c", "a"]
    words = ["a", "b", "c", "never"]
    rows = [(i, t) for i, t in enumerate(train)] + [(100 + i, w) for i, w in enumerate(words)]
    rows += [(200 + 10 * i + j, f"{s} {w}") for i, s in enumerate(words) for j, w in enumerate(words)] + [(300, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in lm.score(df, F.col("doc_id") < 100, {"doc_id": F.col("doc_id")}).collect()}
    # score(s w) - score(s) = step(w | s) + end(w) - end(s); the ends' steps follow from the one-word texts
    want = dict(zip([r[0] for r in rows], [w[4] for w in plain_lm(train, [r[1] for r in rows])]))
    assert got == pytest.approx(want, abs=1e-6)
    c = Counter(t for x in train for t in tokens(x))
    kept = [w.encode() for w in words]
    p = [(c[w] + 0.1) / (sum(c.values()) + 0.1 * (len(kept) + 2)) for w in [*kept, None]]
    rest = 0.1 / (sum(c.values()) + 0.1 * (len(kept) + 2))
    assert sum(p) + rest == pytest.approx(1)


def test_lm_words_are_split_as_bytes_split():
    r = random.Random(3)
    texts = [bytes(r.choice(b"aB \t\n\x0b\x0c\r.\xc3\xa9") for _ in range(r.randrange(60))) for _ in range(150)] + [b"", b" ", b"x" * 9000]
    table = {}
    for x in lm.slices(pa.array(texts, pa.binary())):
        start = [*np.flatnonzero(x.s == lm.START), len(x.w)]
        for t, a, b in zip(texts, start, start[1:]):
            ws = t.lower().split()
            assert b - a == len(ws) + 1 and x.w[b - 1] == lm.END and list(x.s[a + 1:b]) == list(x.w[a:b - 1])
            for w, h in zip(ws, x.w[a:b - 1]):
                assert table.setdefault(w, h) == h
    assert len(set(table.values())) == len(table) > 100


def test_lm_beats_the_base_on_held_out_text(spark):
    got = queries.op9_lm(spark, "/root/testdata/sf0.1").filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.85 * got[1]


# -- mixing ----------------------------------------------------------------------------------------

def plain_schedule(shares):
    q, c, out = sum(shares), [0] * len(shares), []
    for t in range(q):
        ready = [(-(-(c[s] + 1) * q // a), s) for s, a in enumerate(shares) if c[s] < a and c[s] * q // a <= t]
        _, s = min(ready)
        out.append(s)
        c[s] += 1
    return out


@pytest.mark.parametrize("shares", [[1], [3, 1], [50, 25, 13, 7, 5], [97, 1, 1, 1], [1] * 20, [40] + [3] * 20])
def test_schedule_is_pfair(spark, shares):
    q = sum(shares)
    df = spark.createDataFrame([(0, i, a) for i, a in enumerate(shares)], "g int, s long, share int")
    order = [r["s"] for r in mixing.schedule(df, q).orderBy("slot").collect()]
    assert order == plain_schedule(shares)
    count = [0] * len(shares)
    for t, s in enumerate(order, 1):
        count[s] += 1
        assert all(abs(count[x] - shares[x] * t / q) < 1 for x in range(len(shares)))


@pytest.mark.parametrize("until", ["all", "first"])
def test_mix(crowded, doc_rows, until, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    weights = {"hot": 5.0, "s1": 3.0, "s0": 1.0, "s2": 1.0, "s3": 1.0, "s4": 1.0, None: 0.5}
    got = mixing.mix(crowded, weights=weights, frame=40, block_rows=4, until=until)
    assert got.columns[:len(crowded.columns)] == crowded.columns
    rows = got.collect()
    names = dict(zip(("slot", "epoch", "block", "release", "deadline", "place"), got.columns[-6:]))
    by_slot = defaultdict(set)
    for r in rows:
        by_slot[r[names["slot"]]].add(r["source"])
        assert r[names["release"]] <= r[names["slot"]] < r[names["deadline"]]
    assert all(len(s) == 1 for s in by_slot.values()) and sorted(by_slot) == list(range(len(by_slot)))
    order = [next(iter(by_slot[t])) for t in range(len(by_slot))]
    size = Counter(r[3] for r in doc_rows)
    if until == "all":
        assert {str(r["doc_id"]) for r in rows} == {str(r[0]) for r in doc_rows}
        first = [r for r in rows if r[names["epoch"]] == 0]
        assert Counter(str(r["doc_id"]) for r in first) == Counter(str(r[0]) for r in doc_rows)
    else:
        assert max(Counter(str(r["doc_id"]) for r in rows).values()) <= 2  # the repeated row
    # shares by largest remainder, in name order
    srcs = sorted(size, key=lambda s: (s is not None, s or ""))
    w = [weights[s] for s in srcs]
    due = [x / sum(w) * (40 - len(w)) for x in w]
    share = [1 + int(d) for d in due]
    for k in sorted(range(len(w)), key=lambda k: (-(due[k] - int(due[k])), k))[:40 - sum(share)]:
        share[k] += 1
    frame = [srcs[s] for s in plain_schedule(share)]
    assert order == [frame[t % 40] for t in range(len(order))]


@pytest.mark.parametrize("until", ["all", "first"])
def test_row_shares_are_the_target_weights(spark, until):
    """Sources whose sizes are no multiples of the block: every prefix of whole slots has the targets' rows."""
    sizes, want = {"a": 4000, "b": 320, "c": 17}, {"a": 0.5, "b": 0.25, "c": 0.25}
    rows = [(f"{s}{i}", s) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id string, source string")
    got = mixing.mix(df, weights=want, until=until).select("doc_id", "source", "__slot", "__place", "__epoch").collect()
    by_slot = defaultdict(list)
    for r in got:
        by_slot[r["__slot"]].append(r)
    assert all(sorted(x["__place"] for x in v) == list(range(16)) for v in by_slot.values())
    count, slots = Counter(), sorted(by_slot)
    assert slots == list(range(len(slots)))
    for t in slots:
        count.update(x["source"] for x in by_slot[t])
        for s, w in want.items():
            assert abs(count[s] - w * 16 * (t + 1)) <= 16 * 1.01  # a block, and the shares' rounding to the frame
    times = Counter(r["doc_id"] for r in got)
    if until == "all":
        assert set(times) == {r[0] for r in rows}
        for s in sizes:  # passes are even: no row of a source is used twice more often than another, but for the last pass
            own = [times[x] for x, y in rows if y == s]
            assert max(own) - min(own) <= 1
    else:
        assert set(times.values()) == {1}


@pytest.mark.parametrize("sources,frame", [(90, 40), (700, 24)])
def test_many_sources_are_mixed_by_groups(spark, sources, frame):
    """Two levels, and three."""
    r = random.Random(1)
    rows = [(i, f"s{r.randrange(sources):04d}") for i in range(sources * 6)] + [(10 ** 6 + i, "hot") for i in range(sources * 3)]
    df = spark.createDataFrame(rows, "doc_id long, source string").repartition(4)
    got = mixing.mix(df, frame=frame, block_rows=2).select("doc_id", "source", "__slot", "__place").collect()
    assert {x["doc_id"] for x in got} == {x[0] for x in rows}
    by_slot = defaultdict(list)
    for x in got:
        by_slot[x["__slot"]].append(x)
    assert sorted(by_slot) == list(range(len(by_slot)))
    assert all(len({x["source"] for x in v}) == 1 and sorted(x["__place"] for x in v) == [0, 1] for v in by_slot.values())


def test_mix_edges(no_docs):
    assert mixing.mix(no_docs).collect() == []


# -- sharding --------------------------------------------------------------------------------------

def least_moved(supply, capacity):
    return sum(max(0, n - capacity.get(o, 0)) for o, n in supply.items() if o != sharding.UNPLACED)


@pytest.mark.parametrize("seed", range(6))
def test_transfers_move_least(seed):
    r = random.Random(seed)
    supply = {o: r.randrange(1, 1000) for o in r.sample(range(-1, 30), 12)}
    capacity = sharding.even_capacities(sum(supply.values()) + r.choice([0, 50]), r.randrange(1, 25))
    flow = sharding.plan_transfers(supply, capacity)
    for o in supply:
        assert sum(v for (a, _), v in flow.items() if a == o) == supply[o]
    for s in capacity:
        assert sum(v for (_, b), v in flow.items() if b == s) <= capacity[s]
    assert sum(v for (a, b), v in flow.items() if a not in (b, sharding.UNPLACED)) == least_moved(supply, capacity)


def test_min_cost_flow_takes_the_cheap_way():
    arcs = [("s", "a", 4, 1), ("s", "b", 2, 5), ("a", "b", 2, 1), ("a", "t", 3, 9), ("b", "t", 3, 1)]
    flow = sharding.min_cost_flow(arcs, "s", "t")
    assert sum(f for f, a in zip(flow, arcs) if a[1] == "t") == 6
    best = min(sum(x * a[3] for x, a in zip(f, arcs)) for f in itertools.product(*(range(a[2] + 1) for a in arcs))
               if f[0] == f[2] + f[3] and f[1] + f[2] == f[4] and f[3] + f[4] == 6)
    assert sum(x * a[3] for x, a in zip(flow, arcs)) == best


def test_reshard(crowded, doc_rows, no_docs, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 8)
    rows = [r for r in doc_rows if r[0] != 9006]
    df = crowded.filter("doc_id is null or doc_id <> 9006")
    old = F.when(F.col("source") == "hot", 0).when(F.col("source") == "s1", 1).when(F.col("source") == "s2", 7)
    got = sharding.reshard(df, old, 5).collect()
    want = Counter((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert Counter((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(sizes) == set(range(5)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    biggest = max(r["size"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 4 * biggest
    moved = sum(r["size"] for r in got if r["moved"] and r["old_shard"] != sharding.UNPLACED)
    supply = Counter()
    for r in got:
        supply[r["old_shard"]] += r["size"]
    assert abs(moved - least_moved(supply, sharding.even_capacities(sum(supply.values()), 5))) <= 8 * biggest
    assert sharding.reshard(no_docs, F.lit(0), 5).collect() == []


def test_rewrite_touches_affected_shards_only(spark, tmp_path):
    path = str(tmp_path / "shards")
    rows = [(i, "x" * 50, i % 3 if i < 90 else 0) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    df.write.partitionBy("shard").parquet(path)
    here = spark.read.parquet(path)
    plan = sharding.reshard(here, F.col("shard"), 3, capacities={0: 31 * 51, 1: 30 * 51, 2: 59 * 51})
    before = {p.name for p in (tmp_path / "shards" / "shard=1").iterdir()}
    from farebox.llm.common import materialize
    body = materialize(here, "body")
    assert sharding.rewrite_affected(body, materialize(plan, "plan"), path, replaces=("shard",)) == [0, 2]
    assert {p.name for p in (tmp_path / "shards" / "shard=1").iterdir()} == before
    spark.catalog.refreshByPath(path)
    assert {r["shard"]: r["count"] for r in spark.read.parquet(path).groupBy("shard").count().collect()} == {0: 31, 1: 30, 2: 59}


ODD_ROWS = [(None, None, "a", "b"), (None, None, None, "b"), (None, "t", None, "a"), (None, "t", "a", None), (7, "t", None, "a")]


@pytest.mark.parametrize("bucket_rows", [1024, 8])
def test_rewrite_keeps_every_row(spark, tmp_path, monkeypatch, bucket_rows):
    """Null ids, repeated rows (one of them very often), rows that differ in where the null is, and fewer shards."""
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(sharding, "RANGE_ROWS", bucket_rows)
    from farebox.llm.common import materialize

    path = str(tmp_path / "shards")
    rows = [(i % 50, f"text {i % 50}", "en", "s") for i in range(150)] + ODD_ROWS * 4 + [(9, "hot", "en", "s")] * 200
    rows = [(*r, k % 16 if k % 23 else None) for k, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard int")
    df.repartition(3).write.partitionBy("shard").parquet(path)
    body = materialize(spark.read.parquet(path), "body")
    plan = materialize(sharding.reshard(body, F.col("shard"), 8), "plan")
    assert sharding.rewrite_affected(body, plan, path, replaces=("shard",)) == list(range(16))
    spark.catalog.refreshByPath(path)
    got = spark.read.parquet(path).collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter(r[:4] for r in rows)
    assert {r["shard"] for r in got} == set(range(8)) and not list((tmp_path / "shards").glob("shard=_*"))
    assert sorted((r["shard"], r["slot"], r["doc_id"] or -1) for r in got) == sorted(
        (r["shard"], r["slot"], r["doc_id"] or -1) for r in plan.collect())


def test_groups_of_equal_texts_stay_together(spark, monkeypatch):
    """Copies that lie in many old shards meet in one new shard, but for groups cut at the end of a run."""
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 32)
    r = random.Random(6)
    texts = [f"{i} " + "x" * r.randrange(20, 400) for i in range(500)]
    rows = [(i, t, r.randrange(8)) for i, t in enumerate(texts)]
    for k in range(60):  # groups of 2 to 6 copies, two of 60, one larger than a shard
        rows += [(1000 + k * 10 + j, texts[k], r.randrange(8)) for j in range(r.randrange(1, 6))]
    rows += [(5000 + j, texts[100 + j % 2], r.randrange(8)) for j in range(120)]
    rows += [(9000 + j, "y" * 100, r.randrange(8)) for j in range(600)]
    rows += [(20_000 + j, None, r.randrange(8)) for j in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, o int").repartition(5)
    got = sharding.reshard(df, F.col("o"), 8).collect()
    text = {i: t for i, t, _ in rows}
    shards, sizes = defaultdict(set), Counter()
    for x in got:
        shards[text[x["doc_id"]]].add(x["shard"])
        sizes[x["shard"]] += x["size"]
    mean = sum(sizes.values()) / 8
    assert max(abs(v - mean) for v in sizes.values()) < 3 * mean * sharding.WHOLE + 400
    small = [t for t in shards if sum(x == t for x in text.values()) * (len(t or "") + 1) <= mean * sharding.WHOLE]
    assert len(small) > 400 and all(len(shards[t]) == 1 for t in small)
    assert all(len(shards[t]) <= 2 for t in shards if t != "y" * 100) and len(shards["y" * 100]) > 2


def test_slots_follow_a_given_order(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 90).alias("text"))
    got = sharding.reshard(df, F.col("doc_id") % 3, 4, order=(F.floor((499 - F.col("doc_id")) / 64), 499 - F.col("doc_id"))).collect()
    for shard in range(4):
        own = sorted((r["slot"], r["doc_id"]) for r in got if r["shard"] == shard)
        assert [s for s, _ in own] == list(range(len(own))) and [d for _, d in own] == sorted((d for _, d in own), reverse=True)


def test_clashing_columns_are_written_too(spark, tmp_path):
    rows = [(i, f"t{i % 40}", 100 + i, f"s{i}") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int, Slot string")
    plan = sharding.reshard(df, F.col("doc_id") % 2, 3)
    path = str(tmp_path / "shards")
    sharding.write_shards(df, plan, path, [0, 1, 2])
    shard, slot = sharding.layout_names(df)
    got = spark.read.parquet(path)
    assert {shard, slot}.isdisjoint(df.columns) and Counter(tuple(r) for r in got.select(*df.columns).collect()) == Counter(rows)
    assert Counter((r[shard], r[slot], r["doc_id"]) for r in got.collect()) == Counter(
        (r["shard"], r["slot"], r["doc_id"]) for r in plan.collect())


def test_sharding_query_writes_its_shards(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    plan = queries.placement(docs).collect()
    got = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter(tuple(r) for r in got.select(*docs.columns).collect()) == Counter(tuple(r) for r in docs.collect())
    assert sorted((r["shard"], r["slot"], str(r["doc_id"])) for r in got.collect()) == sorted(
        (r["shard"], r["slot"], str(r["doc_id"])) for r in plan)


# -- top-k -----------------------------------------------------------------------------------------

def plain_top(rows, k=20, every=20):
    ints = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, v) in enumerate(ints):
        if q is not None and q % every == 0:
            some = sorted((-sum(x * y for x, y in zip(v, w)), i) for b, (i, w) in enumerate(ints) if b != a and len(w) == len(v) and i is not None)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(some[:k], 1)]
    return Counter(out)


def vectors(n=400, dim=8, seed=4):
    r = random.Random(seed)
    rows = [(i, [r.gauss(0, 1) for _ in range(dim)]) for i in range(n)]
    rows += [(1000 + i, rows[40][1]) for i in range(200)]  # one very common vector
    rows += [(2000, None), (2020, []), (2040, [None] * dim), (2060, [float("nan")] * dim), (2080, [float("inf")] + [0.0] * (dim - 1)),
             (2100, [0.0] * dim), (2120, [1.0, 2.0]), (2140, [3.0, 1.0]), (60, rows[60][1]), (2160, [1.0] * 3)]
    return rows


@pytest.mark.parametrize("sizes", [(512, 32768, 48), (7, 50, 12)])
def test_top_k_equals_all_pairs(spark, monkeypatch, sizes):
    for name, v in zip(("QUERY_ROWS", "DATA_ROWS", "PIVOTS"), sizes):
        monkeypatch.setattr(topk, name, v)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"rid": F.lit(1), "v": F.lit(2)})
    assert Counter(map(tuple, topk.top_k(df.repartition(3)).collect())) == plain_top(rows)
    assert topk.top_k(df.limit(0)).collect() == []


def test_bounds_prune_and_lose_nothing():
    """On clustered data most cells are out of reach; no cell with a true neighbour is."""
    r = np.random.default_rng(0)
    centres = r.normal(0, 100, (12, 4))
    x = np.concatenate([c + r.normal(0, 3, (80, 4)) for c in centres])
    q = x[::7] + 0.25
    pivots = topk.choose_pivots(x, 12)
    to_x, to_q = topk.distances(x, pivots), topk.distances(q, pivots)
    cell, own = to_x.argmin(axis=1), to_q.argmin(axis=1)
    span = [to_x[cell == p, p] for p in range(12)]
    least, most = np.array([d.min() for d in span]), np.array([d.max() for d in span])
    apart = topk.distances(q, x)
    radius = np.array([to_q[own == p, p].max(initial=0) for p in range(12)])
    known = topk.reaches(pivots, radius, [np.sort(d)[:6] for d in span], 5)
    kth = np.sort(apart, axis=1)[:, 4]
    assert (known[own] >= kth).all()
    for reach in (known[own], kth):
        go = topk.cells_in_reach(to_q, own, reach, topk.distances(pivots, pivots), least, most)
        for i, p in zip(*np.nonzero(~go)):
            assert apart[i, cell == p].min() >= kth[i]
    assert go.mean() < 0.3


# -- pipeline --------------------------------------------------------------------------------------

def test_pipeline_equals_its_parts(spark):
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    kept = [r for r in rows if r[1] is not None and any(c.isalpha() for c in r[1])]
    one = cp.language_id(spark, docs, sf)
    assert one.columns == docs.columns
    got = [tuple(r) for r in one.collect()]
    assert set(got) <= set(kept) and len(got) >= len(kept) - 2
    fps = [plain_fingerprint(r[1]) for r in got]
    classes = plain_components(fps)
    least = {}
    for r, c in zip(got, classes):
        least[c] = min(r, least.get(c, r))
    two = cp.near_dedup(spark, one, sf)
    assert Counter(map(tuple, two.collect())) == Counter(least.values())
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    three = cp.decontaminate(spark, two, sf)
    clean = [r for r in least.values() if not plain_contamination(r[1], items)[1]]
    assert Counter(map(tuple, three.collect())) == Counter(clean)
    four = cp.mix_sources(spark, three, sf)
    assert four.columns == docs.columns and set(map(tuple, four.collect())) == set(clean)
    out = cp.run(spark, sf)
    ids = Counter(r["doc_id"] for r in out.collect())
    assert ids == Counter(r["doc_id"] for r in four.collect())


def test_shards_keep_the_order_of_the_mixture(spark, docs, tmp_path):
    import corpus_pipeline as cp
    from farebox.llm.common import materialize

    written = materialize(cp.mix_sources(spark, docs.repartition(5), ""), "mixture")
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int")
    order = [r["doc_id"] for r in written.select("doc_id", part.alias("p"), F.col("_metadata.row_index").alias("i")).orderBy("p", "i").collect()]
    mixed = mixing.mix(docs)
    want = mixed.orderBy(mixed.columns[-6], mixed.columns[-1]).select("source").collect()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    assert [source[i] for i in order] == [r["source"] for r in want]
    rank = defaultdict(list)
    for k, i in enumerate(order):
        rank[i].append(k)
    got = cp.shard(spark, written, "").collect()
    assert len(got) == len(order)
    for s in {r["shard"] for r in got}:
        own = [r["doc_id"] for r in sorted((r for r in got if r["shard"] == s), key=lambda r: r["slot"])]
        at = -1  # the rows of a shard can be found in the mixture one after another
        for i in own:
            at = min(k for k in rank[i] if k > at)


def test_pipeline_on_crowded_columns(spark, crowded):
    import corpus_pipeline as cp

    docs = crowded
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == crowded.columns
    assert cp.shard(spark, docs, "/root/testdata/sf0.001").count() == docs.count()


def test_pipeline_on_an_empty_table(spark, no_docs):
    import corpus_pipeline as cp

    docs = no_docs
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.collect() == []


def test_items_digest_is_of_sorted_strings(spark):
    got = queries.op3_decontamination(spark, "/root/testdata/sf0.001").filter("contaminated").collect()
    assert got and all(r["n_hit"] > 0 and r["n_items"] > 0 for r in got)
    assert hashlib.sha256(b"").hexdigest() not in {r["items_sha256"] for r in got}


def test_components_of_stars_need_no_round(spark, monkeypatch):
    from farebox.llm import simhash

    rounds, star = [], simhash._star
    monkeypatch.setattr(simhash, "_star", lambda edges, small: rounds.append(small) or star(edges, small))

    def roots(*edges):
        rounds.clear()
        return {r.u: r.root for r in simhash.components(spark.createDataFrame(list(edges), "u long, v long")).collect()}

    assert roots((5, 1), (1, 6), (9, 7), (5, 1)) == {5: 1, 6: 1, 9: 7} and not rounds
    assert roots((3, 2), (2, 1), (9, 3), (8, 9)) == {2: 1, 3: 1, 8: 1, 9: 1} and rounds
    assert roots((5, 1), (5, 2)) == {2: 1, 5: 1} and rounds

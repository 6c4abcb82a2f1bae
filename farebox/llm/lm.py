"""Language-model scoring with a weighted backoff automaton.

Tokens: A-Z lower-cased words split at ASCII white space, then one end token. Every word
of the training text is a state, as is the start; every training bigram is an arc. The
bigrams are smoothed with a Dirichlet prior that grows with the state's count,

    P(w | s) = (c(s, w) + K(s) * P(w)) / (c(s) + K(s)),   K(s) = c(s) ** POWER,

so an arc weighs log10 P(w | s), and without an arc the failure arc leads to the root at
log10(K(s) / (c(s) + K(s))), where every word has the arc log10 P(w). A state not seen in
training is the root. P(w) is the add-``SMOOTHING`` share of the training tokens of each word
of the corpus, of the end and of one word that does not occur. One left-to-right walk carries
the state and adds up the weights. Nothing caps words, states or arcs.

Work goes in slices of about ``SLICE`` bytes of text (a long text is cut at white space and
the walk carried on, so only a single word must fit in a task). A task weighs every step as
far as it can: counts of about the ``SENT`` most frequent words, and of the bigrams among the
``TOP`` most frequent words, are broadcast (their number is fixed; which words are sent changes
no result). Each other distinct (document, bigram) goes once, in packed arrays, to a bucket: to
that of its bigram if both words are sent, else to that of its last word, or to that of its
state if only the state is not sent. There the training occurrences are the counts that all
occurrences of the same word and bigram are weighed with, and a sum for each document goes
back. Only a bigram of two words that are not sent travels on, with the count and the share of
its last word, to the bucket that has counted its state. So no table of bigrams is written or
joined. A bucket gets no large share of the input: bigrams with many occurrences are among the
top words, and words that are bucketed whole are rare in the whole input, held-out rows
included. Buckets hold the bigrams of about ``BUCKET`` bytes.

Words and bigrams are told apart by 64-bit hashes. Null text is empty: the end token alone.
With nothing to learn from, N = V = 0 and all words are equally likely. Rows whose ``learn``
is null are not learned from. Repeated rows each give a row; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import materialize

SMOOTHING, POWER = 0.1, 0.95
TOP, SENT = 1024, 1 << 18
#: A number limits the vocabulary: only so many words have a share of their own, all others an even one. None: no limit.
FREQUENT = None
SLICE, BUCKET = 1 << 20, 1 << 24
#: At least so many buckets.
LEAST_BUCKETS = 64
#: Bigrams or counts in a row that travels on: Spark reads thousands of rows at once.
PIECE = 128
#: A task hands on its word counts whenever it holds so many.
HELD = 1 << 20
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint64)
SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
#: Stand for the end and the start of a text.
END, START = np.int64(-1), np.int64(-2)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit permutation that spreads all bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


#: A factor for each place in a word; places beyond are computed when they occur.
FACTORS = mixed(np.arange(1, 4097, dtype=np.uint64)) | np.uint64(1)


def word_hashes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of ``data``; no word crosses a place of ``edges``."""
    inside = ~SPACE[data]
    before = np.concatenate([[False], inside[:-1]])[:len(inside)]
    before[edges[edges < len(inside)]] = False
    begins = inside & ~before
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, np.int64), at
    starts = np.flatnonzero(begins)
    place = at - starts[np.cumsum(begins)[at] - 1]
    if place.max() < len(FACTORS):
        factor = FACTORS[place]
    else:
        factor = mixed(place.astype(np.uint64) + np.uint64(1)) | np.uint64(1)
    h = np.add.reduceat((LOWER[data[at]] + np.uint64(1)) * factor, np.flatnonzero(place == 0))
    return mixed(h).view(np.int64), starts


def pair_hash(s: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mixed(mixed(s.view(np.uint64)) + w.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


@dataclass
class Slice:
    """Steps of a walk over some texts: states and words, and for each step the place of its text among ``rows``."""

    rows: np.ndarray
    s: np.ndarray
    w: np.ndarray
    text: np.ndarray


def slices(column: pa.Array) -> Iterator[Slice]:
    """The steps of a column of texts, in order, about ``SLICE`` bytes at a time."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    pieces, size, last = [], 0, END
    for i in range(len(column)):
        a, stop = int(offsets[i]), int(offsets[i + 1])
        while True:
            b = min(stop, a + SLICE)
            while b < stop and not SPACE[data[b]]:
                gap = np.flatnonzero(SPACE[data[b:min(stop, b + 4096)]])
                b = b + int(gap[0]) if len(gap) else min(stop, b + 4096)
            pieces.append((i, a, b, b == stop))
            size += b - a + 16
            if size >= SLICE:
                yield (made := _slice(data, pieces, last))
                last = made.w[-1] if len(made.w) else last
                pieces, size = [], 0
            if b == stop:
                break
            a = b
    if pieces:
        yield _slice(data, pieces, last)


def _slice(data: np.ndarray, pieces: list, last: np.int64) -> Slice:
    first = pieces[0][1]
    edges = np.array([p[1] for p in pieces]) - first
    h, starts = word_hashes(data[first:pieces[-1][2]], edges)
    rows, place = np.unique([p[0] for p in pieces], return_inverse=True)
    own = np.bincount(np.searchsorted(edges, starts, "right") - 1, minlength=len(pieces))
    ends = np.array([p[3] for p in pieces])
    n = own + ends
    w = np.full(int(n.sum()), END)
    is_end = np.zeros(len(w), bool)
    is_end[(np.cumsum(n) - 1)[ends]] = True
    w[~is_end] = h
    s = np.concatenate([[last], w[:-1]])[:len(w)]
    return Slice(rows, np.where(s == END, START, s), w, np.repeat(place, n))


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, sorted, with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *(np.add.reduceat(v[order], first) if len(keys) else v for v in values)


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def packed(x: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of an array's parts between ``cuts``."""
    offsets = pa.py_buffer((cuts * x.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(x))])


def unpacked(column: pa.ChunkedArray, kind) -> np.ndarray:
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column if x.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _texts(docs: DataFrame, text_col: str, learn: Column, keys: dict[str, Column]) -> DataFrame:
    return docs.select(F.col(f"`{text_col}`").cast("binary").alias("__text"), F.coalesce(learn, F.lit(False)).alias("__learn"),
                       F.monotonically_increasing_id().alias("__rid"), *[x.alias(k) for k, x in keys.items()])


def count_words(texts: DataFrame, buckets: int) -> DataFrame:
    """(h, c, a): count of every distinct token in the training rows and in all rows, ends included, as a written table."""

    def count(batches):
        held = [np.zeros(0, np.int64)] * 3

        def out():
            h, c, a = held
            b = bucket_of(h, buckets)
            order = np.argsort(b, kind="stable")
            some, first = np.unique(b[order], return_index=True)
            cuts = np.append(first, len(h))
            return pa.RecordBatch.from_arrays([pa.array(some), *(packed(x[order], cuts) for x in (h, c, a))], ["bucket", "h", "c", "a"])

        for b in batches:
            learn = b.column(1).to_numpy(zero_copy_only=False)
            for x in slices(b.column(0)):
                own = learn[x.rows][x.text].astype(np.int64)
                new = summed(x.w, own, np.ones(len(own), np.int64))
                held = list(summed(*(np.concatenate(p) for p in zip(held, new))))
                if len(held[0]) >= HELD:
                    yield out()
                    held = [np.zeros(0, np.int64)] * 3
        if len(held[0]):
            yield out()

    def add(table):
        h, c, a = summed(*(unpacked(table[x], np.int64) for x in "hca"))
        return pa.table({"h": h, "c": c, "a": a})

    return materialize(texts.select("__text", "__learn").mapInArrow(count, "bucket int, h binary, c binary, a binary").groupBy(
        "bucket").applyInArrow(add, "h bigint, c bigint, a bigint"), "word-counts")


def least_count(counts: DataFrame, most: int) -> int | None:
    """Count in all rows that the most frequent words have at least, at most ``most`` of them, ties in or out together.

    It comes from a histogram over quarter powers of two, a few hundred rows.
    """
    level = F.floor(4 * F.log2(F.col("a").cast("double"))).cast("int")
    room, least = most, None
    for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.min("a").alias("a")).orderBy(F.desc("level")).collect():
        if r["n"] > room:
            break
        room, least = room - r["n"], r["a"]
    return least


def most_frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes (sorted), counts and counts in all rows of the most frequent words, for the broadcast."""
    least = least_count(counts, most)
    if least is None:
        return (np.zeros(0, np.int64),) * 3
    got = counts.filter(F.col("a") >= least).toArrow()
    h, c, a = (got[x].to_numpy() for x in "hca")
    order = np.argsort(h)
    return h[order], c[order], a[order]


@dataclass
class Shares:
    """P(w) from a word's counts: ``mass`` is that of all tokens, ``even`` that of a word with fewer than ``least`` in all rows."""

    mass: float
    even: float
    least: float

    def of(self, c: np.ndarray, a: np.ndarray) -> np.ndarray:
        return np.where(a >= self.least, c + SMOOTHING, self.even) / self.mass


def shares(counts: DataFrame, n: int) -> Shares:
    """Of the words' counts and the number of training tokens."""
    least = 1 if FREQUENT is None else least_count(counts, FREQUENT)
    least = np.inf if least is None else least
    own = F.col("a") >= F.lit(float(least))
    kept, rare, kinds = counts.agg(F.count_if(own), F.coalesce(F.sum(F.when(~own, F.col("c"))), F.lit(0)),
                                   F.count_if(~own & (F.col("c") > 0))).first()
    return Shares(n + SMOOTHING * (kept + 2), (rare + SMOOTHING) / (kinds + 1), least)


class Model:
    """What every task knows. Codes: places among the sent words, then the end, then the start; -1 is any other word."""

    def __init__(self, h: np.ndarray, c: np.ndarray, a: np.ndarray, ends: int, shares: Shares):
        self.h = h
        self.shares = shares
        f = len(h)
        self.end, self.start = f, f + 1
        self.c = np.append(c, [ends, ends])  # a text has one start, as it has one end
        self.p = np.append(shares.of(c, a), np.full(2, (ends + SMOOTHING) / shares.mass))
        top = np.lexsort((h, -a))[:TOP]
        self.label = np.full(f + 3, -1)  # the last is any other word's
        self.label[top] = np.arange(len(top))
        self.label[self.end] = self.label[self.start] = len(top)  # the end as a word, the start as a state
        self.labels = len(top) + 1
        self.pairs = np.zeros(self.labels ** 2)

    def codes(self, x: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.h, x)
        found = np.full(len(x), -1)
        if len(self.h):
            at = np.minimum(at, len(self.h) - 1)
            found = np.where(self.h[at] == x, at, -1)
        return np.where(x == END, self.end, np.where(x == START, self.start, found))

    def pair(self, s: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Place of a bigram among those of the top words, or -1."""
        s, w = self.label[s], self.label[w]
        return np.where((s >= 0) & (w >= 0), s * self.labels + w, -1)


def prior(count: np.ndarray) -> np.ndarray:
    return np.power(count, POWER, dtype=float)


def count_top(texts: DataFrame, sent, labels: int) -> np.ndarray:
    """Training counts of the bigrams among the top words."""

    def count(batches):
        m = sent.value
        total = np.zeros(labels ** 2, np.int64)
        for b in batches:
            learn = b.column(1).to_numpy(zero_copy_only=False)
            for x in slices(b.column(0)):
                k = m.pair(m.codes(x.s), m.codes(x.w))
                total += np.bincount(k[learn[x.rows][x.text] & (k >= 0)], minlength=len(total))
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], ["k", "c"])

    got = texts.select("__text", "__learn").mapInArrow(count, "k bigint, c bigint").groupBy("k").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros(labels ** 2)  # (TOP + 1) ** 2 at most
    out[got["k"].to_numpy()] = got["c"].to_numpy()
    return out


#: Packed columns: bigrams of sent words (hash, prior share, text, times), then all others: hash of the word or state whose
#: bucket it is, the other one (code, or hash if it is not sent either), kind, text, times. Times are negative where not learned from.
OF_SENT = {"fp": np.int64, "fx": np.float32, "fd": np.int32, "ft": np.int32}
OF_RARE = {"rk": np.int64, "ro": np.int64, "rg": np.int8, "rd": np.int32, "rt": np.int32}
PARTS = {**OF_SENT, **OF_RARE}
RARE_WORD, RARE_STATE, BOTH_RARE = 0, 1, 2
#: Bigrams of kind ``BOTH_RARE`` on their way to the state's bucket: state, training count, share of the word, slice, text, times.
ONWARD = {"os": np.int64, "oc": np.int64, "op": np.float32, "on": np.int64, "od": np.int32, "ot": np.int32}
#: Hashes and training counts of the words of a bucket that are states of such bigrams.
COUNTED = {"ch": np.int64, "cc": np.int64}
SUMS = {"tokens": "bigint", "known": "bigint", "base": "double", "walk": "double"}
BACK = {"bd": np.int32, "bk": np.int64, "bb": np.float64, "bw": np.float64}


def _distinct(pair: np.ndarray, text: np.ndarray, sign: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the distinct (text, bigram)s, by text, and how often each occurs, negative for texts not learned from."""
    order = np.lexsort((pair, text))
    p, t = pair[order], text[order]
    first = np.flatnonzero(np.append(True, (p[1:] != p[:-1]) | (t[1:] != t[:-1]))) if len(p) else np.zeros(0, np.int64)
    at = order[first]
    return at, np.diff(np.append(first, len(p))) * sign[text[at]]


def walk_slice(m: Model, x: Slice, learn: np.ndarray, buckets: int):
    """Sums of each text of a slice, as far as known, and the bigrams left, packed by bucket."""
    texts = len(x.rows)
    s, w = m.codes(x.s), m.codes(x.w)
    known_w, sent = w >= 0, (s >= 0) & (w >= 0)
    p, c = np.where(known_w, m.p[w], 1.0), np.where(sent, m.c[s], 0).astype(float)
    k = prior(np.maximum(c, 1))
    step = np.where(sent, np.log10(k * p / (c + k)), 0.0)
    at = m.pair(s, w)
    step += np.where((at >= 0) & (c > 0), np.log10(1 + m.pairs[at] / (k * p)), 0.0)
    cw = np.where(known_w, m.c[w], 0)
    sums = [np.bincount(x.text, minlength=texts), np.bincount(x.text, cw > 0, texts).astype(np.int64),
            np.bincount(x.text, np.where(known_w, np.log10(cw + SMOOTHING), 0.0), texts), np.bincount(x.text, step, texts)]
    sign = np.where(learn[x.rows], 1, -1)

    out = {}

    def pack(names, bucket, *values):
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for (name, kind), v in zip(names.items(), values):
            out[name] = (v[order].astype(kind), cuts)

    left = np.flatnonzero(sent & (c > 0) & (at < 0))
    pair = pair_hash(x.s[left], x.w[left])
    some, times = _distinct(pair, x.text[left], sign)
    pair, left = pair[some], left[some]
    pack(OF_SENT, bucket_of(pair, buckets), pair, (k * p)[left], x.text[left], times)

    left = np.flatnonzero(~sent)
    some, times = _distinct(pair_hash(x.s[left], x.w[left]), x.text[left], sign)
    left = left[some]
    s, w, hs, hw = s[left], w[left], x.s[left], x.w[left]
    kind = np.where(w >= 0, RARE_STATE, np.where(s >= 0, RARE_WORD, BOTH_RARE))
    key, other = np.where(w >= 0, hs, hw), np.where(w >= 0, w, np.where(s >= 0, s, hs))
    pack(OF_RARE, bucket_of(key, buckets), key, other, kind, x.text[left], times)
    return sums, out


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places of the runs of equal keys, and the run of each row."""
    new = np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0)) if len(keys[0]) else np.zeros(0, bool)
    return np.flatnonzero(new), np.cumsum(new, dtype=np.int32) - 1


def _trained(times: np.ndarray, first: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Of each row, the training occurrences in its run."""
    return np.add.reduceat(np.maximum(times, 0), first, dtype=np.int64)[run] if len(times) else times


def _by_text(part: np.ndarray, text: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    return summed(part.astype(np.int64) << 32 | text, *values)


def weigh_bucket(m: Model, table: pa.Table) -> tuple[tuple[np.ndarray, ...], dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Of the packed bigrams of a bucket: part and text of each (part, text) that occurs, with known, base and walk sums;
    the bigrams that travel on (their slice is a part of the table); the counts that bigrams travel on to."""
    def owner(name):
        return np.repeat(np.arange(len(table), dtype=np.int32), [len(x.as_buffer()) // 4 if x.is_valid else 0 for x in table[name]])

    def column(name, order):
        return unpacked(table[name], PARTS[name])[order]

    pair = unpacked(table["fp"], np.int64)
    order = np.argsort(pair, kind="stable").astype(np.int32)
    times = column("ft", order)
    c = _trained(times, *_runs(pair[order]))
    del pair
    walk = np.abs(times) * np.log10(1 + c / column("fx", order))
    of_sent = _by_text(owner("fd")[order], column("fd", order), walk)
    del order, times, c, walk

    key, other, kind = (unpacked(table[x], PARTS[x]) for x in ("rk", "ro", "rg"))
    order = np.lexsort((other, kind, key)).astype(np.int32)
    key, other, kind, times = key[order], other[order], kind[order], column("rt", order)
    part, text = owner("rd")[order], column("rd", order)
    del order
    first, word = _runs(key)
    pair_c = _trained(times, *_runs(key, kind, other))
    learned, times = np.maximum(times, 0), np.abs(times).astype(np.int64)
    ends = kind != RARE_STATE  # these end in the bucket's word, each occurrence of it once

    def total(x):
        return np.add.reduceat(x, first, dtype=np.int64) if len(x) else x.astype(np.int64)

    c, a = total(np.where(ends, learned, 0)), total(np.where(ends, times, 0))
    known, base = times * (ends & (c[word] > 0)), times * np.where(ends, np.log10(c[word] + SMOOTHING), 0.0)
    p, cs = m.shares.of(c, a)[word], c[word]  # of the step's word, and of its state
    p[~ends], at = m.p[other[~ends]], kind == RARE_WORD
    cs[at] = m.c[other[at]]
    k = prior(np.maximum(cs, 1))
    on = kind == BOTH_RARE
    walk = times * np.where(on, 0.0, np.log10((pair_c + k * p) / (cs + k)))
    of_rare = _by_text(part, text, known, base, walk)

    onward = dict(zip(ONWARD, (other[on], pair_c[on], p[on], part[on], text[on], times[on])))
    counted = (c > 0) & (a > total(np.where(ends, 0, times)))  # other occurrences come before words that are not sent
    zero = np.zeros(len(of_sent[0]))
    keys, known, base, walk = summed(np.append(of_sent[0], of_rare[0]), np.append(zero, of_rare[1]),
                                     np.append(zero, of_rare[2]), np.append(of_sent[1], of_rare[3]))
    back = keys >> 32, (keys & 0xFFFFFFFF).astype(np.int32), known.astype(np.int64), base, walk
    return back, onward, dict(zip(COUNTED, (key[first][counted], c[counted])))


def weigh_onward(table: pa.Table) -> pa.Table:
    """For each slice what its texts gain from the bigrams that came to the bucket of their state."""
    states, c = summed(*(unpacked(table[x], COUNTED[x]) for x in COUNTED))
    s, pair_c, p, number, text, times = (unpacked(table[x], ONWARD[x]) for x in ONWARD)
    cs = np.zeros(len(s), np.int64)
    if len(states):
        at = np.minimum(np.searchsorted(states, s), len(states) - 1)
        cs = np.where(states[at] == s, c[at], 0)
    k = prior(np.maximum(cs, 1))
    walk = times * np.log10((pair_c + k * p) / (cs + k))
    number, part = np.unique(number, return_inverse=True)
    keys, walk = _by_text(part, text, walk)
    cuts = np.searchsorted(keys >> 32, np.arange(len(number) + 1))
    zero = np.zeros(len(keys))
    values = ((keys & 0xFFFFFFFF), zero, zero, walk)
    return pa.table([pa.array(number), *(packed(v.astype(t), cuts) for t, v in zip(BACK.values(), values))], ["__slice", *BACK])


def score(docs: DataFrame, learn: Column, keys: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The key columns, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``learn`` says which rows the model learns from.
    """
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("binary")) + 16), F.lit(0))).first()[0]
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET))
    texts = _texts(docs, text_col, learn, keys)
    counts = count_words(texts, buckets)
    n, v, ends = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0),
                            F.coalesce(F.sum(F.when(F.col("h") == int(END), F.col("c"))), F.lit(0))).first()
    words = counts.filter(F.col("h") != int(END))
    model = Model(*most_frequent(words, SENT), ends, shares(words, n))
    model.pairs = count_top(texts, spark.sparkContext.broadcast(model), model.labels)
    sent = spark.sparkContext.broadcast(model)  # of fixed size: SENT words, (TOP + 1) ** 2 bigrams
    row = texts.drop("__text", "__learn").schema
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in row.fields)
    sums = ", ".join(f"__{k} {t}" for k, t in SUMS.items())

    def scan(batches):
        m = sent.value
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            learn = b.column(1).to_numpy(zero_copy_only=False)
            for x in slices(b.column(0)):
                own, left = walk_slice(m, x, learn, buckets)
                rows, number, home = len(x.rows), (part << 33) + at, (part + at) % buckets
                at += 1
                some = np.flatnonzero(np.diff(left["fp"][1]) + np.diff(left["rk"][1]))
                n = rows + len(some)
                bucket = np.append(np.full(rows, home), some).astype(np.int32)
                columns = [pa.array(bucket), pa.array(np.full(n, number)),
                           pa.concat_arrays([pa.array(np.arange(rows, dtype=np.int32)), pa.nulls(len(some), pa.int32())])]
                columns += [pa.concat_arrays([c.take(pa.array(x.rows)), pa.nulls(len(some), c.type)]) for c in b.columns[2:]]
                columns += [pa.concat_arrays([pa.array(v), pa.nulls(len(some), pa.array(v[:0]).type)]) for v in own]
                columns += [pa.concat_arrays([pa.nulls(rows, pa.binary()), packed(*left[k]).take(pa.array(some))]) for k in PARTS]
                yield pa.RecordBatch.from_arrays(columns, ["__bucket", "__slice", "__text", *b.schema.names[2:],
                                                           *(f"__{k}" for k in SUMS), *PARTS])

    walked = texts.mapInArrow(scan, f"__bucket int, __slice bigint, __text int, {kinds}, {sums}, " + ", ".join(f"{k} binary" for k in PARTS))

    def weigh(table):
        """The rows of texts as they are, for each slice what its texts gain from this bucket, and rows for the buckets ahead."""
        is_text = pc.is_valid(table["__text"])
        bucket, number = table["__bucket"][0].as_py(), table["__slice"].to_numpy()
        (part, text, known, base, walk), onward, counted = weigh_bucket(sent.value, table)
        narrow = table.drop_columns(["__bucket", *PARTS])
        rows, back = narrow.filter(is_text), narrow.filter(pc.invert(is_text)).combine_chunks()
        places = np.flatnonzero(~is_text.to_numpy(zero_copy_only=False) if isinstance(is_text, pa.Array) else ~is_text.to_numpy())
        cuts = np.append(np.searchsorted(part, places), len(part))
        for (name, kind), values in zip(BACK.items(), (text, known, base, walk)):
            back = back.append_column(name, packed(values.astype(kind), cuts))
        onward["on"] = number[onward["on"]]
        ahead = bucket_of(onward["os"], buckets)
        order = np.argsort(ahead, kind="stable")
        first, run = _runs(ahead[order])
        starts = np.flatnonzero((np.arange(len(order)) - first[run]) % PIECE == 0)
        cuts = np.append(starts, len(order))
        ahead = pa.table({"__ahead": ahead[order][starts], **{x: packed(onward[x][order].astype(t), cuts) for x, t in ONWARD.items()}})
        starts = np.arange(0, len(counted["ch"]), PIECE)
        cuts = np.append(starts, len(counted["ch"]))
        counted = pa.table({"__ahead": np.full(len(starts), bucket, np.int32), **{x: packed(counted[x], cuts) for x in COUNTED}})
        return pa.concat_tables([rows, back, ahead, counted], promote_options="default")

    met = materialize(walked.groupBy("__bucket").applyInArrow(
        weigh, f"__slice bigint, __text int, {kinds}, {sums}, "
        + ", ".join(f"{k} binary" for k in BACK) + ", __ahead int, " + ", ".join(f"{k} binary" for k in (*ONWARD, *COUNTED))), "weighed")
    ahead = met.filter("__ahead is not null").select("__ahead", *ONWARD, *COUNTED).groupBy("__ahead").applyInArrow(
        weigh_onward, "__slice bigint, " + ", ".join(f"{k} binary" for k in BACK))
    met = met.filter("__ahead is null").drop("__ahead", *ONWARD, *COUNTED).unionByName(ahead, allowMissingColumns=True)

    def together(table):
        """The texts of a slice with all that its buckets gave."""
        is_text = pc.is_valid(table["__text"])
        rows, back = table.filter(is_text).sort_by("__text"), table.filter(pc.invert(is_text))
        n = len(rows)
        text = unpacked(back["bd"], np.int32)
        for name, column, kind in (("__known", "bk", np.int64), ("__base", "bb", np.float64), ("__walk", "bw", np.float64)):
            total = rows[name].to_numpy() + np.bincount(text, unpacked(back[column], kind), n).astype(kind)
            rows = rows.set_column(rows.schema.get_field_index(name), name, pa.array(total))
        return rows.drop_columns(["__slice", "__text", *BACK])

    whole = met.groupBy("__slice").applyInArrow(together, f"{kinds}, {sums}")
    norm = float(np.log10(n + SMOOTHING * (v + 1)))
    return whole.groupBy("__rid").agg(  # a long text has a row for each slice that holds some of it
        *[F.first(F.col(f"`{k}`")).alias(k) for k in keys], F.sum("__tokens").alias("n_tokens"), F.sum("__known").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.sum("__base") - F.sum("__tokens") * F.lit(norm)).alias("base_score"), F.sum("__walk").alias("score")).drop("__rid")

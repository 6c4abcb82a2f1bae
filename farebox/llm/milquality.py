"""Quality classifier: attention-based multiple-instance learning over a document's passages.

A passage is ``PASSAGE`` consecutive code points (a text's last may be shorter; an empty
or null text has one empty passage). Each is encoded from the frequencies of pairs of
neighbouring character classes and from counts of its words (share of distinct words, of
words that repeat the one before or two before, of the most frequent word, mean length),
then by a learned layer h = tanh(Wx). Gated attention a = exp(w'(tanh(Vh) * sigmoid(Uh))),
normalised over the document, weights the passages; the weighted mean of the h is scored by
a logistic unit. Everything is learned from document labels alone.

Learning takes about ``TRAIN_ROWS`` documents a class, chosen by a hash of the id (all while
there are no more), thinned again by a hash of the text if ids repeat, and each different
text once; documents of more than ``TRAIN_PASSAGES`` passages are not learned from. Labels
other than 0 and 1, null ids, and ids with both labels are not learned from. The sample is
collected to the driver, where the model is fitted. With nothing to learn from every score
is 0.5.

Prediction reads every text whole. A text's passages are encoded in blocks of about ``STEP``
code points and only the attention sums are kept, so a very long text needs no more memory
than its own characters. No shuffle. Repeated rows each give a row; other columns are not
looked at.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSAGE = 512
TRAIN_ROWS, TRAIN_PASSAGES = 3000, 64
THRESHOLD = 0.3
#: Code points encoded at a time: whole passages.
STEP = 512 * PASSAGE
HIDDEN, ATTENTION = 24, 16
EPOCHS, BAGS, RATE, DECAY = 14, 64, 4e-3, 1e-4

CLASSES = 16
LOWER, UPPER, DIGIT, SPACE, LINE, STOP, COMMA, MARK, QUOTE, BRACKET, DASH, SYMBOL, MONEY, LETTER, CONTROL, OTHER = range(CLASSES)
WORD_FEATURES = 6
FEATURES = CLASSES * CLASSES + WORD_FEATURES


@functools.cache
def classes() -> np.ndarray:
    """The class of each code point of the basic plane; those beyond count as its last one."""
    def of(c: str) -> int:
        for chars, k in (("\n\r", LINE), (".", STOP), (",;:", COMMA), ("!?", MARK), ("\"'`", QUOTE), ("()[]{}<>", BRACKET),
                         ("-_/\\|", DASH), ("#*&@^~+=", SYMBOL), ("$%", MONEY)):
            if c in chars:
                return k
        for test, k in ((str.isspace, SPACE), (str.islower, LOWER), (str.isupper, UPPER), (str.isdigit, DIGIT), (str.isalpha, LETTER)):
            if test(c):
                return k
        return OTHER if c.isprintable() else CONTROL
    return np.array([of(chr(i)) for i in range(1 << 16)], np.uint8)


def blocks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document of each passage, length of each passage, code points) of about ``STEP`` points at a time."""
    docs, lengths, parts, size = [], [], [], 0

    def out():
        return np.array(docs), np.array(lengths), np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    for d, text in enumerate(texts):
        for a in range(0, max(1, len(text or "")), STEP):
            codes = np.frombuffer((text or "")[a:a + STEP].encode("utf-32-le", "replace"), np.uint32)
            each = [PASSAGE] * (len(codes) // PASSAGE) + ([len(codes) % PASSAGE] if len(codes) % PASSAGE or not len(codes) else [])
            docs += [d] * len(each)
            lengths += each
            parts.append(codes)
            size += len(codes)
            if size >= STEP or len(docs) >= STEP // 64:
                yield out()
                docs, lengths, parts, size = [], [], [], 0
    if docs:
        yield out()


def encode(lengths: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """(passages, FEATURES) float32."""
    n, out = len(lengths), np.zeros((len(lengths), FEATURES), np.float32)
    if not len(codes):
        return out
    owner = np.repeat(np.arange(n), lengths)
    kind = classes()[np.minimum(codes, (1 << 16) - 1)]
    same = owner[1:] == owner[:-1]
    pair = (owner[:-1] * CLASSES + kind[:-1]) * CLASSES + kind[1:]
    counts = np.bincount(pair[same], minlength=n * CLASSES * CLASSES).reshape(n, -1)
    out[:, :CLASSES * CLASSES] = np.sqrt(counts / np.maximum(lengths - 1, 1)[:, None])
    inside = (kind != SPACE) & (kind != LINE)
    begins = inside & ~np.concatenate([[False], inside[:-1] & same])
    starts = np.flatnonzero(begins)
    if not len(starts):
        return out
    # a word's hash: the sum of its code points' hashes, each times an odd number that depends on its place
    place = np.arange(len(codes)) - np.concatenate([[0], starts])[np.cumsum(begins)]
    mixed = (codes.astype(np.uint32) * np.uint32(2654435761) ^ np.uint32(0x9E3779B9)) * (place.astype(np.uint32) * np.uint32(2) + np.uint32(40503))
    mixed ^= mixed >> np.uint32(13)
    mixed[~inside] = 0
    words, sizes, home = np.add.reduceat(mixed, starts) & 0xFFFFFFFF, np.add.reduceat(inside.astype(np.int64), starts), owner[starts]
    m = np.bincount(home, minlength=n)
    some = np.maximum(m, 1)
    ids, times = np.unique(home.astype(np.int64) << 32 | words.astype(np.int64), return_counts=True)
    most = np.zeros(n)
    np.maximum.at(most, ids >> 32, times)

    def repeats(back: int) -> np.ndarray:
        again = (words[back:] == words[:-back]) & (home[back:] == home[:-back])
        return np.bincount(home[back:][again], minlength=n) / some

    out[:, -WORD_FEATURES:] = np.column_stack([
        np.bincount(ids >> 32, minlength=n) / some, repeats(1), repeats(2), most / some,
        np.minimum(np.bincount(home, weights=sizes, minlength=n) / some / 10, 3), np.log1p(m) / 5])
    return out


def fresh(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(a, b):
        return (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)

    return {"W": normal(FEATURES, HIDDEN) * 2, "Wb": np.zeros(HIDDEN, np.float32), "V": normal(HIDDEN, ATTENTION),
            "U": normal(HIDDEN, ATTENTION), "w": normal(ATTENTION, 1)[:, 0], "b": np.zeros(HIDDEN, np.float32), "c": np.zeros(1, np.float32)}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def attend(m: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Encoded passages, the two gates, and the unnormalised attention. The exponent is bounded by the weights."""
    h = np.tanh(x @ m["W"] + m["Wb"])
    t, s = np.tanh(h @ m["V"]), sigmoid(h @ m["U"])
    return h, t, s, np.exp(np.clip((t * s) @ m["w"], -30, 30))


def gradients(m: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the weighted log loss over bags of passages that begin at ``starts``."""
    bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
    h, t, s, a = attend(m, x)
    a = a / np.add.reduceat(a, starts)[bag]
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    dl = ((sigmoid(z @ m["b"] + m["c"]) - y) * weight / len(y)).astype(np.float32)
    dz = dl[:, None] * m["b"]
    dh = a[:, None] * dz[bag]
    da = (h * dz[bag]).sum(axis=1)
    de = a * (da - np.add.reduceat(a * da, starts)[bag])
    dg = de[:, None] * m["w"]
    dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
    dh += dt @ m["V"].T + ds @ m["U"].T
    dx = dh * (1 - h * h)
    return {"W": x.T @ dx, "Wb": dx.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "b": z.T @ dl, "c": dl.sum(keepdims=True)}


def fit(x: np.ndarray, bags: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Adam over mini-batches of bags; ``bags`` gives the bag of each passage, in order; ``y`` and ``weight`` are by bag."""
    m, rng = fresh(), np.random.default_rng(11)
    starts = np.flatnonzero(np.append(True, bags[1:] != bags[:-1]))
    ends = np.append(starts[1:], len(x))
    mean, var = ({k: np.zeros_like(v) for k, v in m.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs) + RATE / 20
        order = rng.permutation(len(starts))
        for a in range(0, len(order), BAGS):
            some = order[a:a + BAGS]
            rows = np.concatenate([np.arange(starts[i], ends[i]) for i in some])
            first = np.cumsum(np.append(0, (ends - starts)[some]))[:-1]
            g = gradients(m, x[rows], first, y[some], weight[some])
            step += 1
            for k in m:
                grad = g[k].astype(np.float32) + DECAY * m[k]
                mean[k] = 0.9 * mean[k] + 0.1 * grad
                var[k] = 0.999 * var[k] + 0.001 * grad * grad
                m[k] = (m[k] - rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(var[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return m


def sample(docs: DataFrame, labels: DataFrame, rows: int, text_col: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """(label, text) of about ``rows`` labelled documents of each class, each text once, and the classes' sizes."""
    known = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(
        F.min("quality").alias("y"), F.max("quality").alias("most")).filter("y = most").select(
        F.col("doc_id").alias("id"), F.col("y").cast("int").alias("y"))
    ids = docs.select(F.col("doc_id").alias("id"))
    sizes = {r["y"]: r["n"] for r in ids.join(known, "id").groupBy("y").agg(F.count("*").alias("n")).collect()}
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.coalesce(*[F.when(F.col("y") == y, min(1.0, rows / n)) for y, n in sizes.items()], F.lit(0.0)) if sizes else F.lit(0.0)
    # about rows ids of each class: few enough to be sent to all tasks, which then read the texts without a shuffle
    chosen = F.broadcast(known.filter(chance < share)) if _ids_fit(known, chance < share, rows) else known.filter(chance < share)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    found = docs.select(F.col("doc_id").alias("id"), text).join(chosen, "id").select("y", "text")
    return found.dropDuplicates(), sizes


def _ids_fit(known: DataFrame, chosen: Column, rows: int) -> bool:
    """Whether the sampled ids are as few as expected (labels of ids that no document has may be many)."""
    return known.filter(chosen).count() <= 16 * rows


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, text_col: str = "text", epochs: int = EPOCHS) -> dict[str, np.ndarray] | None:
    """The model learned from the labelled documents among ``docs``; None if there are none."""
    found, sizes = sample(docs, labels, rows, text_col)

    def scan(batches):
        for b in batches:
            labels, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            place = [i for i, t in enumerate(texts) if len(t) <= PASSAGE * TRAIN_PASSAGES]
            for docs, lengths, codes in blocks([texts[i] for i in place]):
                x = encode(lengths, codes)
                for d in np.unique(docs):
                    of = place[d]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([labels[of]], pa.int32()), pa.array([hash_of(texts[of])], pa.int64()),
                         pa.array([x[docs == d].ravel()], pa.list_(pa.float32()))], ["y", "h", "x"])

    bags = found.mapInArrow(scan, "y int, h long, x array<float>").toArrow()  # 2 * rows documents of bounded length
    if not len(bags):
        return None
    order = np.lexsort((bags["y"].to_numpy(), bags["h"].to_numpy()))
    x = [np.asarray(v, np.float32).reshape(-1, FEATURES) for v in bags["x"].to_numpy()[order]]
    y = bags["y"].to_numpy()[order]
    # a class that was thinned weighs as much as all its documents, so that scores are shares of all labelled ones
    share = np.array([sizes.get(k, 0) / max(1, (y == k).sum()) for k in (0, 1)])
    weight = (share / (share[y].mean() or 1))[y].astype(np.float32)
    return fit(np.concatenate(x), np.repeat(np.arange(len(x)), [len(v) for v in x]), y.astype(np.float32), weight, epochs)


def hash_of(text: str) -> int:
    data = text.encode("utf-8", "replace")
    return zlib.crc32(data) << 31 | zlib.adler32(data)


def score_batch(texts: list[str | None], m: dict[str, np.ndarray]) -> np.ndarray:
    weight, z = np.zeros(len(texts)), np.zeros((len(texts), HIDDEN))
    for docs, lengths, codes in blocks(texts):
        h, _, _, a = attend(m, encode(lengths, codes))
        np.add.at(weight, docs, a)
        np.add.at(z, docs, a[:, None] * h)
    return sigmoid((z / weight[:, None]) @ m["b"] + m["c"]).astype(float)


def predict(docs: DataFrame, model: dict[str, np.ndarray] | None, keys: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The key columns and score (0 to 1) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # some thousands of weights
    narrow = docs.select(F.col(f"`{text_col}`").alias("__text"), *[c.alias(k) for k, c in keys.items()])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema.fields[1:])

    def scan(batches):
        m = sent.value
        for b in batches:
            texts = b.column(0).to_pylist()
            score = np.full(len(texts), 0.5) if m is None else score_batch(texts, m)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(score, pa.float64())], [*b.schema.names[1:], "score"])

    return narrow.mapInArrow(scan, f"{kinds}, score double")

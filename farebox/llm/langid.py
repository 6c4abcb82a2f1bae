"""Language identification: multinomial naive Bayes over hashed character n-grams.

Features: every character 1- to ``ORDER``-gram of the text, simple-lower-cased, each
hashed into ``2 ** BITS`` buckets per order. Training counts them per language over
labelled rows; the log-probability matrix (buckets x languages, float32, at most
``MAX_LANGS`` languages) goes to the tasks, which score batches of documents with
one gather and one segmented sum.

Training uses about ``TRAIN_ROWS`` labelled rows: all of them while there are no more,
else an even number of each language (all rows of a language that has fewer), chosen
by a hash of the whole row, so that copies of a text are thinned like other rows.
Priors come from all labelled rows. Prediction reads every text whole.

Null text, or a text without a letter, is ``und`` with score 0; so is everything if
there is nothing to learn from. Rows with a null label are not learned from. Ties go
to the language first in name order. Repeated rows each give a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import row_key

ORDER, BITS = 3, 15
TRAIN_ROWS, MAX_LANGS = 40_000, 512
SMOOTHING = 0.5
UNKNOWN = "und"
#: Code points scored at a time, while a score takes at most 16 languages; fewer with more.
STEP = 1 << 19


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def features(codes: np.ndarray) -> np.ndarray:
    """(ORDER, len - ORDER + 1) buckets of the n-grams that end at each code point after the first ORDER - 1."""
    n = len(codes) - ORDER + 1
    out = np.empty((ORDER, n), np.int32)
    h = np.zeros(n, np.uint32)
    for k in range(ORDER):
        h = (h ^ codes[ORDER - 1 - k:ORDER - 1 - k + n]) * np.uint32(2654435761)
        h ^= h >> np.uint32(15)
        out[k] = (h >> np.uint32(32 - BITS)).astype(np.int32) + (k << BITS)
    return out


def pieces(texts: list[str | None], langs: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks (documents, first position of each, code points) of about ``STEP`` points, fewer beyond 16 languages.

    Each piece starts with the ORDER - 1 points before it (zeros at a text's start), so that a long text can be
    scored in several pieces and no n-gram is lost or counted twice.
    """
    step = max(1, 16 * STEP // max(16, langs))
    docs, parts, size = [], [], 0
    for d, text in enumerate(texts):
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32) if text else np.zeros(0, np.uint32)
        codes = np.concatenate([np.zeros(ORDER - 1, np.uint32), codes])
        for a in range(0, len(codes) - ORDER + 1, step):
            part = codes[a:a + step + ORDER - 1]
            docs.append(d)
            parts.append(part)
            size += len(part)
            if size >= step:
                yield _block(docs, parts)
                docs, parts, size = [], [], 0
    if docs:
        yield _block(docs, parts)


def _block(docs, parts):
    starts = np.cumsum([0] + [len(p) for p in parts[:-1]])
    return np.array(docs), starts, np.concatenate(parts)


def _own(starts: np.ndarray, length: int) -> np.ndarray:
    """Which n-gram ends of a block belong to a piece rather than to the points that lead into it."""
    own = np.ones(length - ORDER + 1, bool)
    for k in range(1, ORDER):
        own[(starts[1:] - k)] = False
    return own


def count_features(texts: list[str], labels: list[int], langs: int) -> np.ndarray:
    counts = np.zeros((langs, ORDER << BITS), np.int32)
    labels = np.array(labels)
    for docs, starts, codes in pieces(texts):
        f, own = features(codes), _own(starts, len(codes))
        lang = np.repeat(labels[docs], np.diff(np.append(starts, len(codes))))[:len(own)][own]
        for row in f:
            place, times = np.unique(lang * counts.shape[1] + row[own], return_counts=True)
            counts.reshape(-1)[place] += times.astype(np.int32)
    return counts


def sample_shares(sizes: list[int], rows: int) -> list[float]:
    """The share of each language's rows to learn from: even numbers, what small languages leave goes to larger ones."""
    out, left = [0.0] * len(sizes), float(rows)
    for done, i in enumerate(sorted(range(len(sizes)), key=sizes.__getitem__)):
        take = min(float(sizes[i]), left / (len(sizes) - done))
        out[i], left = take / sizes[i], left - take
    return out


def sample(known: DataFrame, langs: list[str], shares: list[float]) -> DataFrame:
    """The rows (lang, text, h) whose hash falls into their language's share."""
    if all(x >= 1 for x in shares):
        return known
    most = F.create_map(*[F.lit(v) for k, x in zip(langs, shares) for v in (k, int(x * (1 << 30)))])
    return known.filter(F.pmod("h", F.lit(1 << 30)) < F.try_element_at(most, F.col("lang")))


def train(docs: DataFrame, label_col: str = "lang", text_col: str = "text", rows: int = TRAIN_ROWS
          ) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log-probabilities [bucket, language], log-priors) learned from ``docs``."""
    known = docs.select(F.col(f"`{label_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"),
                        row_key(docs)[0].alias("h")).filter("lang is not null and text is not null")
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(MAX_LANGS + 1).collect()
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    langs = [r["lang"] for r in sizes]
    n = np.array([r["n"] for r in sizes], float)
    counts = np.zeros((len(langs), ORDER << BITS))
    if langs:
        known = sample(known, langs, sample_shares([r["n"] for r in sizes], rows)).select("lang", "text")
        place = {x: i for i, x in enumerate(langs)}

        def count(batches):
            total = np.zeros(counts.shape, np.int32)
            for b in batches:
                total += count_features(b.column(1).to_pylist(), [place[x] for x in b.column(0).to_pylist()], len(langs))
            lang, bucket = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(bucket.astype(np.int32)),
                                              pa.array(total[lang, bucket].astype(np.int64))], ["l", "b", "n"])

        got = known.mapInArrow(count, "l int, b int, n bigint").groupBy("l", "b").agg(F.sum("n").alias("n")).toArrow()
        counts[got["l"].to_numpy(), got["b"].to_numpy()] = got["n"].to_numpy()  # languages x buckets at most
    per_order = counts.reshape(len(langs), ORDER, 1 << BITS) + SMOOTHING
    logp = np.log(per_order / per_order.sum(axis=2, keepdims=True)).reshape(counts.shape).T
    return langs, np.ascontiguousarray(logp, np.float32), np.log(n / n.sum()) if langs else n


def score_batch(texts: list[str | None], logp: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """(documents, languages) log joint probabilities."""
    total = np.tile(prior, (len(texts), 1))
    for docs, starts, codes in pieces(texts, len(prior)):
        f, own = features(codes), _own(starts, len(codes))
        each = np.zeros((len(codes), len(prior)), np.float32)
        for row in f:
            each[ORDER - 1:] += logp[row]
        each[ORDER - 1:][~own] = 0
        each[:ORDER - 1] = 0
        np.add.at(total, docs, np.add.reduceat(each, starts, axis=0, dtype=np.float64))
    return total


def _named(texts: list[str | None], names: list[str], matrix: np.ndarray, start: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and posterior probability of each text."""
    texts = [t if has_letter(t) else None for t in texts]
    if not names:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    joint = score_batch(texts, matrix, start)
    best = joint.argmax(axis=1)
    top = 1 / np.exp(joint - joint.max(axis=1, keepdims=True)).sum(axis=1)
    pred = [UNKNOWN if t is None else names[k] for t, k in zip(texts, best)]
    return pred, np.where([t is None for t in texts], 0.0, top)


def accepted(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], least_score: float, text_col: str = "text") -> DataFrame:
    """The rows that have a language: a letter, and a prediction of at least ``least_score``. Only the text goes to Python."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def keep(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            pred, score = _named(b.tolist(), *sent.value)
            yield pd.Series([p != UNKNOWN and x >= least_score for p, x in zip(pred, score)], dtype=bool)

    return docs.filter(keep(F.col(f"`{text_col}`")))


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], keys: dict[str, Column],
            text_col: str = "text") -> DataFrame:
    """The key columns, lang_pred and score (posterior probability of lang_pred) of every row; no shuffle."""
    langs, logp, prior = model
    sent = docs.sparkSession.sparkContext.broadcast((langs, logp, prior))  # MAX_LANGS x buckets at most
    narrow = docs.select(F.col(f"`{text_col}`").alias("__text"), *[c.alias(k) for k, c in keys.items()])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema.fields[1:])

    def scan(batches):
        names, matrix, start = sent.value
        for b in batches:
            pred, score = _named(b.column(0).to_pylist(), names, matrix, start)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(pred, pa.string()), pa.array(score)],
                                             [*b.schema.names[1:], "lang_pred", "score"])

    return narrow.mapInArrow(scan, f"{kinds}, lang_pred string, score double")

from __future__ import annotations

import random

import pytest

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def make_docs(seed=3, n=160):
    """Small corpus with copies, near copies, nulls in every column, empty and long texts, a hot source."""
    r = random.Random(seed)
    vocab = {"en": "the of and river Stone walk light over under Bridge town".split(),
             "fr": "le la et Rivière pierre été marche lumière été pont ville".split()}
    rows = []
    for i in range(n):
        lang = r.choice(["en", "fr"])
        text = " ".join(r.choice(vocab[lang]) for _ in range(r.choice([1, 2, 5, 30, 60])))
        rows.append([i, text, lang, "hot" if i % 3 else f"s{i % 5}"])
    for i in range(0, 40, 2):
        rows.append([n + i, rows[5][1], rows[5][2], "hot"])  # exact copies
    rows.append([9001, rows[7][1] + ".", "en", "s1"])
    rows += [[9002, None, None, None], [9003, "", "en", "s1"], [9004, " \n\t ", "en", None], [9005, "12 34 !!", "fr", "s2"],
             [None, "the river and the stone", "en", "s2"], [9006, "word " * 20000, "en", "s3"],
             [9007, "ÉTÉ Çà 日本語 \U0001f600 x", "fr", "s3"], [9008, "the river", "en", "hot"], [9008, "the river", "en", "hot"]]
    return [tuple(x) + (len(x[1]) if x[1] is not None else None,) for x in rows]


@pytest.fixture(scope="session")
def doc_rows():
    return make_docs()


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    return spark.createDataFrame(doc_rows, DOC_SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def crowded(docs):
    """The documents with extra columns whose names the operators might use themselves."""
    from pyspark.sql import functions as F

    names = ("fp u v s n src share blocks buckets bucket h1 h2 row i epoch number slot r rid pos kind first ctx id __text "
             "__h1 __h2 __slot text_hash dirty_id shard old size score lang_pred spans").split()
    return docs.select("*", *[F.lit(k).alias(name) for k, name in enumerate(names)])

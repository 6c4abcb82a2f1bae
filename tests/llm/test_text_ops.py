"""PII, language ID, URL rules and chat formatting against brute force."""

from __future__ import annotations

import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farebox.llm import chat, langid, pii, queries, urlfilter

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(d):
    return sum(int(x) if i % 2 == 0 else sum(divmod(2 * int(x), 10)) for i, x in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, p) in enumerate(PLAIN.items()):
        for m in p.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), k, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def own_base(text):
    return [(s["kind"], s["start"], s["end"]) for s in pii.spans_of(text) if s["kind"] in pii.BASE_KINDS]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="019 .-+()@aZ_%é\n", max_size=60))
def test_base_spans_equal_plain_patterns(text):
    assert own_base(text) == base_spans(text)


@pytest.mark.parametrize("text", [
    None, "", "a@b.c", "x@y@z.com", "a.b+c@d-e.f.g. next 4111 1111 1111 1111, 4111111111111112", "1.2.3.4.5.6.7.8 256.1.1.1 000.0.0.255",
    "+1 (555) 010-9999 +123 45 6789)", "é" * 50 + "q@r.st", "+1" + " " * 100 + "2345678901", "\U0001f600 a@b.co \U0001f600 10.0.0.1"])
def test_base_spans_cases(text):
    assert own_base(text) == base_spans(text)


def test_long_runs_take_linear_time():
    text = "1" * 300_000 + " " + "a" * 300_000 + " " + "1.1" * 100_000 + " +1" + " " * 300_000 + "@" * 1000
    began = time.monotonic()
    assert {s["kind"] for s in pii.spans_of(text)} == {"ip"}  # 11.11.11.11 and so on
    assert time.monotonic() - began < 20


def test_checksums_and_context():
    kinds = {s["kind"] for s in pii.spans_of("IBAN DE89 3704 0044 0532 0130 00 and ssn 123-45-6789")}
    assert {"iban", "ssn"} <= kinds


@pytest.mark.parametrize("code,behind", [
    ("DE89 3704 0044 0532 0130 00", " BIC COBADEFFXXX"), ("GB29 NWBK 6016 1331 9268 19", " 100 EUR"),
    ("DE89370400440532013000", " GB29 NWBK 6016 1331 9268 19"), ("NO93 8601 1117 947", " 2 X"), ("BE68 5390 0754 7034", ""),
    ("GB29 NWBK 6016 1331 9268 19", "\u00c9")])
def test_iban_ends_with_its_last_group(spark, code, behind):
    text = f"iban AB12 {code}{behind}"
    spans = [s for s in pii.spans_of(text) if s["kind"] == "iban"]
    assert (spans[0]["start"], spans[0]["end"]) == (10, 10 + len(code))
    assert len(spans) == 1 + ("NWBK" in behind)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert code not in pii.redact(docs).first()["text"]


def test_iban_of_no_listed_country_and_no_iban():
    code = next(c for k in range(100) if pii.mod97(c := f"ZZ{k:02}12345678901234"))
    assert [(s["start"], s["end"]) for s in pii.spans_of(f"iban {code} A1") if s["kind"] == "iban"] == [(5, 23)]
    for text in ("DE89 3704 0044 0532 0130 00X", "DE88 3704 0044 0532 0130 00 BIC", "DE89", "DE89 3704 0044"):
        assert not [s for s in pii.spans_of("iban " + text) if s["kind"] == "iban"]
    assert not pii.spans_of("DE88 3704 0044 0532 0130 00 part 123-45-6789 of")
    near = pii.spans_of("my email a@b.co")[0]["score"]
    assert near > pii.spans_of("see a@b.co")[0]["score"]


def test_find_pii_rows_and_extra_columns(crowded, no_docs):
    got = pii.find_pii(crowded).collect()
    assert len(got) == crowded.count()
    assert pii.find_pii(no_docs).collect() == []


def test_redact(spark):
    df = spark.createDataFrame([(1, "mail a@b.co now", "x"), (2, None, "y")], "doc_id long, text string, spans string")
    assert [tuple(r) for r in pii.redact(df).orderBy("doc_id").collect()] == [(1, "mail [EMAIL] now", "x"), (2, None, "y")]


def test_op1_digests(spark):
    for r in queries.op1_pii(spark, "/root/testdata/sf0.001").join(
            spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"), "doc_id").collect():
        want = base_spans(r["text"])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(
            sum(k == kind for k, _, _ in want) for kind in pii.BASE_KINDS)


# -- language ID -----------------------------------------------------------------------------------

def plain_scores(text, model):
    """Log joint of one text, n-gram by n-gram."""
    langs, logp, prior = model
    codes = [0] * (langid.ORDER - 1) + [ord(c) for c in text.lower()]
    total = prior.astype(float).copy()
    mask = (1 << 32) - 1
    for end in range(langid.ORDER - 1, len(codes)):
        h = 0
        for k in range(langid.ORDER):
            h = ((h ^ codes[end - k]) * 2654435761) & mask
            h ^= h >> 15
            total += logp[(h >> (32 - langid.BITS)) + (k << langid.BITS)]
    return total


def test_langid_equals_plain_scoring(docs, doc_rows, monkeypatch):
    model = langid.train(docs.filter("doc_id % 2 = 0"))
    got = {r["doc_id"]: r for r in langid.predict(docs, model, {"doc_id": F.col("doc_id")}).collect()}
    for doc_id, text, *_ in doc_rows:
        if doc_id in (None, 9006, 9008):
            continue
        r = got[doc_id]
        if text is None or not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            want = plain_scores(text, model)
            assert r["lang_pred"] == model[0][int(want.argmax())]
            assert 0 < r["score"] <= 1


def test_langid_pieces_do_not_change_scores(monkeypatch, docs):
    model = langid.train(docs)
    texts = ["the river " * 50, None, "été " * 33, "x"]
    whole = langid.score_batch(texts, model[1], model[2])
    monkeypatch.setattr(langid, "STEP", 7)
    assert abs(langid.score_batch(texts, model[1], model[2]) - whole).max() < 1e-3


def test_langid_empty_and_crowded(no_docs, crowded):
    model = langid.train(no_docs)
    assert model[0] == []
    got = langid.predict(crowded, model, {"doc_id": F.col("doc_id")})
    assert {r["lang_pred"] for r in got.collect()} == {"und"}


def test_langid_sample_is_bounded_and_even(spark):
    assert langid.sample_shares([10, 1000, 100], 60) == [1.0, 0.025, 0.25]
    assert langid.sample_shares([3, 4], 100) == [1.0, 1.0]
    rows = spark.range(6000).select(
        "id", F.when(F.col("id") < 40, "fr").otherwise("en").alias("lang"), F.lit("the same text").alias("text"),
        F.xxhash64("id").alias("h"))
    got = {r["lang"]: r["count"] for r in langid.sample(
        rows, ["en", "fr"], langid.sample_shares([5960, 40], 600)).groupBy("lang").count().collect()}
    assert got["fr"] == 40 and 450 < got["en"] < 680


def test_langid_learns_from_a_sample(docs, doc_rows):
    model = langid.train(docs, rows=60)
    got = langid.predict(docs, model, {"doc_id": F.col("doc_id"), "lang": F.col("lang")}).filter(
        "lang_pred <> 'und' and lang is not null")
    assert got.filter("lang = lang_pred").count() > 0.8 * got.count()


def test_langid_held_out_accuracy(spark):
    got = queries.op6_langid(spark, "/root/testdata/sf0.1").join(
        spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang"), "doc_id")
    hit, n = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 2000 and hit > 0.97


# -- URL rules -------------------------------------------------------------------------------------

def plain_verdict(url):
    i = (url or "").find("://")
    rest = url[i + 3:] if i >= 0 else ""
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for r in queries.URL_RULES:
        if not r.pattern and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path):
            if best is None or len(r.host + r.path) > len(best.host + best.path):
                best = r
    if best:
        return host, path, best.name, best.verdict
    hit = any(r.pattern and re.search(r.pattern, host + path) for r in queries.URL_RULES)
    return host, path, None, "block" if hit else "allow"


URLS = [None, "", "example.org/es/", "http://example.org/es/1", "http://Sub.EXAMPLE.org/en/12", "http://example.org/en/2",
        "http://notexample.org/es/", "http://example.org?x=/es/", "https://a.com/fr/#/de/", "https://com/de/", "x://com",
        "http://xcom/de/", "http://spam-farm.net/a", "http://a.spam-farm.b.net", "http://a.com/de/spam-farm.", "http://h/p://q.com/de/",
        "http:///es/", "http://é.example.org/es/", "http://casino-win.example.net/en/5", "http://my-casino-win.net/", "://org/",
        "http://example.org/EN/1", "http://user@example.org:80/es/"]


def test_urls_equal_plain_rules(spark):
    df = spark.createDataFrame([(i, u, "z") for i, u in enumerate(URLS)] + [(0, None, "z")], "page_id long, url string, rule string")
    got = urlfilter.judge(df, queries.URL_RULES).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain_verdict(URLS[r["page_id"]]), URLS[r["page_id"]]
    assert urlfilter.judge(df.limit(0), queries.URL_RULES).collect() == []


def test_rules_are_filed_under_the_rarest_token():
    rules = [urlfilter.Rule("block", "example.org", "/en/1"), urlfilter.Rule("block", pattern="x", sure=())]
    index = urlfilter.build_index(rules, {"example": 50, "org": 20, "en": 90})
    assert index == {"org": [0], "": [1]}


# -- chat ------------------------------------------------------------------------------------------

CONV = [(1, 0, "user", "hi <b> # \\ </turn>\n"), (1, 1, "assistant", "### user:\nno \\l \\\\b"), (2, 0, "assistant", "x"),
        (3, 2, "user", None), (3, 1, None, "odd: \\c"), (4, 0, "user", ""), (4, 1, "assistant", ""), (4, 1, "assistant", ""),
        (None, 0, "user", "n"), (5, None, "we:ird\n### ", "y</turn>\n"), (6, 0, "user", "long " * 50000), (6, 1, "assistant", "ok")]


def test_chat_round_trip(spark):
    df = spark.createDataFrame([(*c, "k") for c in CONV], "conv_id long, turn long, role string, text string, segments string")
    got = chat.format_conversations(df).select(
        "*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss_text(F.col("segments")).alias("loss")).collect()
    groups = {}
    for conv, turn, role, text in CONV:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert {r["conv_id"] for r in got} == set(groups)
    for r in got:
        want = [x[2:] for x in sorted(groups[r["conv_id"]])]
        assert [tuple(t) for t in r["turns"]] == want
        assert r["loss"] == "".join(t for role, t in want if role == "assistant")
        assert r["formatted"].count("</turn>") == len(want)
    ok = {r["conv_id"]: (r["valid"], r["refused_at"]) for r in got}
    assert ok[1] == (True, None) and ok[2] == (False, 0) and ok[4] == (False, 2) and ok[6] == (True, None) and ok[3] == (False, 0)
    assert chat.format_conversations(df.limit(0)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="\\<#lhbc:/turn>\n ", max_size=20), min_size=1, max_size=20))
def test_escape_round_trip(spark, texts):
    c = chat.DEFAULT.codes + chat.DEFAULT.role_codes
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escape(F.col("t"), c).alias("e"), chat.unescape(chat.escape(F.col("t"), c), c).alias("u")).collect():
        assert r["u"] == r["t"] and not set("<#:") & set(r["e"])

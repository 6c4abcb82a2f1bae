"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Base kinds (``email``, ``ip``, ``card``, ``phone``) are leftmost, non-overlapping
matches per kind, confirmed by part range, Luhn or digit count; a base span is
never dropped by its score. Further kinds (``iban`` confirmed by mod-97, ``ssn``)
are kept only when checksum and context lift them to ``MIN_SCORE``.

Null text counts as empty (no spans). Offsets are code points, end exclusive.
Patterns are possessive and anchored, so time is linear in the text length
however long a run of digits or letters is. Repeated rows each give a row, an empty
table gives none. ``find_pii`` looks at the id and the text alone, ``redact`` keeps all
other columns as they are, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("iban", "ssn")
KINDS = BASE_KINDS + EXTRA_KINDS
MIN_SCORE = 0.6
#: Code points looked at before and after a span for context words.
CONTEXT_BEFORE, CONTEXT_AFTER = 48, 24

LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: A match can't start inside a digit run: a longer one from the run's start would have been taken.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
IBAN_NEXT = re.compile(r" ?[A-Z0-9]")
#: Characters of an IBAN by country; of other countries any length from LEAST_IBAN to MOST_IBAN may be one.
IBAN_LENGTHS = {country: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}
LEAST_IBAN, MOST_IBAN = 15, 34
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
NOT_DIGIT = re.compile(r"[^0-9]+")

#: Score of a confirmed span without context, words that raise it and words that lower it.
SCORES = {
    "email": (0.9, "mail email contact write courriel correo", ""),
    "ip": (0.6, "ip host server address adresse", "version release section"),
    "card": (0.8, "card visa mastercard credit carte karte tarjeta payment", "isbn order tracking"),
    "phone": (0.7, "phone tel call mobile fax telefon telefono", ""),
    "iban": (0.7, "iban bank account konto compte cuenta", "serial model"),
    "ssn": (0.4, "ssn social security", "isbn order part"),
}
RAISE, CUT = 0.2, 0.3
CONTEXT_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def mod97(code: str) -> bool:
    code = code.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _iban_end(text: str, start: int, least: int, most: int, stop: int) -> int | None:
    """End of the longest run of whole groups from ``start`` that has least to most characters and is confirmed."""
    at, ends = start + 4, []
    for chars in range(5, most + 1):
        step = IBAN_NEXT.match(text, at, stop)
        if not step:
            break
        at = step.end()
        if chars >= least and not (text[at:at + 1].isascii() and text[at:at + 1].isalnum()):
            ends.append(at)
    return next((e for e in reversed(ends) if mod97(text[start:e])), None)


def _ibans(text: str) -> list[tuple[int, int]]:
    """Confirmed IBANs: those of a listed country's length, then between them those of other countries.

    What follows an IBAN may look like more of it, so the search goes on right behind a confirmed span and
    inside one that is not. At most MOST_IBAN characters are looked at from each start.
    """
    found, others = [], []
    m = IBAN_START.search(text)
    while m:
        length = IBAN_LENGTHS.get(text[m.start():m.start() + 2])
        end = _iban_end(text, m.start(), length, length, len(text)) if length else None
        if end:
            found.append((m.start(), end))
        elif not length:
            others.append((m.start(), len(found)))
        m = IBAN_START.search(text, end or m.start() + 4)
    done, listed = 0, [a for a, _ in found]
    for start, k in others:
        if start >= done and (end := _iban_end(
                text, start, LEAST_IBAN, MOST_IBAN, listed[k] if k < len(listed) else len(text))):
            found.append((start, end))
            done = end
    return found


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every match holds one @; its local part starts as far left as the class and the last match allow."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_PART:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _proposed(text: str) -> Iterator[tuple[int, int, int]]:
    """Confirmed spans as (start, place of the kind in KINDS, end)."""
    if "@" in text:
        for a, b in _emails(text):
            yield a, 0, b
    for m in IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            yield m.start(), 1, m.end()
    for m in CARD.finditer(text):
        if 12 <= m.end() - m.start() and 12 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            yield m.start(), 2, m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                yield m.start(), 3, m.end()
    for a, b in _ibans(text):
        yield a, 4, b
    if "-" in text:
        for m in SSN.finditer(text):
            yield m.start(), 5, m.end()


def score(kind: str, text: str, start: int, end: int) -> float:
    value, up, down = SCORES[kind]
    near = set(CONTEXT_WORD.findall(
        (text[max(0, start - CONTEXT_BEFORE):start] + " " + text[end:end + CONTEXT_AFTER]).lower()))
    value += RAISE * bool(near & set(up.split())) - CUT * bool(near & set(down.split()))
    return round(min(1.0, max(0.0, value)), 3)


def spans_of(text: str | None) -> list[dict]:
    """All spans of one text by start, then kind as listed in KINDS."""
    text = text or ""
    out = []
    for start, k, end in sorted(_proposed(text)):
        s = score(KINDS[k], text, start, end)
        if k < len(BASE_KINDS) or s >= MIN_SCORE:
            out.append({"kind": KINDS[k], "start": start, "end": end, "score": s})
    return out


SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                ("score", pa.float64())]))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``spans`` array<struct<kind, start, end, score>>.

    No shuffle: each scan task streams its own Arrow batches.
    """
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def scan(batches):
        for b in batches:
            found = pa.array([spans_of(t) for t in b.column(1).to_pylist()], SPAN_TYPE)
            yield pa.RecordBatch.from_arrays([b.column(0), found], ["id", "spans"])

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(
        scan, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>"
    ).withColumnRenamed("id", id_col)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with every span replaced by ``[KIND]`` (overlaps merge into the first span's kind)."""
    schema = docs.schema
    where = docs.columns.index(text_col)

    def clean(text):
        if text is None:
            return None
        out, done = [], 0
        for s in spans_of(text):
            if s["start"] >= done:
                out += [text[done:s["start"]], f"[{s['kind'].upper()}]"]
            done = max(done, s["end"])
        return "".join(out) + text[done:]

    def scan(batches):
        for b in batches:
            new = pa.array([clean(t) for t in b.column(where).to_pylist()], pa.string())
            yield b.set_column(where, b.schema.field(where).name, new)

    return docs.mapInArrow(scan, schema)

"""URL rules indexed by their rarest literal token.

A rule is (host, path prefix, pattern, verdict). Its literal tokens are those that
every URL it fits must hold; it is filed under the one that is rarest among the
table's URLs. A URL's tokens fetch the rules filed under them, and only those run
their regular expression. Longest rule (host + path) wins over shorter ones; rules
with a host win over patterns without one; a URL that no rule fits is allowed.

Null or scheme-less URLs have empty host and path and fit no host rule. Repeated
rows each give a row. The rule list is a parameter, held on the driver and sent
with the task; ``MAX_RULES`` bounds it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_RULES = 200_000
TOKEN = re.compile(r"[a-z0-9]+")
PARTS = re.compile(r"://([^/?#]*)([^?#]*)")
UPPER_TO_LOWER = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Rule:
    """``host``/``path``: base rule. ``pattern``: a regular expression over host + path, with its sure tokens."""

    verdict: str
    host: str = ""
    path: str = ""
    pattern: str = ""
    sure: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return self.pattern or self.host + self.path

    @property
    def regex(self) -> str:
        """Over host + path: no host holds a slash, and a path is empty or starts with one."""
        return self.pattern or rf"(?:[^/]*\.)?{re.escape(self.host)}(?=/|\Z){re.escape(self.path)}"

    @property
    def tokens(self) -> tuple[str, ...]:
        """Tokens that any fitting URL holds whole: host labels, and path tokens closed by a delimiter."""
        if self.pattern:
            return self.sure
        path = self.path[: len(self.path) - len(re.search(r"[A-Za-z0-9]*\Z", self.path)[0])]
        return tuple(TOKEN.findall(self.host.lower() + path.translate(UPPER_TO_LOWER)))


def split_url(url: str | None) -> tuple[str, str]:
    m = PARTS.search(url or "")
    return (m[1].translate(UPPER_TO_LOWER), m[2]) if m else ("", "")


def token_counts(urls: DataFrame, tokens: Iterable[str], url_col: str = "url") -> dict[str, int]:
    """How many times each of the rules' tokens occurs in all URLs (result bounded by the rules)."""
    words = urls.select(F.explode(F.split(F.lower(F.coalesce(F.col(url_col), F.lit(""))), "[^a-z0-9]+")).alias("w"))
    wanted = urls.sparkSession.createDataFrame([(t,) for t in sorted(set(tokens))], "w string")
    counted = words.join(F.broadcast(wanted), "w", "left_semi").groupBy("w").count()  # MAX_RULES rules hold the tokens
    return {r["w"]: r["count"] for r in counted.collect()}


def build_index(rules: list[Rule], counts: dict[str, int]) -> dict[str, list[int]]:
    """Rarest token -> places of the rules filed under it; "" holds rules without a sure token."""
    index: dict[str, list[int]] = {}
    for i, r in enumerate(rules):
        key = min(r.tokens, key=lambda t: (counts.get(t, 0), t), default="")
        index.setdefault(key, []).append(i)
    return index


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule (winning base rule or null), verdict, pattern (winning pattern or null), candidates.

    One small counting job for the index, then a shuffle-free pass over the URL column.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the list sent to each task holds at most {MAX_RULES}")
    index = build_index(rules, token_counts(pages, [t for r in rules for t in r.tokens], url_col))
    narrow = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"))
    kind = narrow.schema["id"].dataType.simpleString()

    def scan(batches):
        compiled: dict[int, re.Pattern] = {}  # of the rules that have been fetched

        def regex(i):
            if i not in compiled:
                compiled[i] = re.compile(rules[i].regex)
            return compiled[i]

        always = index.get("", [])
        for b in batches:
            out = []
            for url in b.column(1).to_pylist():
                host, path = split_url(url)
                whole = host + path
                # a label may hold letters outside a-z; the delimiters of tokens are the same on both sides
                candidates = set(always).union(*(index.get(t, ()) for t in set(
                    TOKEN.findall(whole.translate(UPPER_TO_LOWER)))))
                base, free = None, None
                for i in sorted(candidates):
                    r = rules[i]
                    if r.pattern:
                        if free is None and regex(i).search(whole):
                            free = r
                    elif (base is None or len(r.name) > len(base.name)) and regex(i).match(whole):
                        base = r
                won = base or free
                out.append((host, path, base and base.name, won.verdict if won else "allow",
                            free and not base and free.name or None, len(candidates)))
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.string()) for c in columns[:5]), pa.array(columns[5], pa.int32())],
                ["id", "host", "path", "rule", "verdict", "pattern", "candidates"])

    return narrow.mapInArrow(
        scan, f"id {kind}, host string, path string, rule string, verdict string, pattern string, candidates int"
    ).withColumnRenamed("id", id_col)


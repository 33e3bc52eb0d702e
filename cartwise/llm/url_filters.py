"""URL filters: host and path rules, then a weighted URL vocabulary matched by Aho-Corasick.

A rule names a host and a path prefix; it fits its host and all subdomains
when the url's path starts with the rule's path, and the longest fitting rule
decides. Without one, the vocabulary does: an automaton finds every term in
the lower-cased url, an occurrence counts only between borders (a neighbour
that is an ASCII letter or digit is none), and the url is blocked by one
strict term or by ``soft_needed`` distinct soft ones.

Defined results: a null url or one without ``://`` has empty host and path,
so no rule fits; a null url has no terms and is allowed. Repeated rows give
repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm.common import ship, table

ship(__name__)

#: Terms that reject alone, and terms of which several distinct ones reject.
STRICT = ("adult", "casino", "escort", "gambling", "malware", "phishing", "porn", "spam", "viagra", "warez", "xxx")
SOFT = ("ads", "bet", "bets", "cheap", "click", "farm", "free", "loan", "lottery", "pills", "poker", "promo", "slots",
        "track", "win")
SOFT_NEEDED = 2

#: (verdict, host, path) of the registered query's contract.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))

_ASCII_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
_INNER = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def split_url(url: str | None) -> tuple[str, str]:
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3:]
    stops = [i for i in map(rest.find, "/?#") if i >= 0]
    end = min(stops, default=len(rest))
    tail = rest[end:]
    stops = [i for i in map(tail.find, "?#") if i >= 0]
    return rest[:end].translate(_ASCII_LOWER), tail[:min(stops, default=len(tail))]


def by_length(rules: Iterable[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    return sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1])), reverse=True)


def fitting_rule(rules: list[tuple[str, str, str]], host: str, path: str):
    """The first (longest) of rules sorted by ``by_length`` that fits."""
    for rule in rules:
        if path.startswith(rule[2]) and (host == rule[1] or host.endswith("." + rule[1])):
            return rule
    return None


def automaton(strict: Iterable[str], soft: Iterable[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):
        for term in terms:
            found.add_word(term, (kind, term))
    found.make_automaton()
    return found


def term_hits(found: ahocorasick.Automaton, url: str | None) -> tuple[set[str], set[str]]:
    """Distinct strict and soft terms of a url that stand between borders."""
    hits: dict[str, set[str]] = {"strict": set(), "soft": set()}
    if url and len(found):
        text = url.translate(_ASCII_LOWER)
        for end, (kind, term) in found.iter(text):
            begin = end - len(term) + 1
            if (begin == 0 or text[begin - 1] not in _INNER) and (end + 1 == len(text) or text[end + 1] not in _INNER):
                hits[kind].add(term)
    return hits["strict"], hits["soft"]


def judge_urls(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, soft_needed: int = SOFT_NEEDED) -> DataFrame:
    """page_id, host, path, rule, verdict and the terms counted, one row for each row of ``pages``."""
    ordered = by_length(rules)
    strict, soft = tuple(strict), tuple(soft)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(strict, soft)
        for batch in batches:
            out = {k: [] for k in ("host", "path", "rule", "verdict", "n_strict", "n_soft")}
            for url in batch.column("url").to_pylist():
                host, path = split_url(url)
                rule = fitting_rule(ordered, host, path)
                hard, weak = term_hits(found, url)
                bad = bool(hard) or len(weak) >= soft_needed
                for k, v in zip(out, (host, path, rule and rule[1] + rule[2], rule[0] if rule else "block" if bad else "allow",
                                      len(hard), len(weak)), strict=True):
                    out[k].append(v)
            types = {"n_strict": pa.int32(), "n_soft": pa.int32()}
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), *(pa.array(v, types.get(k, pa.string())) for k, v in out.items())],
                                             names=["page_id", *out])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    return rows.mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string, n_strict int, n_soft int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def oracle() -> str:
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)

    def count(terms) -> str:
        return " + ".join(f"regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::INT" for t in terms)

    return f"""
WITH rules(verdict, host, path) AS (VALUES {rules}),
cut AS (
  SELECT row_number() OVER () AS n, page_id, url, coalesce({lower.format('url')}, '') AS low,
         CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT *, {lower.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut),
best AS (
  SELECT p.n, max_by(r, length(r.host) + length(r.path)) AS r FROM parts p JOIN rules r
  ON starts_with(p.path, r.path) AND (p.host = r.host OR ends_with(p.host, '.' || r.host)) GROUP BY p.n),
counted AS (SELECT *, {count(STRICT)} AS n_strict, {count(SOFT)} AS n_soft FROM parts)
SELECT page_id, c.host, c.path, b.r.host || b.r.path AS rule,
       coalesce(b.r.verdict, CASE WHEN n_strict > 0 OR n_soft >= {SOFT_NEEDED} THEN 'block' ELSE 'allow' END) AS verdict,
       n_strict::INT AS n_strict, n_soft::INT AS n_soft
FROM counted c LEFT JOIN best b USING (n)
"""

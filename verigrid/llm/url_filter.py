"""URL verdicts: host and path rules first, then a weighted vocabulary of terms.

Rules fit a host with all its subdomains and a path prefix; the longest one decides. Every other
url is judged by its terms: an Aho-Corasick automaton finds all of them in one pass, a hit counts
only between boundaries (no ASCII letter or digit beside it), and each different term counts once.
A strict term weighs as much as the limit, soft ones less, so one strict or several different soft
terms reject.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

LIMIT = 10
#: The terms and their weights.
STRICT = "porn xxx hentai escorts camgirls warez keygen malware phishing"
SOFT = {4: "casino poker betting gambling roulette jackpot", 5: "adult nude sexy erotic torrent crack viagra cialis"}
TERMS: dict[str, int] = {t: LIMIT for t in STRICT.split()} | {t: w for w, names in SOFT.items() for t in names.split()}


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


#: The rules of the registered query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def lower_ascii(column: Column) -> Column:
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path; both are empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    parts = r"(?s)^([^/?#]*)([^?#]*)"
    return lower_ascii(F.regexp_extract(rest, parts, 1)), F.regexp_extract(rest, parts, 2)


def decide(host: Column, path: Column, rules: Sequence[Rule], field: str) -> Column:
    """Text or verdict of the longest rule that fits, else null."""
    cases = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), r)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        cases = F.when(fits, F.lit(rule.verdict if field == "verdict" else rule.host + rule.path)).otherwise(cases)
    return cases


def term_weight(df: DataFrame, url: str, terms: Mapping[str, int], name: str) -> DataFrame:
    """Add the weight of the different terms of each url; a null url weighs 0.

    Terms are lower-case letters and digits; the url is lower-cased for A-Z only.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term in terms:
            automaton.add_word(term, term)
        automaton.make_automaton()
        beside = frozenset(string.ascii_lowercase + string.digits)
        lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

        def weight(text: str | None) -> int:
            text = (text or "").translate(lower)
            found = set()
            for end, term in automaton.iter(text):
                first = end - len(term) + 1
                if (first == 0 or text[first - 1] not in beside) and text[end + 1 : end + 2] not in beside:
                    found.add(term)
            return sum(terms[t] for t in found)

        for batch in batches:
            weights = [weight(u) for u in batch.column(url).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(weights, pa.int64())], [*batch.schema.names, name])

    return df.mapInArrow(judge, StructType([*df.schema.fields, StructField(name, LongType())]))


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule] = RULES, terms: Mapping[str, int] = TERMS, limit: int = LIMIT
) -> DataFrame:
    """``page_id``, ``url``, ``host``, ``path``, ``rule`` (null if none fits), ``weight``, ``verdict``.

    A row per page, repeated ones too; a null or malformed url has an empty host and path and is
    judged by its terms. Other columns are ignored; an empty table gives no rows.
    """
    found = term_weight(pages.select("page_id", "url"), "url", terms, "weight")
    host, path = host_and_path(F.col("url"))
    found = found.withColumns({"host": host, "path": path})
    rule, verdict = (decide(F.col("host"), F.col("path"), rules, x) for x in ("rule", "verdict"))
    own = F.when(F.col("weight") >= limit, F.lit("block")).otherwise(F.lit("allow"))
    return found.withColumns({"rule": rule, "verdict": F.coalesce(verdict, own)})

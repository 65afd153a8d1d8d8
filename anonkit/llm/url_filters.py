"""URL filter: rules by host and path first, else a weighted vocabulary.

An Aho-Corasick automaton finds all terms of the vocabulary in a lower-cased URL in one pass. A hit counts
only between boundaries: neither the character before nor the one after is a letter a-z or a digit. Each
distinct term counts once; one strict term, or several distinct soft terms, block the URL. A rule fits its
host and all subdomains if the path starts as the rule's does; the longest rule that fits decides and
overrides the vocabulary. All but the automaton are native expressions; there is no shuffle.

Defined cases: null URLs and those without ``://`` have empty host and path, so no rule fits them; null and
empty URLs have no hits and are allowed; repeated rows are judged alike; an empty table gives no rows;
other columns have no effect.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Terms that block by themselves, and terms of which several must meet.
STRICT = "porn porno pornhub xxx hentai camgirls sexcam milf bdsm escorts fetish nsfw pornstar xvideos".split()
SOFT = (
    "adult sex sexy nude naked erotic cam webcam dating escort girls hot casino poker betting gamble slots jackpot"
    " viagra cialis pills payday loan crack keygen warez torrent bonus"
).split()
BLOCKING_WEIGHT = 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (
    Rule("allow", "com"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def weights(strict: list[str] = STRICT, soft: list[str] = SOFT) -> dict[str, int]:
    """Strict terms weigh as much as blocks alone, soft ones 1; a term in both lists is strict."""
    return {term.translate(str.maketrans(_UPPER, _LOWER)): 1 for term in soft} | {
        term.translate(str.maketrans(_UPPER, _LOWER)): BLOCKING_WEIGHT for term in strict
    }


def weight_column(url: Column | str, vocabulary: dict[str, int]) -> Column:
    """Sum of the weights of the distinct terms that stand between boundaries; null is 0."""

    @F.arrow_udf("int")
    def weigh(urls: pa.Array) -> pa.Array:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term, weight in vocabulary.items():
            automaton.add_word(term, (term, weight))
        automaton.make_automaton()
        fold = str.maketrans(_UPPER, _LOWER)
        inside = set(_LOWER + "0123456789")

        def total(url: str | None) -> int:
            if not url:
                return 0
            text, found = f" {url.translate(fold)} ", {}
            for end, (term, weight) in automaton.iter(text):
                if text[end - len(term)] not in inside and text[end + 1] not in inside:
                    found[term] = weight
            return sum(found.values())

        return pa.array([total(u) for u in urls.to_pylist()], pa.int32())

    return weigh(url) if vocabulary else F.lit(0)


def host_column(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_column(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _first_fit(host: Column, path: Column, rules: tuple[Rule, ...], value: str) -> Column:
    """``value`` of the longest rule that fits, null if none does; the rules' number is small and fixed."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, value))).otherwise(found)
    return found


def judge_urls(
    pages: DataFrame, key: str, url: str, *, rules: tuple[Rule, ...] = RULES, vocabulary: dict[str, int] | None = None
) -> DataFrame:
    """``key``, host, path, rule, verdict, and the weight of the vocabulary's hits."""
    weight = weight_column(F.col(url), weights() if vocabulary is None else vocabulary)
    host, path = host_column(F.col(url)), path_column(F.col(url))
    return pages.select(
        F.col(key),
        host.alias("host"),
        path.alias("path"),
        _first_fit(host, path, rules, "name").alias("rule"),
        F.coalesce(
            _first_fit(host, path, rules, "verdict"), F.when(weight >= BLOCKING_WEIGHT, "block").otherwise("allow")
        ).alias("verdict"),
        weight.alias("weight"),
    )


def oracle_sql() -> str:
    """The contract's columns in DuckDB: rules as CASE branches, each term as a pattern of its own."""

    def literal(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def branches(value: str) -> str:
        longest_first = sorted(RULES, key=lambda r: (-len(r.name), r.name))
        return " ".join(
            f"WHEN (host = {literal(r.host)} OR ends_with(host, {literal('.' + r.host)}))"
            f" AND starts_with(path, {literal(r.path)}) THEN {literal(getattr(r, value))}"
            for r in longest_first
        )

    hits = " + ".join(
        f"{w} * regexp_matches(low, '(^|[^a-z0-9]){term}($|[^a-z0-9])')::INT" for term, w in weights().items()
    )
    return f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS low,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
)
SELECT page_id, host, path, CASE {branches("name")} END AS rule,
  coalesce(CASE {branches("verdict")} END,
    CASE WHEN {hits} >= {BLOCKING_WEIGHT} THEN 'block' ELSE 'allow' END) AS verdict
FROM parts
"""

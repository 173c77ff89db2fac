"""URL filters: pattern rules, indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` of a URL with the literal tokens that any
match contains. It is filed under the one token that the given URLs hold least often. A URL's
tokens fetch its candidate rules, and only those run their expressions. Everything is DataFrame
functions: the index is a map literal, so a URL is judged within its row and nothing is shuffled
but the token counts. A rule list beyond ``MAP_RULES`` is a table joined by token instead.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from
there up to ``?``, ``#`` or the end. Cases: NULL or no ``://`` gives empty host and path, no rule
and the default verdict; an empty table no rows; repeated rows are judged alike; other columns
stay, and the result's four columns replace columns of the same names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules held as a literal in the plan; more are joined.
MAP_RULES = 2_000
_TOKEN = "[^0-9a-z]+"
_RESULT = ("host", "path", "rule", "verdict")


@dataclass(frozen=True)
class Rule:
    """``tokens``: literals found, between non-alphanumeric bytes, in whatever ``pattern`` matches.
    ``rank``: of the rules that fit, the highest wins."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int
    listed: bool = True


def place_rule(verdict: str, place: str) -> Rule:
    """A host with its subdomains and a path prefix, written ``example.org/es/``; longest wins."""
    host, _, path = place.partition("/")
    path = "/" + path
    whole = path[: path.rfind("/") + 1]  # a last segment without a slash may go on in the URL
    tokens = tuple(t for t in re.split(_TOKEN, f"{host}{whole}".lower()) if t)
    quoted = re.sub(r"([^0-9A-Za-z])", r"\\\1", f"{host}{path}")
    return Rule(place, verdict, rf"(?s)\A(?:[^/]*\.)?{quoted}", tokens, 1_000 + len(place))


def word_rule(verdict: str, word: str) -> Rule:
    """A word anywhere in host or path; below every place rule, and not named in the result."""
    return Rule(word, verdict, rf"(?s)(?i)(?:\A|[^0-9a-z]){word}(?:[^0-9a-z]|\z)", (word,), 1, listed=False)


#: Words of the default method where no place rule fits; all else is allowed.
DEFAULT_WORDS = ("adult", "casino", "gambling", "porn", "warez", "xxx")


def url_parts(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), upper, lower)
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def _tokens() -> Column:
    return F.array_distinct(F.split(F.lower(F.concat("host", "path")), _TOKEN))


def _file_rules(urls: DataFrame, rules: list[Rule]) -> dict[str, list[Rule]]:
    """Rules under their rarest token; the counts are over all URLs, of the rules' tokens only."""
    wanted = sorted({t for r in rules for t in r.tokens})
    counted = (
        urls.select(F.explode(_tokens()).alias("token"))
        .join(F.broadcast(urls.sparkSession.createDataFrame([(t,) for t in wanted], "token string")), "token")
        .groupBy("token").count()
    )
    counts = {r["token"]: r["count"] for r in counted.collect()}  # as many rows as the rules have tokens
    filed: dict[str, list[Rule]] = {}
    for rule in rules:
        filed.setdefault(min(rule.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(rule)
    return filed


def _struct(rule: Rule) -> Column:
    return F.struct(
        F.lit(rule.rank).alias("rank"), F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"),
        F.lit(rule.pattern).alias("pattern"), F.lit(rule.listed).alias("listed"),
    )


def _by_map(urls: DataFrame, filed: dict[str, list[Rule]]) -> DataFrame:
    index = F.create_map(*(
        c for token, rules in sorted(filed.items()) for c in (F.lit(token), F.array(*map(_struct, rules)))
    ))
    place = F.concat("host", "path")
    found = F.flatten(F.transform(F.filter(_tokens(), lambda t: F.map_contains_key(index, t)), lambda t: index[t]))
    fits = F.filter(found, lambda r: F.call_function("regexp_like", place, r["pattern"]))
    return urls.withColumn("__best", F.array_max(fits))


def _by_join(urls: DataFrame, filed: dict[str, list[Rule]]) -> DataFrame:
    """One row per distinct (host, path) meets the rule table; Spark picks the join by its size."""
    spark = urls.sparkSession
    table = spark.createDataFrame(
        [(t, r.rank, r.name, r.verdict, r.pattern, r.listed) for t, rules in filed.items() for r in rules],
        "token string, rank int, name string, verdict string, pattern string, listed boolean",
    )
    places = urls.select("host", "path").distinct()
    best = (
        places.withColumn("token", F.explode(_tokens())).join(table, "token")
        .filter(F.call_function("regexp_like", F.concat("host", "path"), F.col("pattern")))
        .groupBy("host", "path").agg(F.max(F.struct("rank", "name", "verdict", "pattern", "listed")).alias("__best"))
    )
    return urls.join(best, ["host", "path"], "left")


def filter_urls(pages: DataFrame, rules: list[Rule], default: str = "allow", map_rules: int = MAP_RULES) -> DataFrame:
    """``pages`` with host, path, the winning rule's name (NULL if none is listed) and the verdict."""
    if not rules or any(not r.tokens for r in rules):
        raise ValueError("every rule needs a literal token")
    host, path = url_parts(F.col("url"))
    urls = pages.drop(*(c for c in _RESULT if c != "url")).withColumns({"host": host, "path": path})
    filed = _file_rules(urls.select("host", "path"), rules)
    judged = (_by_map if len(rules) <= map_rules else _by_join)(urls, filed)
    best = F.col("__best")
    return judged.withColumns({
        "rule": F.when(best["listed"], best["name"]),
        "verdict": F.coalesce(best["verdict"], F.lit(default)),
    }).drop("__best")

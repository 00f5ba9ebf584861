"""Url rules, found by their rarest literal token.

A rule is a regular expression over host and path, with the literal tokens that
every match holds as whole tokens. The rule is filed under the one of them that
the fewest urls have. A url's tokens fetch the rules filed under them, and only
those run. Rules that have no such token run on every url.

Urls are judged once per different host and path, so repeated ones cost
nothing. The rules are a list in the driver, and so is their number; whether
they are broadcast is left to Spark, which knows their size.

A null url, or one without ``://``, has an empty host and path.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = "[A-Za-z0-9]+"


@dataclass(frozen=True)
class UrlRule:
    """Among the rules that fit a url the highest ``rank`` decides, then the greatest name."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int = 0


def prefix_rule(spec: str, verdict: str, rank: int | None = None) -> UrlRule:
    """``host/path``: fits the host and its subdomains where the path starts with the rule's.

    A longer rule ranks higher, unless told otherwise.
    """
    host, slash, path = spec.partition("/")
    tokens = re.findall(_TOKEN, spec)
    if re.search(_TOKEN + "$", spec):  # a url's token may go on where the rule ends
        tokens = tokens[:-1]
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path)}"
    return UrlRule(spec, verdict, pattern, tuple(tokens), len(spec) if rank is None else rank)


def host_word_rule(word: str, verdict: str = "block", rank: int = 0) -> UrlRule:
    """Fits hosts with a label that has ``word`` between its dashes."""
    return UrlRule(f"*{word}*", verdict, rf"^(?:[^/]*[.-])?{re.escape(word)}(?:[.-]|/|$)", (word,), rank)


# Words that hosts of gambling, pill, advert, adult and spam sites carry.
COMMON_BLOCKS = tuple(host_word_rule(w) for w in ("ads", "adult", "bets", "casino", "pills", "spam"))


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _tokens(address: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(address, F.lit(f"({_TOKEN})"), 1))


def token_counts(addresses: DataFrame, rules: list[UrlRule]) -> dict[str, int]:
    """How many addresses hold each token of the rules."""
    wanted = addresses.sparkSession.createDataFrame([(t,) for r in rules for t in r.tokens], "token string").distinct()
    held = addresses.select(F.explode(_tokens(F.col("address"))).alias("token")).join(wanted, "token", "left_semi")
    return {r["token"]: r["count"] for r in held.groupBy("token").count().collect()}


def judged(pages: DataFrame, rules: list[UrlRule], url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null if none fits), ``rank`` and ``verdict``.

    Columns of these names are replaced.
    """
    spark = pages.sparkSession
    if len({r.name for r in rules}) < len(rules):
        raise ValueError("rules must have different names")
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "rank", "verdict")]
    rows = pages.select(*kept, host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    different = rows.select("host", "path").distinct().withColumn("address", F.concat("host", "path"))
    seen = token_counts(different, rules) if any(r.tokens for r in rules) else {}
    filed = [(min(r.tokens, key=lambda t: (seen.get(t, 0), t)) if r.tokens else "", r.name, r.verdict, r.pattern, r.rank)
             for r in rules]
    index = spark.createDataFrame(filed, "token string, rule string, verdict string, pattern string, rank int")
    # The empty token stands for rules that run everywhere.
    looked_up = different.withColumn("token", F.explode(F.array_append(_tokens(F.col("address")), "")))
    fits = looked_up.join(index, "token").where(F.regexp_like("address", F.col("pattern")))
    best = fits.groupBy("host", "path").agg(F.max(F.struct("rank", "rule", "verdict")).alias("_best"))
    return rows.join(best, ["host", "path"], "left").select(
        *kept, "host", "path", F.col("_best.rule").alias("rule"), F.col("_best.rank").alias("rank"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))

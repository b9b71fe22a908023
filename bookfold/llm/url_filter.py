"""URL rules looked up by their rarest literal token; only fetched rules run their regular expression.

Every rule is a regular expression over ``host + path`` with a set of literal tokens (alphanumeric runs that
must be whole tokens of any matching URL). Each rule is filed under the one of its tokens that fewest distinct
URLs hold. The tokens of a URL fetch candidate rules in an equi join, and only those candidates run ``rlike``.

DataFrame functions only. Verdicts are found per distinct URL and joined back, so repeated rows cost one match.

Edge cases: a null or malformed URL (no ``://``) has empty host and path, matches no rule and gets the default
verdict. Empty tables give empty results. Rows repeat in the result as often as in the input. Other columns of
the input play no part, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookfold.llm.common import only, stored

ALLOW, BLOCK = "allow", "block"
_TOKEN_SPLIT = "[^a-z0-9]+"


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` must only match URLs that hold every one of ``tokens``. The highest priority decides."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    priority: int
    explicit: bool


def path_rule(name: str, verdict: str) -> UrlRule:
    """``host/path``: the host and all its subdomains, paths that start with the rule's. Longer rules win."""
    host, slash, path = name.partition("/")
    pattern = rf"^([^/]*\.)?{re.escape(host.lower())}{re.escape(slash + path)}"
    # The path's last token may go on in the URL, so only what is closed by a separator is a whole token.
    closed = path.rsplit("/", 1)[0] if "/" in path else ""
    tokens = tuple(t for t in re.split(_TOKEN_SPLIT, f"{host}/{closed}".lower()) if t)
    return UrlRule(name, verdict, pattern, tokens, 1000 + len(name), True)


def host_rule(label: str) -> UrlRule:
    """Blocks hosts with the given label (``free-bets`` fits ``www.free-bets.example.com``)."""
    pattern = rf"^([^/]*\.)?{re.escape(label)}\."
    return UrlRule(f"host:{label}", BLOCK, pattern, tuple(re.split(_TOKEN_SPLIT, label)), len(label), False)


def words_rule(*words: str) -> UrlRule:
    """Blocks hosts in which the words follow each other, parted by anything but letters and digits."""
    body = "[^a-z0-9/]+".join(map(re.escape, words))
    return UrlRule(f"words:{'-'.join(words)}", BLOCK, rf"^([^/]*[^a-z0-9/])?{body}([^a-z0-9]|$)", tuple(words), 1, False)


#: The rules asked for, and the method's own block list for hosts that no such rule covers.
PATH_RULES = (
    path_rule("net/", BLOCK),
    path_rule("example.net/en/", ALLOW),
    path_rule("example.com/de/", BLOCK),
    path_rule("org/fr/", ALLOW),
)
BLOCK_LIST = (
    host_rule("cheap-pills"),
    host_rule("casino-win"),
    host_rule("free-bets"),
    host_rule("spam-farm"),
    host_rule("ads-track"),
    words_rule("adult"),
    words_rule("xxx"),
    words_rule("porn"),
    words_rule("casino"),
    words_rule("pills"),
    words_rule("bets"),
    words_rule("spam"),
    words_rule("doubleclick"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(text: Column) -> Column:
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.filter(F.split(lower, _TOKEN_SPLIT), lambda t: t != ""))


def judge_urls(pages: DataFrame, rules: Sequence[UrlRule], id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """Columns id, url, host, path, rule (deciding explicit rule or null), matched (any rule) and verdict."""
    spark = pages.sparkSession
    rows = only(pages, page_id=id_column, url=url_column)
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    if not rules:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("matched"), F.lit(ALLOW).alias("verdict"))
    table = spark.createDataFrame(
        [(r.name, r.verdict, r.pattern, list(r.tokens), r.priority, r.explicit) for r in rules],
        "name string, decides string, pattern string, tokens array<string>, priority int, explicit boolean",
    )
    # Copies of a site's URL fall together before anything is exploded.
    sites = rows.filter(F.col("host") != "").groupBy("host", "path").agg(F.count("*").alias("n"))
    url_tokens = sites.select("host", "path", F.explode(_tokens(F.concat("host", "path"))).alias("token"))

    held = url_tokens.groupBy("token").agg(F.count("*").alias("n_urls"))
    rule_tokens = table.select("*", F.explode("tokens").alias("token"))
    weighed = rule_tokens.join(held, "token", "left").withColumn("n_urls", F.coalesce("n_urls", F.lit(0)))
    filed = weighed.groupBy("name").agg(
        F.min_by("token", F.struct("n_urls", "token")).alias("token"),
        *[F.first(c).alias(c) for c in ("decides", "pattern", "priority", "explicit")],
    )

    fetched = url_tokens.join(filed, "token")
    fitting = fetched.filter(F.expr("concat(host, path) rlike pattern"))
    # The highest priority wins; of equals, blocking and then the first name.
    order = F.struct((-F.col("priority")).alias("last"), (F.col("decides") != BLOCK).alias("allows"), "name")
    best = fitting.groupBy("host", "path").agg(F.min_by(F.struct("name", "decides", "explicit"), order).alias("best"))
    # Written out, so that the join has a plain shuffle on both sides and AQE splits a URL that many rows repeat. Never
    # broadcast: it grows with the pages, and its files are many times smaller than its rows. Rows without a host,
    # however many, need no join.
    best = stored(best, "judged-urls").hint("merge")
    hosted = rows.filter(F.col("host") != "").join(best, ["host", "path"], "left")
    judged = hosted.unionByName(rows.filter(F.col("host") == "").withColumn("best", F.lit(None).cast(best.schema["best"].dataType)))
    return judged.select(
        "page_id",
        "url",
        "host",
        "path",
        F.when(F.col("best.explicit"), F.col("best.name")).alias("rule"),
        F.col("best.name").alias("matched"),
        F.coalesce("best.decides", F.lit(ALLOW)).alias("verdict"),
    )

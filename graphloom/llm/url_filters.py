"""URL filters: pattern rules indexed by their rarest literal token.

A rule is found by the one of its tokens that the fewest different addresses contain; only rules fetched by a
token of an address have their regular expression tried on it. Built-in functions only.

The host is what follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; the path is what
follows up to `?`, `#` or the end. A null address, or one without `://`, has an empty host and path, which
only rules without tokens can match. Of several matching rules the longest wins, then the last in the order of
names, then `block`. Each row of the input gives one row, repeated rows too. Columns of the input that are named
like an output are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.registry import query

OUTPUTS = ("host", "path", "rule", "verdict")


@dataclass(frozen=True)
class UrlRule:
    """A verdict on the addresses that `pattern` finds in `host + path`. `tokens` are host labels
    (`h:example`) and whole path segments (`p:en`) that every such address has; without any, the rule is tried on all."""

    rule: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...] = ()


def site_rule(verdict: str, host: str, path: str = "/") -> UrlRule:
    """A host with its subdomains, and the paths that start with `path`."""
    whole = path.split("/")[1:-1]  # what follows the last slash may go on
    tokens = {f"h:{label}" for label in host.split(".")} | {f"p:{segment}" for segment in whole if segment}
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    return UrlRule(host + path, verdict, pattern, tuple(sorted(tokens)))


def rules_frame(spark: SparkSession, rules: Iterable[UrlRule]) -> DataFrame:
    """Rules as a table, whose size Spark knows; a long list is better read from a file of the same columns."""
    rows = [
        F.struct(
            F.lit(r.rule).alias("rule"),
            F.lit(r.verdict).alias("verdict"),
            F.lit(r.pattern).alias("pattern"),
            F.array(*[F.lit(t) for t in r.tokens]).cast("array<string>").alias("tokens"),
        )
        for r in rules
    ]
    kind = "array<struct<rule:string,verdict:string,pattern:string,tokens:array<string>>>"
    return spark.range(1).select(F.inline(F.array(*rows).cast(kind)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    start = F.locate("://", url)
    rest = F.when(start > 0, F.substr(url, start + 3))
    host = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _tokens(host: Column, path: Column) -> Column:
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    segments = F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(labels, segments, F.array(F.lit(""))))


def rarest_tokens(rules: DataFrame, addresses: DataFrame) -> DataFrame:
    """`rules` with `token`, the one of its tokens that the fewest `addresses` (host, path) have."""
    named = rules.select("rule", "verdict", "pattern", F.explode_outer("tokens").alias("token"))
    named = named.withColumn("token", F.coalesce("token", F.lit("")))
    met = addresses.select(F.explode(_tokens(F.col("host"), F.col("path"))).alias("token"))
    counts = met.join(named.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    ranked = named.join(counts, "token", "left").select(
        "rule", "verdict", "pattern", F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token").alias("ranked")
    )
    return ranked.groupBy("rule", "verdict", "pattern").agg(F.min("ranked").alias("r")).select("rule", "verdict", "pattern", "r.token")


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow") -> DataFrame:
    """`pages` with `host`, `path`, `rule` (null without one) and `verdict` (`otherwise` without a rule).

    Different addresses are judged once, so that an address on many rows costs one, and are joined back to
    the rows; both joins leave rows of a frequent key on a side that adaptive execution can split.
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c.lower() not in OUTPUTS], host.alias("host"), path.alias("path"))
    addresses = rows.select("host", "path").distinct()
    index = rarest_tokens(rules, addresses)
    fetched = addresses.select("host", "path", F.explode(_tokens(F.col("host"), F.col("path"))).alias("token")).join(index, "token")
    found = (
        fetched.where(F.rlike(F.concat("host", "path"), F.col("pattern")))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("long"), "rule", "verdict")).alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    return rows.join(found, ["host", "path"], "left").select(
        *[F.col(f"`{c}`") for c in rows.columns], "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict")
    )


# The rules that the query applies.
_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

_FITS = "(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
_CASES = "\n".join(
    f"    WHEN {_FITS.format(h=h, p=p)} THEN {{'rule': '{h}{p}', 'verdict': '{v}'}}"
    for v, h, p in sorted(_RULES, key=lambda r: -len(r[1] + r[2]))
)
_SQL = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), judged AS (
  SELECT page_id, host, path, CASE
{_CASES}
    ELSE {{'rule': NULL, 'verdict': 'allow'}} END AS j FROM parts
)
SELECT page_id, host, path, j.rule AS rule, j.verdict AS verdict FROM judged
"""


@query("op1_url_filters", _SQL)
def op1_url_filters(spark, folder):
    """A verdict on the address of every page."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    rules = rules_frame(spark, [site_rule(*r) for r in _RULES])
    return filter_urls(pages, rules).select("page_id", *OUTPUTS)

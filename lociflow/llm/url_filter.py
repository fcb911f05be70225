"""URL filters: rules indexed by their rarest literal token.

A URL's tokens (runs of a-z and 0-9 of its lower-cased host and path) fetch the rules filed under them, and only those
rules run their regular expression. DataFrame functions only.

Defined results: a null url, or one without "://", has an empty host and path and fits no rule; null or repeated page_ids
keep a row each; an empty table gives an empty result; columns of the input named like a result are not read. Of fitting
rules a host rule beats a pattern rule, then the longest wins, then the smaller name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociflow.llm.common import LOWER, UPPER

TOKEN = r"[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """A rule over host + path. `pattern` is a regular expression; `literal` is text that any match holds between
    characters that aren't letters or digits, from which its tokens come."""

    name: str
    verdict: str
    pattern: str
    literal: str
    is_host: bool

    def tokens(self) -> list[str]:
        return sorted(set(re.findall(TOKEN, self.literal.lower()))) or [""]


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits the host and all its subdomains, where the path starts with `path`."""
    whole = path.rpartition("/")[0]  # what follows the last slash may be the start of a longer token
    edge = "" if path else "(?:/|$)"
    return Rule(host + path, verdict, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}{edge}", f"{host}{whole}", True)


def label_rule(start: str, verdict: str) -> Rule:
    """Fits hosts with a label, or labels, that read `start` up to its closing dot."""
    return Rule(f"||{start}", verdict, rf"^(?:[^/]*\.)?{re.escape(start)}", start, False)


def segment_rule(segment: str, verdict: str) -> Rule:
    """Fits paths with this segment between slashes."""
    return Rule(f"/{segment}/", verdict, rf"/{re.escape(segment)}/", segment, False)


# The contract's rules, and the patterns that judge what they leave.
HOST_RULES = (
    host_rule("net", "/", "block"),
    host_rule("example.net", "/en/", "allow"),
    host_rule("example.com", "/de/", "block"),
    host_rule("org", "/fr/", "allow"),
)
PATTERN_RULES = (
    label_rule("spam-farm.", "block"),
    label_rule("ads.", "block"),
    label_rule("adserver.", "block"),
    label_rule("tracker.", "block"),
    segment_rule("casino", "block"),
    segment_rule("phishing", "block"),
    segment_rule("wp-login", "block"),
)


def rule_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    """One row per rule and literal token. Large lists can be kept as a table of the same columns."""
    rows = [
        F.struct(*(F.lit(v).alias(k) for k, v in {"rule": r.name, "rule_verdict": r.verdict, "pattern": r.pattern, "is_host": r.is_host, "rule_length": len(r.name), "token": t}.items()))
        for r in rules
        for t in r.tokens()
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def split_url(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise(F.lit(""))
    return (
        pages.withColumn("_rest", F.coalesce(rest, F.lit("")))
        .withColumn("host", F.translate(F.regexp_extract("_rest", r"^([^/?#]*)", 1), UPPER, LOWER))
        .withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1))
        .drop("_rest")
    )


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of `pages`(page_id, url)."""
    urls = split_url(pages.select("url").where(F.col("url").isNotNull()).distinct())
    urls = urls.select("url", F.concat("host", "path").alias("target"))
    tokens = F.array_append(F.filter(F.split(F.translate("target", UPPER, LOWER), "[^a-z0-9]+"), lambda t: t != ""), F.lit(""))
    spread = urls.select("url", "target", F.explode(F.array_distinct(tokens)).alias("token"))

    # Rarity: in how many URLs each of the rules' tokens occurs; a token of no URL is the rarest of all.
    seen = spread.join(rules.select("token").distinct(), "token").groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    by_rarity = Window.partitionBy("rule", "rule_verdict", "pattern").orderBy(F.coalesce("urls", F.lit(0)), "token")
    index = rules.join(seen, "token", "left").withColumn("_n", F.row_number().over(by_rarity)).where("_n = 1").drop("_n", "urls")

    fits = spread.join(index, "token").where(F.rlike(F.col("target"), F.col("pattern")))
    order = F.struct("is_host", "rule_length", F.col("rule"), "rule_verdict")
    best = fits.groupBy("url").agg(F.max(order).alias("best"))
    # The key is spelt anew so that both sides are dealt out for this join, and a hot url can be split.
    best = best.select(F.concat(F.lit("u"), "url").alias("_key"), "best")
    judged = split_url(pages.select("page_id", "url")).withColumn("_key", F.concat(F.lit("u"), "url")).join(best, "_key", "left")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.when(F.col("best.is_host"), F.col("best.rule")).alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
        F.when(~F.col("best.is_host"), F.col("best.rule")).alias("pattern_rule"),
    )

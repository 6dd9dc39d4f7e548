"""URL filter: host and path rules first, then a logistic regression on hashed character n-grams of host and path.

DataFrame functions only.  The regression is trained from a small labelled URL table and scored as a sum of weights
looked up by n-gram hash, inside the scan: no shuffle, no Python.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and is judged by the
regression's intercept; repeated rows are judged alike; if the labelled table lacks one of the labels, every url that no
rule decides gets ``default``; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txrisk.llm.linear import doubles, fit, let

#: Hash places, n-gram lengths, and the most rows of the labelled table that are used (those of the smallest hashes).
PLACES, LENGTHS, MOST_LABELLED = 2048, (3, 4), 4000


@dataclass(frozen=True)
class Rule:
    """``host/path`` prefix: fits the host and its subdomains if the url's path starts with the rule's."""

    verdict: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        own, slash, rest = self.text.partition("/")
        return ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)


#: Rules of the registered query (fixed values).
RULES = [Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"),
         Rule("allow", "com/fr/"), Rule("block", "com/de/")]


#: The labelled URL table of the registered query: what the host promises decides, paths look alike (fixed values).
BLOCKED_HOSTS = """
ad-clicks.example.net ads-server.example.com adult-movies.example.net best-casino.example.com bet-now.example.net big-jackpot.example.com bitcoin-double.example.net
casino-bonus.example.com casino-royal.example.net cheap-meds.example.com cheap-pills.example.net crack-serials.example.com
easy-loans.example.net escort-girls.example.com fast-cash.example.net free-bets.example.net free-casino.example.com
free-followers.example.net free-porn.example.com hot-dates.example.net link-farm.example.com lottery-win.example.net
online-poker.example.com payday-loan.example.net pills-shop.example.com poker-win.example.net replica-watches.example.com
seo-farm.example.net sex-chat.example.com slots-win.example.net spam-links.example.com spam-site.example.net
sports-bets.example.com viagra-online.example.net warez-download.example.com win-prizes.example.net xxx-videos.example.com
""".split()
ALLOWED_HOSTS = """
archive.example.com blog.example.net books.example.com city-library.example.net code.example.com cooking.example.net
courses.example.com data.example.net docs.example.com encyclopedia.example.net forum.example.com garden.example.net
health.example.com history.example.net journal.example.com law.example.net m.example.com maps.example.net
mathematics.example.com museum.example.net music.example.com nature.example.net news.example.com papers.example.net
physics.example.com radio.example.net recipes.example.com research.example.net school.example.com science.example.net
theatre.example.com travel.example.net university.example.com weather.example.net wiki.example.com
""".split()
PATHS = ("/en/12", "/fr/345", "/de/67.html", "/es/8901/")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, verdict) of the labelled hosts."""
    return spark.createDataFrame([(f"https://{host}{path}", verdict) for verdict, hosts in (("block", BLOCKED_HOSTS), ("allow", ALLOWED_HOSTS))
                                  for host in hosts for path in PATHS], "url string, verdict string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def rule_of(rules: list[Rule], host: Column, path: Column, value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        out = F.when(rule.fits(host, path), F.lit(value(rule))).otherwise(out)
    return out


def _grams(text: Column, kind: int, length: int) -> Column:
    """Hash places of the character n-grams of ``text`` with its two ends marked."""
    chars = F.filter(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""), lambda c: c != "")

    def of(c: Column) -> Column:
        starts = F.when(F.size(c) >= length, F.sequence(F.lit(0), F.size(c) - length)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.pmod(
            F.xxhash64(F.lit(kind), F.concat(*(F.get(c, i + k) for k in range(length)))), F.lit(PLACES)).cast("int"))

    return let(chars, of)


def features(host: Column, path: Column) -> Column:
    return F.concat(*(_grams(text, kind, n) for kind, text in enumerate((host, path)) for n in LENGTHS))


def train(labelled: DataFrame, most: int = MOST_LABELLED) -> tuple[list[float], float] | None:
    """Weights by hash place and intercept, from (url, verdict); None if a verdict is missing."""
    host, path = host_and_path(F.col("url"))
    rows = (labelled.filter(F.col("verdict").isin("allow", "block")).select("url", "verdict").distinct()
            .orderBy(F.xxhash64("url"), "url", "verdict").limit(most)
            .select(F.transform(features(host, path), lambda i: i.cast("string")).alias("features"),
                    (F.col("verdict") == "block").cast("double").alias("label"), F.lit(1.0).alias("weight")))
    rows = rows.cache()
    try:
        if rows.select("label").distinct().count() < 2:
            return None
        weights, intercepts = fit(labelled.sparkSession, rows, [str(i) for i in range(PLACES)], 2, 0.01, 0.0, 50)
    finally:
        rows.unpersist()
    return weights[0], intercepts[0]


def judge(pages: DataFrame, rules: list[Rule], model: tuple[list[float], float] | None, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict, score); score is the regression's probability of ``block``."""
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    if model is None:
        score, own = F.lit(None).cast("double"), F.lit(default)
    else:
        weights = doubles(model[0])
        total = F.aggregate(features(F.col("host"), F.col("path")), F.lit(model[1]), lambda a, i: a + F.get(weights, i))
        score = 1 / (1 + F.exp(-total))
        own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    rule = rule_of(rules, F.col("host"), F.col("path"), lambda r: r.text)
    verdict = F.coalesce(rule_of(rules, F.col("host"), F.col("path"), lambda r: r.verdict), own)
    return (split.withColumn("score", score).withColumn("rule", rule).withColumn("verdict", verdict)
            .select("page_id", "host", "path", "rule", "verdict", "score"))

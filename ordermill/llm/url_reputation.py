"""URL filters: listed rules first, then an empirical-Bayes reputation of the host.

Outcomes of labelled pages (1: blocked, 0: allowed) are counted by host, by
registered domain and by suffix. Each level's rate is shrunk to its parent's
with a beta-binomial prior whose strength is fitted by moments to the spread
between the siblings. A host is blocked if the lower bound of its posterior
rate is above a limit. Everything is column expressions and aggregates; pages are read
twice, for the counts of their hosts, which are written, and to be judged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import Scratch

# The listed rules.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

# Suffixes of two labels, under which a registered domain has three.
TWO_LABEL_SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp", "ac.jp",
    "co.kr", "com.br", "com.mx", "com.ar", "com.cn", "com.tr", "co.in", "co.za", "com.ng", "org.ng", "gov.ng",
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Reputation:
    """``z``: how many standard deviations the bound lies below the mean; ``limit``: block above it."""

    z: float = 1.645
    limit: float = 0.5
    least_spread: float = 0.01
    most_spread: float = 0.99


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty without ``://`` or for null."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; nulls if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


def levels(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix: the last two labels and the last, one more each under a suffix of two labels."""
    two = F.substring_index(host, ".", -2)
    long = two.isin(*TWO_LABEL_SUFFIXES)
    return F.when(long, F.substring_index(host, ".", -3)).otherwise(two), F.when(long, two).otherwise(F.substring_index(host, ".", -1))


def _spread(groups: DataFrame, settings: Reputation) -> float:
    """Moment estimate of the intra-class correlation; ``groups`` has n, bad and the parent's rate ``prior``."""
    p = F.col("bad") / F.col("n")
    noise = F.col("prior") * (1 - F.col("prior"))
    row = groups.agg(
        F.sum(F.col("n") * (p - F.col("prior")) ** 2).alias("seen"),
        F.sum(noise).alias("noise"),
        F.sum(noise * (F.col("n") - 1)).alias("scale"),
    ).first()
    if row.seen is None or not row.scale:
        return settings.most_spread
    return min(max((row.seen - row.noise) / row.scale, settings.least_spread), settings.most_spread)


def host_reputation(outcomes: DataFrame, settings: Reputation = Reputation()) -> dict[str, DataFrame | float]:
    """The hierarchy fitted to ``outcomes`` (host, bad 0/1), see :func:`fit`."""
    known = outcomes.where(F.col("host").isNotNull() & F.col("bad").isNotNull())
    counts = known.groupBy("host").agg(F.count("*").cast("double").alias("n"), F.sum("bad").cast("double").alias("bad"))
    return fit(Scratch(outcomes.sparkSession, "url-hosts").keep(counts), settings)


def fit(counts: DataFrame, settings: Reputation = Reputation()) -> dict[str, DataFrame | float]:
    """Fit the hierarchy to a written table of hosts with their outcomes (host, n, bad).

    Returns shrunk rates by host, domain and suffix, the overall rate, and the
    strength of a host's prior. Only four single rows of sums reach the driver.
    """
    domain, suffix = levels(F.col("host"))
    hosts = counts.withColumns({"domain": domain, "suffix": suffix})
    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = hosts.agg(*sums).first()
    overall = ((total.bad or 0.0) + 0.5) / ((total.n or 0.0) + 1.0)

    def shrunk(groups: DataFrame) -> tuple[DataFrame, float]:
        strength = 1.0 / _spread(groups, settings) - 1.0
        alpha = F.col("bad") + strength * F.col("prior")
        beta = F.col("n") - F.col("bad") + strength * (1 - F.col("prior"))
        return groups.withColumns({"alpha": alpha, "beta": beta, "rate": alpha / (alpha + beta)}), strength

    suffixes, _ = shrunk(hosts.groupBy("suffix").agg(*sums).withColumn("prior", F.lit(overall)))
    parent = suffixes.select("suffix", F.col("rate").alias("prior"))
    domains, _ = shrunk(hosts.groupBy("suffix", "domain").agg(*sums).join(parent, "suffix"))
    parent = domains.select("domain", F.col("rate").alias("prior"))
    by_host, strength = shrunk(hosts.join(parent, "domain"))
    return {"hosts": by_host, "domains": domains, "suffixes": suffixes, "overall": overall, "strength": strength}


def judge(pages: DataFrame, rules=RULES, settings: Reputation = Reputation()) -> DataFrame:
    """Host, path, rule and verdict of every page, and the bound that the method judged by.

    A null URL has an empty host and path. Hosts without labelled pages take the
    rate of their domain, suffix or all pages as prior alone. Repeated rows stay.
    Input columns named like an output are replaced.
    """
    url = F.col("url")
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "lower_bound")]
    host, path = split_url(url)
    judged = pages.select(*keep).withColumns({"host": host, "path": path})
    name, listed = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.withColumns({"rule": name, "listed": listed})
    # One pass over the pages counts the outcomes of each host and whether any of its pages is unlisted.
    hosts = Scratch(pages.sparkSession, "url-hosts").keep(
        judged.groupBy("host").agg(
            F.count("listed").cast("double").alias("n"),
            F.count_if(F.col("listed") == "block").cast("double").alias("bad"),
            F.max(F.col("listed").isNull()).alias("asked"),
        )
    )
    fitted = fit(hosts.where("n > 0").select("host", "n", "bad"), settings)

    domain, suffix = levels(F.col("host"))
    known = (
        hosts.where("asked").select("host").withColumns({"domain": domain, "suffix": suffix})
        .join(fitted["hosts"].select("host", "n", "bad"), "host", "left")
        .join(fitted["domains"].select("domain", F.col("rate").alias("domain_rate")), "domain", "left")
        .join(fitted["suffixes"].select("suffix", F.col("rate").alias("suffix_rate")), "suffix", "left")
    )
    prior = F.coalesce("domain_rate", "suffix_rate", F.lit(fitted["overall"]))
    alpha = F.coalesce("bad", F.lit(0.0)) + fitted["strength"] * prior
    beta = F.coalesce("n", F.lit(0.0)) - F.coalesce("bad", F.lit(0.0)) + fitted["strength"] * (1 - prior)
    known = known.withColumns({"alpha": alpha, "beta": beta})
    size = F.col("alpha") + F.col("beta")
    mean = F.col("alpha") / size
    bound = mean - settings.z * F.sqrt(mean * (1 - mean) / (size + 1))
    bounds = known.select("host", bound.alias("lower_bound"))
    found = F.when(F.col("lower_bound") > settings.limit, "block").otherwise("allow")
    return (
        judged.join(bounds, "host", "left")
        .withColumn("verdict", F.coalesce("listed", found))
        .select(*keep, "host", "path", "rule", "verdict", F.when(F.col("listed").isNull(), F.col("lower_bound")).alias("lower_bound"))
    )

"""URL filter: Empirical-Bayes host reputation (DataFrame functions only).

Labelled page outcomes are counted per host. Each level of the name hierarchy
(suffix, registered domain, host) has a beta-binomial model whose prior mean is the
posterior mean of the level above and whose prior strength comes from the observed
over-dispersion of that level (method of moments). A host is blocked when the upper
bound of its posterior rate of good pages is below ``min_good``: hosts with few or no
labels shrink to their domain and stay unless the evidence is clear.

Explicit rules (``host/path`` prefixes) come first; the longest fitting rule wins.

Defined cases: a null url or one without ``://`` has empty host and path, fits no rule
and is judged by the overall rate; hosts with ports or user info are names as they
stand; repeated rows are judged (and counted) one by one; null outcomes are ignored;
without any outcome nothing is blocked by reputation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import salted_join, stage_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    action: str  # "allow" or "block"
    text: str    # host, then path from its first "/"

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host):]


@dataclass(frozen=True)
class Reputation:
    """``min_good``: a host is blocked when its bound is below this rate; ``z``: width of
    the bound in standard deviations; ``salts``: spread of one name's children; the
    dispersion is kept within ``[low, high]`` so a prior is never degenerate."""

    min_good: float = 0.5
    z: float = 1.645
    salts: int = 32
    low: float = 0.001
    high: float = 0.5


def split_url(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column."""
    rest = f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END"
    part = "regexp_extract(" + rest + ", '^([^/?#]*)([^?#]*)', {})"
    return (F.expr(f"translate({part.format(1)}, '{UPPER}', '{LOWER}')"), F.expr(part.format(2)))


def rule_for(rules: list[Rule]) -> tuple[Column, Column]:
    """Text and action of the longest fitting rule (null without one). Of equal rules
    a block comes first."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.action == "block")):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        text, action = F.when(fits, r.text).otherwise(text), F.when(fits, r.action).otherwise(action)
    return text, action


def _dispersion(children: DataFrame, how: Reputation) -> float:
    """Method-of-moments dispersion of the children's rates around their parents' means:
    ``E[n (p - m)**2] = m (1 - m) (1 + (n - 1) rho)``. One row reaches the driver."""
    got = children.where("n > 0").selectExpr(
        "sum(n * pow(good / n - prior, 2) - prior * (1 - prior)) AS above",
        "sum(prior * (1 - prior) * (n - 1)) AS room").first()
    rho = got["above"] / got["room"] if got["room"] else how.low
    return min(max(rho, how.low), how.high)


def _posterior(children: DataFrame, rho: float) -> DataFrame:
    strength = 1 / rho - 1
    return children.withColumns({
        "a": F.expr(f"prior * {strength!r} + good"), "b": F.expr(f"(1 - prior) * {strength!r} + n - good"),
    })


def host_reputation(counts: DataFrame, how: Reputation = Reputation()) -> DataFrame:
    """``host, n, good`` (one row per host) -> posterior rate and bounds per host.

    Registered domain: the last two labels of the host; suffix: the last."""
    hosts = counts.selectExpr(
        "host", "n", "good", "concat_ws('.', slice(split(host, '[.]'), -least(2, size(split(host, '[.]'))), 2)) AS domain",
        "element_at(split(host, '[.]'), -1) AS suffix")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = suffixes.selectExpr("coalesce(sum(n), 0) AS n", "coalesce(sum(good), 0) AS good").first()
    root = (total["good"] + 1) / (total["n"] + 2)

    level = suffixes.withColumn("prior", F.lit(root))
    level = _posterior(level, _dispersion(level, how)).selectExpr("suffix", "a / (a + b) AS prior")
    # `salted_join`: one suffix may hold most domains, one domain most hosts
    level = salted_join(domains, level, "suffix", F.col("domain"), how.salts)
    level = _posterior(level, _dispersion(level, how)).selectExpr("domain", "a / (a + b) AS prior")
    level = salted_join(hosts, level, "domain", F.col("host"), how.salts)
    level = _posterior(level, _dispersion(level, how)).withColumn("mean", F.expr("a / (a + b)"))
    level = level.withColumn("sd", F.expr("sqrt(a * b / (pow(a + b, 2) * (a + b + 1)))"))
    return level.selectExpr("host", "n AS n_labelled", "mean AS good_rate",
                            f"greatest(0D, mean - {how.z!r} * sd) AS good_low", f"least(1D, mean + {how.z!r} * sd) AS good_high")


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], how: Reputation = Reputation()) -> DataFrame:
    """Judge every page: ``page_id, host, path, rule, verdict`` and the host's bounds.

    ``pages``: page_id, url; ``outcomes``: page_id, good (0/1), any number per page."""
    host, path = split_url("url")
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    # both sides are counted before they meet, so a repeated page or label is one row
    seen = pages.groupBy("page_id", "host").agg(F.count(F.lit(1)).alias("c"))
    known = outcomes.where("good IS NOT NULL AND page_id IS NOT NULL").groupBy(F.col("page_id").alias("_id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("good").cast("long")).alias("good"))
    counts = seen.join(known, F.expr("page_id = _id"), "left").groupBy("host").agg(
        F.coalesce(F.sum(F.expr("c * n")), F.lit(0)).alias("n"), F.coalesce(F.sum(F.expr("c * good")), F.lit(0)).alias("good"))
    reputation = host_reputation(stage_table(counts, "host-counts"), how)
    judged = salted_join(pages, reputation, "host", F.col("page_id"), how.salts)
    rule, action = rule_for(rules)
    method = F.when(F.col("good_high") < how.min_good, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(action, method).alias("verdict"),
                         "n_labelled", "good_rate", "good_low", "good_high")

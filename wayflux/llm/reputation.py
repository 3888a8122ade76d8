"""URL filters: empirical-Bayes reputation of hosts, under explicit rules.

Labelled page outcomes (bad or not) are summed by host, registered domain and suffix.  A suffix's rate
is shrunk towards the overall rate, a domain's towards its suffix's, a host's towards its domain's, each
as a beta prior whose strength is estimated from how much groups of that level differ beyond chance.
A host is blocked when the lower bound of its posterior is above the tolerated rate, so hosts with
few labels follow their domain and single bad pages block nobody.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayflux.llm.common import only, stored


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Reputation:
    """Blocked: mean - ``deviations`` standard deviations of the posterior above ``tolerated``.
    ``strongest``: the largest prior strength, taken where groups differ no more than by chance.
    ``second_level``: suffixes of two labels."""

    tolerated: float = 0.5
    deviations: float = 1.2816
    strongest: float = 1000.0
    second_level: tuple[str, ...] = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "co.jp", "co.nz")


def host_of(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.substring(url, F.instr(F.col(url), "://") + 3, F.length(url))
    found = F.when(F.instr(F.col(url), "://") > 0, F.regexp_extract(rest, r"^[^/?#]*", 0))
    return F.coalesce(found, F.lit(""))


def path_of(url: str) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    rest = F.substring(url, F.instr(F.col(url), "://") + 3, F.length(url))
    found = F.when(F.instr(F.col(url), "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))
    return F.coalesce(found, F.lit(""))


def levels(host: str, second_level: tuple[str, ...]) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, without port; a host of one label is all of them."""
    bare = F.regexp_extract(host, r"^[^:]*", 0)
    last2 = F.substring_index(bare, ".", -2)
    two = last2.isin(*second_level) if second_level else F.lit(False)
    return (F.when(two, F.substring_index(bare, ".", -3)).otherwise(last2),
            F.when(two, last2).otherwise(F.substring_index(bare, ".", -1)))


def _strength(groups: DataFrame, mean: float, strongest: float) -> float:
    """Prior strength by moments of the beta-binomial, from one row of sums over the groups."""
    row = groups.where("n > 0").agg(
        F.count(F.lit(1)), F.sum("n"), F.sum(F.col("n") * F.col("n")),
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.lit(mean), F.lit(2.0)))).first()
    count, total, squares, spread = (float(x or 0) for x in row)
    chance = mean * (1 - mean)
    if count < 2 or chance <= 0 or total * total <= squares:
        return strongest
    between = (spread - (count - 1) * chance) / (total - squares / total)
    if between <= 0:
        return strongest
    return min(max(chance / between - 1, 1.0), strongest)


def _shrunk(groups: DataFrame, parent: Column, strength: float, name: str) -> DataFrame:
    return groups.withColumn(name, (F.col("bad") + strength * parent) / (F.col("n") + strength))


def host_reputation(pages: DataFrame, outcomes: DataFrame, rule: Reputation = Reputation()) -> DataFrame:
    """``host, n, bad, mean, lower`` for each host of ``pages``; only a few sums reach the driver.

    ``outcomes`` (page_id, bad) may repeat a page (any bad one counts) and name unknown ones; null ids
    and outcomes are not used.  Without outcomes all means are one half and nothing is blocked by
    the bound.
    """
    known = only(outcomes, page_id="bigint", bad="int").where("page_id is not null and bad is not null") \
        .groupBy("page_id").agg(F.max("bad").alias("bad"))
    urls = only(pages, page_id="bigint", url="string").select(
        "page_id", ascii_lower_host("url").alias("host"))
    domain, suffix = levels("host", rule.second_level)
    hosts = stored(urls.join(known, "page_id", "left").groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .withColumns({"domain": domain, "suffix": suffix}), "hosts")
    domains = hosts.groupBy("domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"),
                                          F.first("suffix").alias("suffix"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    n, bad = hosts.agg(F.sum("n"), F.sum("bad")).first()
    mean = (bad + 0.5) / (n + 1) if n else 0.5
    strength = [_strength(g, mean, rule.strongest) for g in (suffixes, domains, hosts)]
    by_suffix = _shrunk(suffixes, F.lit(mean), strength[0], "suffix_mean").select("suffix", "suffix_mean")
    by_domain = _shrunk(domains.join(by_suffix, "suffix"), F.col("suffix_mean"), strength[1],
                        "domain_mean").select("domain", "domain_mean")
    posterior = _shrunk(hosts.join(by_domain, "domain"), F.col("domain_mean"), strength[2], "mean")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + strength[2] + 1))
    return posterior.select("host", "n", "bad", "mean",
                            (F.col("mean") - rule.deviations * deviation).alias("lower"))


def ascii_lower_host(url: str) -> Column:
    return F.translate(host_of(url), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rule_for(host: str, path: str, rules: tuple[Rule, ...]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, the first by name among equals; else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), [-ord(c) for c in r.name])):
        fits = ((F.col(host) == r.host) | F.endswith(F.col(host), F.lit("." + r.host))) \
            & F.startswith(F.col(path), F.lit(r.path))
        found = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))) \
            .otherwise(found)
    return found


def url_verdicts(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = (),
                 rule: Reputation = Reputation()) -> DataFrame:
    """``page_id, host, path, rule, verdict, mean, lower`` for each row of ``pages`` (page_id, url).

    A fitting rule decides, else the posterior bound of the host.  Null urls and those without ``://``
    have an empty host and path and are judged as one host.  Repeated rows are each judged; other
    columns are not read; an empty table gives no rows.
    """
    known = stored(host_reputation(pages, outcomes, rule), "reputation").select(
        F.col("host").alias("known_host"), "mean", "lower")
    rows = only(pages, page_id="bigint", url="string").select(
        "page_id", ascii_lower_host("url").alias("host"), path_of("url").alias("path"))
    judged = rows.withColumn("fit", rule_for("host", "path", rules)).join(
        known, F.col("host") == F.col("known_host"), "left")
    return judged.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce(
        "fit.verdict", F.when(F.col("lower") > rule.tolerated, "block").otherwise("allow"))
        .alias("verdict"), "mean", "lower")

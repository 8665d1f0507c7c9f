"""Empirical-Bayes host reputation for URLs, in DataFrame operations only.

Labelled page outcomes (good or bad) are counted for hosts. The rate of bad pages
is shrunk from the top down: all pages -> public suffix -> registered domain ->
host. At each level the beta prior has the parent's posterior mean and a strength
that the method of moments finds from the spread of the level's rates
(beta-binomial). A host without labels has its domain's prior. A URL is blocked if
the lower posterior bound of its host's bad rate (mean - z * sd of the beta
posterior) is above ``max_bad``: only hosts that are bad beyond doubt go.

Rules come first: (verdict, rule) with rule = host + path. A rule fits its host
and all subdomains if the url's path starts with the rule's path; the longest
fitting rule wins.

Defined results: a null url or one without ``://`` has empty host and path, no
rule, and the verdict of the empty host, which is a host as any other; rows that
repeat are judged each; an empty table gives an empty result; without a labelled
page the prior mean is 0 and nothing is blocked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curlew.llm.common import stored

# Second-level labels under which names are registered (co.uk and the like).
SECOND_LEVEL = ["ac", "co", "com", "edu", "gov", "net", "org"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_RULES = 1000


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return F.when(url.isNull() | (at == 0), "").otherwise(host)


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    return F.when(url.isNull() | (at == 0), "").otherwise(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def suffix_of(host: Column) -> Column:
    """The public suffix: the last label, or the last two under a country."""
    two = F.substring_index(host, ".", -2)
    country = (F.length(F.substring_index(host, ".", -1)) == 2) & F.substring_index(two, ".", 1).isin(SECOND_LEVEL)
    return F.when(country, two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The registered domain: the suffix and one label more, if there is one."""
    labels = F.size(F.split(suffix_of(host), "\\."))
    return F.when(labels == 2, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def _shrunk(level: DataFrame) -> DataFrame:
    """Adds the strength of the level's prior and each group's posterior mean.
    ``level`` has n, k and the parent's mean."""
    p, m = F.col("k") / F.col("n"), F.col("parent")
    v = m * (1 - m)
    seen = F.col("n") > 0
    a, b, c = level.agg(
        F.sum(F.when(seen, F.col("n") * (p - m) * (p - m))), F.sum(F.when(seen, v)),
        F.sum(F.when(seen, (F.col("n") - 1) * v))).first()
    rho = min(max((a - b) / c, 1e-4), 0.99) if c else 0.01
    mean = (F.col("k") + F.lit(1 / rho - 1) * m) / (F.col("n") + F.lit(1 / rho - 1))
    return level.withColumn("strength", F.lit(1 / rho - 1)).withColumn("mean", mean)


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """host, n, k, mean, sd from ``outcomes`` (host, bad), where ``bad`` is 1, 0
    or null (a page without a label, which makes its host known)."""
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("k"))
    hosts = stored(hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))), "url-hosts")
    n, k = hosts.agg(F.sum("n"), F.sum("k")).first()
    add = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    top = hosts.groupBy("suffix").agg(*add).withColumn("parent", F.lit(float(k / n if n else 0)))
    suffixes = _shrunk(top).select("suffix", F.col("mean").alias("parent"))
    domains = _shrunk(hosts.groupBy("domain", "suffix").agg(*add).join(suffixes, "suffix")).select("domain", F.col("mean").alias("parent"))
    a = F.col("k") + F.col("strength") * F.col("parent")
    b = F.col("n") - F.col("k") + F.col("strength") * (1 - F.col("parent"))
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return _shrunk(hosts.join(domains, "domain")).select("host", "n", "k", "mean", sd.alias("sd"))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule, or null. ``rules`` is a short parameter list."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    chosen = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at = rule.index("/")
        fits = ((host == rule[:at]) | host.endswith("." + rule[:at])) & path.startswith(rule[at:])
        chosen = F.when(fits, rule).otherwise(chosen)
    return chosen


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id",
          url_col: str = "url", max_bad: float = 0.5, z: float = 1.645) -> DataFrame:
    """id, host, path, rule, verdict for every row of ``pages``. ``outcomes`` (host,
    bad) has at least one row for each host of ``pages``, with a null ``bad`` where
    there is no label."""
    url = F.col(url_col)
    split = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    split = split.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    said = F.create_map(*[F.lit(x) for verdict, rule in rules for x in (rule, verdict)]) if rules else None
    known = host_reputation(outcomes).select("host", (F.col("mean") - z * F.col("sd")).alias("bound"))
    own = F.when(F.col("bound") > max_bad, "block").otherwise("allow")
    verdict = F.coalesce(said[F.col("rule")], own) if rules else own
    return split.join(known, "host", "left").select(id_col, "host", "path", "rule", verdict.alias("verdict"))

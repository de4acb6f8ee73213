"""URL filters: explicit rules, and an empirical-Bayes reputation of hosts where no rule speaks.

Labelled pages are outcomes (1: bad) of their host. A host's rate is shrunk towards that of its registered domain, the domain's
towards its suffix, the suffix's towards all pages: each level is a beta-binomial whose strength is fitted to the spread of the
level's own rates by the method of moments. A host is blocked when the lower bound of its posterior bad rate is above a limit,
so a host with few labels is judged by its domain and never blocked on a single bad page.

The suffix is the last label of a host, the registered domain its last two. Pages are counted per host before anything is
joined; everything after that works on one row per host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlake.session import write_and_read

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Z = 1.645  # one-sided 95 %
MOST_BAD = 0.5
CORRELATION = (1e-4, 0.99)  # of two pages of one host, bounds of the fit


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _levels(host: Column) -> list[Column]:
    return [F.substring_index(host, ".", -1).alias("suffix"), F.substring_index(host, ".", -2).alias("domain")]


def _shrunk(children: DataFrame, child: str, parent: str) -> DataFrame:
    """Adds strength (of the prior) and rate (posterior mean) to children (child, parent, n, bad, prior: the parent's rate)."""
    p = F.col("prior")
    spread = F.sum(F.pow(F.col("bad") - F.col("n") * p, 2) / (p * (1 - p)))
    fitted = (spread - F.sum("n")) / F.sum(F.col("n") * (F.col("n") - 1))
    rho = F.greatest(F.lit(CORRELATION[0]), F.least(F.lit(CORRELATION[1]), F.coalesce(fitted, F.lit(CORRELATION[0]))))
    strength = children.agg((1 / rho - 1).alias("strength"))  # one row
    rate = (F.col("bad") + p * F.col("strength")) / (F.col("n") + F.col("strength"))
    return children.crossJoin(F.broadcast(strength)).withColumn("rate", rate)


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """(host, n, bad, rate, lower) from (host, bad): bad is 1, 0, or null for a page without label.

    rate is the posterior mean of the bad rate and lower its lower bound (normal approximation, ``Z``). A host without labels
    has the rate of its domain; without any label at all every rate is 0.5 at full uncertainty. An empty table gives none.
    """
    counted = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    hosts = write_and_read(counted.select("*", *_levels(F.col("host"))), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    every = hosts.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0)) + 1)).alias("prior"))  # one row
    suffixes = write_and_read(_shrunk(suffixes.crossJoin(F.broadcast(every)), "suffix", "all"), "suffixes")
    domains = domains.join(suffixes.select("suffix", F.col("rate").alias("prior")), "suffix")
    domains = write_and_read(_shrunk(domains, "domain", "suffix"), "domains")
    hosts = hosts.drop("suffix").join(domains.select("domain", F.col("rate").alias("prior")), "domain")
    judged = _shrunk(write_and_read(hosts, "hosts"), "host", "domain")
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.col("strength") + 1))
    return judged.select("host", "n", "bad", "rate", (F.col("rate") - Z * deviation).alias("lower"))


def rules_by_host(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): the rules (host, path, verdict) that fit a host or a domain above it, longest first."""
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    named = rules.select(F.col("host").alias("above"), F.struct(
        F.length(F.concat("host", "path")).alias("length"), F.concat("host", "path").alias("rule"), "path", "verdict").alias("rule"))
    fitting = hosts.select("host", F.explode(above).alias("above")).join(named, "above")
    return fitting.groupBy("host").agg(F.sort_array(F.collect_set("rule"), asc=False).alias("rules"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: DataFrame, most_bad: float = MOST_BAD) -> DataFrame:
    """(page_id, host, path, rule, verdict, rate, lower) for each row of ``pages`` (page_id, url).

    ``outcomes`` (page_id, bad) labels some pages; of several labels the worst counts, null labels and ids count as none. The
    longest rule that fits decides; rules of one length are taken in descending order. Without rule a host whose ``lower`` is
    above ``most_bad`` is blocked. Urls without host (null or no ``://``) have no reputation and are allowed. Repeated rows are
    judged each and counted each; other columns are ignored.
    """
    named = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = outcomes.where("page_id is not null").groupBy("page_id").agg(F.max("bad").cast("int").alias("bad"))
    reputation = host_reputation(named.join(labels, "page_id", "left").select("host", "bad"))
    known = write_and_read(reputation, "reputation")
    known = write_and_read(known.join(rules_by_host(known.select("host"), rules), "host", "left"), "hosts")
    # hosts are joined without a hint: a small table is broadcast by its measured size, a busy host of a large one is split
    joined = named.join(known, "host", "left")
    rule = F.get(F.filter("rules", lambda r: F.col("path").startswith(r["path"])), F.lit(0))
    bad = F.when((F.col("lower") > most_bad) & (F.col("host") != ""), "block").otherwise("allow")
    return joined.select("page_id", "host", "path", rule["rule"].alias("rule"), F.coalesce(rule["verdict"], bad).alias("verdict"), "rate", "lower")

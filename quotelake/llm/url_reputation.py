"""URL filters: allow and block rules, else the reputation of the host.

Labelled page outcomes are summed by host and shrunk through beta-binomial priors: the rate
of a suffix towards the rate of all pages, of a registered domain towards its suffix, of a
host towards its domain. A host whose rate of bad pages is above the limit by the lower
bound of its posterior is blocked. All pages of an unlabelled host get what its domain gives.

Reputation is that of the host without user name and port; an address in numbers is a domain of
its own under the empty suffix. A null url or one without ``://`` has an empty host and path, which form a group like any
other. Several labels of one page count as one, bad if any is bad; null labels count as
not bad. Repeated pages are judged each. Empty tables give an empty result or the even prior.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quotelake.llm.common import attach, beta_prior, posterior_low, stage_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MAX_RATE = 0.5
Z = 1.645

# Suffixes of two labels under which names are registered, if no table of suffixes is given.
SECOND_LEVEL = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "org.uk")

Rule = tuple[str, str, str]  # verdict, host, path


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def site(host: Column) -> Column:
    """A host without user name and port: what reputation belongs to."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")


def is_address(host: Column) -> Column:
    """Whether a host is an IPv4 or IPv6 address: it has no domain above it."""
    return host.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$|^\[.*\]$")


def suffix(host: Column) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return F.when(is_address(host), F.lit("")).when(last_two.isin(*SECOND_LEVEL), last_two).otherwise(F.substring_index(host, ".", -1))


def registered_domain(host: Column) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return F.when(is_address(host), host).when(last_two.isin(*SECOND_LEVEL), F.substring_index(host, ".", -3)).otherwise(last_two)


def with_domains(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """The hosts, one row each, with domain and suffix. ``suffixes`` has the rules of a public
    suffix list in a column suffix: names, ``*.`` for any label and ``!`` for exceptions; the
    longest that fits counts, an exception before others. Hosts under none fall back."""
    fallback = hosts.withColumn("domain", registered_domain(F.col("host"))).withColumn("suffix", suffix(F.col("host")))
    if suffixes is None:
        return fallback
    rules = stage_table(suffixes.select(F.translate("suffix", UPPER, LOWER).alias("rule")).dropna().distinct(), "suffix-rules")
    size = F.size(F.split("host", r"\."))
    ends = hosts.filter(~is_address(F.col("host"))).select("host", F.explode(F.sequence(F.lit(1), size)).alias("labels")).withColumn(
        "end", F.expr("substring_index(host, '.', -labels)"))
    wild = F.concat(F.lit("*"), F.regexp_replace("end", r"^[^.]*", ""))
    tries = ends.select("host", "labels", F.explode(F.array("end", wild, F.concat(F.lit("!"), "end"))).alias("rule"))
    fits = attach(tries, rules.withColumn("fits", F.lit(True)), ["rule"], "inner").groupBy(F.col("host").alias("__host")).agg(
        F.max(F.when(F.startswith("rule", F.lit("!")), F.col("labels") - 1)).alias("but"), F.max("labels").alias("longest"))
    n = F.coalesce("but", "longest")
    found = fallback.join(fits.select("__host", n.alias("__n")), F.col("host") == F.col("__host"), "left")
    return found.select(
        *hosts.columns, F.expr("if(__n is null, domain, substring_index(host, '.', -(__n + 1)))").alias("domain"),
        F.expr("if(__n is null, suffix, substring_index(host, '.', -__n))").alias("suffix"))


def match_rules(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict, null without one. The rules are a list
    that people write: they become one expression."""
    text = verdict = F.lit(None).cast("string")
    for kind, domain, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(start)
        text = F.when(fits, domain + start).otherwise(text)
        verdict = F.when(fits, kind).otherwise(verdict)
    return text, verdict


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """host (the url's site), bad (null: unlabelled) of every page, by labels of (page_id, bad)."""
    once = labels.groupBy(F.col("page_id").alias("__id")).agg(
        F.max(F.coalesce(F.col("bad"), F.lit(False)).cast("int")).alias("bad"))
    return (pages.select(F.col("page_id"), site(url_host(F.col("url"))).alias("host"))
            .join(once, F.col("page_id") == F.col("__id"), "left").select("host", "bad"))


def reputation(observed: DataFrame, max_rate: float = MAX_RATE, z: float = Z,
               suffixes: DataFrame | None = None) -> DataFrame:
    """One row per host of (host, bad) rows: n, bad, domain, suffix, low and blocked."""
    counted = observed.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    hosts = stage_table(with_domains(counted, suffixes), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("dn"), F.sum("bad").alias("dbad"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("sn"), F.sum("bad").alias("sbad"))

    mean, of_suffix = beta_prior(suffixes, "sbad", "sn")
    _, of_domain = beta_prior(domains, "dbad", "dn")
    _, of_host = beta_prior(hosts)

    suffixes = suffixes.withColumn(
        "suffix_rate", (F.col("sbad") + F.lit(mean * of_suffix)) / (F.col("sn") + F.lit(of_suffix)))
    domains = attach(domains, stage_table(suffixes.select("suffix", "suffix_rate"), "suffixes"), ["suffix"])
    domains = domains.withColumn(
        "domain_rate", (F.col("dbad") + F.col("suffix_rate") * of_domain) / (F.col("dn") + F.lit(of_domain)))
    rated = attach(hosts, stage_table(domains.select("domain", "domain_rate"), "domains"), ["domain"])
    low = posterior_low(F.col("bad"), F.col("n"), F.col("domain_rate"), of_host, z)
    return stage_table(rated.withColumn("low", low).withColumn("blocked", low > max_rate), "reputation")


def filter_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule], suffixes: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of every page; domain, labelled and bad pages of its
    site, and the lower bound of the site's rate."""
    sites = reputation(outcomes(pages, labels), suffixes=suffixes).select(
        F.col("host").alias("site"), "domain", F.col("n").alias("site_n"), F.col("bad").alias("site_bad"),
        F.col("low").alias("site_low"), "blocked")
    host = url_host(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), url_path(F.col("url")).alias("path"), site(host).alias("site"))
    rule, verdict = match_rules(rules, F.col("host"), F.col("path"))
    return attach(parsed, sites, ["site"]).select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
        "domain", "site_n", "site_bad", "site_low")

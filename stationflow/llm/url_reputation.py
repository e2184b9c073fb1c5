"""URL filter: rules first, then a reputation of the host by empirical Bayes.

Labelled page outcomes (1 good, 0 bad) are counted per host. Hosts shrink towards their registered domain, domains towards their
suffix, suffixes towards all pages. Each level's prior is a beta whose strength comes from how much the rates of that
level differ beyond binomial chance. A host is blocked if even the upper bound of its posterior good rate is low.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

# The contract's rules, and suffixes of two labels.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
TWO_LABEL_SUFFIXES = ["ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "com.br", "com.cn", "co.in", "co.jp", "ne.jp", "or.jp", "co.kr", "com.mx", "co.nz", "com.tr", "com.tw", "co.za"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of an address; both empty without ``://`` or for null."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest fitting rule, or null. ``rules`` is a short list; of equal lengths the earlier wins."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix. A port is left out; a host without a label before its suffix is its own domain."""
    bare = F.regexp_replace(host, r":[0-9]*$", "")
    two = F.substring_index(bare, ".", -2)
    double = two.isin(TWO_LABEL_SUFFIXES)
    suffix = F.when(double, two).otherwise(F.substring_index(bare, ".", -1))
    return F.when(double, F.substring_index(bare, ".", -3)).otherwise(two), suffix


def strength(rows: DataFrame, least: float = 1e-3, most: float = 0.5) -> float:
    """Prior strength of a level from (s, n, parent rate m): pseudo-counts that explain the spread beyond chance."""
    n, m = F.col("n"), F.col("m")
    row = rows.where("n > 0").agg(
        F.sum(n).alias("n"), F.sum(n * n).alias("nn"), F.count(F.lit(1)).alias("g"),
        F.sum(n * (F.col("s") / n - m) * (F.col("s") / n - m)).alias("a"), F.sum(n * m * (1 - m)).alias("c")).first()
    if not row["n"] or not row["c"]:
        return 1 / least - 1
    total = float(row["n"])
    chance = row["c"] / total
    free = 1 - row["nn"] / total ** 2
    between = (row["a"] / total - chance * (row["g"] - 1) / total) / free if free > 0 else 0.0
    share = min(max(between / chance, least), most)
    return 1 / share - 1


def reputations(outcomes: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, posterior_mean, posterior_sd) of every host of ``hosts``.

    ``outcomes`` has ``host`` and ``good`` (0 or 1; null is no outcome). Counts combine before the shuffle, so a
    host with very many pages is no hot spot; hosts without an outcome get their domain's posterior.
    """
    counts = outcomes.where("good IS NOT NULL").groupBy("host").agg(F.sum(F.col("good").cast("bigint")).alias("s"), F.count(F.lit(1)).alias("n"))
    domain, suffix = domain_and_suffix(F.col("host"))
    known = hosts.select("host").distinct().join(counts, "host", "left").select(
        "host", domain.alias("domain"), suffix.alias("suffix"), F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("n", F.lit(0)).alias("n"))
    domains = known.groupBy("domain", "suffix").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    suffixes = domains.groupBy("suffix").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    whole = suffixes.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    mean = ((whole["s"] or 0) + 1) / ((whole["n"] or 0) + 2)

    def shrunk(rows, k):
        return rows.withColumn("rate", (k * F.col("m") + F.col("s")) / (k + F.col("n")))

    suffixes = suffixes.withColumn("m", F.lit(mean))
    suffixes = shrunk(suffixes, strength(suffixes))
    domains = domains.join(suffixes.select("suffix", F.col("rate").alias("m")), "suffix")
    domains = shrunk(domains, strength(domains))
    known = known.join(domains.select("domain", "suffix", F.col("rate").alias("m")), ["domain", "suffix"])
    k = strength(known)
    a, b = k * F.col("m") + F.col("s"), k * (1 - F.col("m")) + F.col("n") - F.col("s")
    return known.select("host", (a / (a + b)).alias("posterior_mean"), F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))).alias("posterior_sd"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]] = RULES, z: float = 1.645, least_good: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, upper) of every page.

    ``outcomes`` has ``host`` and ``good``. A rule decides where one fits; elsewhere a host is blocked
    if posterior mean plus ``z`` deviations stays below ``least_good``. A null address has an empty host, judged like any other.
    """
    host, path = host_and_path(F.col("url"))
    slim = pages.select("page_id", host.alias("host"), path.alias("path"))
    ranked = reputations(outcomes, slim).select("host", F.least(F.lit(1.0), F.col("posterior_mean") + z * F.col("posterior_sd")).alias("upper"))
    hit = rule_of(F.col("host"), F.col("path"), rules)
    # the sort-merge join lets adaptive execution split a host that holds very many pages
    return slim.join(ranked, "host", "left").withColumn("__hit", hit).select(
        "page_id", "host", "path", F.col("__hit.rule").alias("rule"),
        F.coalesce("__hit.verdict", F.when(F.col("upper") < least_good, "block").otherwise("allow")).alias("verdict"), "upper")


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, good): the quality label of the document that a page's address names by number, where there is one.

    Several labels of a document count as one: the least.
    """
    number = F.regexp_extract("url", r"/(\d{1,18})", 1)
    slim = pages.select(host_and_path(F.col("url"))[0].alias("host"), F.when(number != "", number.cast("bigint")).alias("doc_id")).where("doc_id IS NOT NULL")
    quality = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("good"))
    return slim.join(quality, "doc_id").select("host", "good")

"""URL filters with empirical-Bayes host reputation, in DataFrame operations only.

Labelled page outcomes are counted by host. A beta-binomial model shrinks the share of good
pages from the suffix (last label of the host) to the registered domain (last two labels) to
the host: each level's prior has the posterior mean of the level above, and a weight
estimated by moments from the spread of the shares around those means. A host is allowed if
the lower bound of its posterior reaches a threshold. Fixed rules come before it.

A null url, or one without ``://``, has no host; such pages share the empty host. Hosts
without labelled pages take their domain's values; without any labels the prior is a half.
Repeated rows are counted and returned one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rules as (pattern, verdict).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: A host is allowed if the lower bound of its share of good pages is at least this.
LEAST = 0.7
#: Standard deviations below the mean, and the range of a prior's weight in pages.
SPREAD = 1.645
WEIGHTS = (1.0, 10_000.0)
#: Marks of a broken page: a word with two or more of them counts.
MARKED = r"[*#$%!&|]{2,}|(?:^|\s)\|(?:\s|$)"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def domain_of(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits the host, or a host above it, and the start of the path."""

    def fits(pattern: str) -> Column:
        name, _, rest = pattern.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)

    longest = sorted((p for p, _ in rules), key=lambda p: (-len(p), p))
    return reduce(lambda c, p: c.when(fits(p), F.lit(p)), longest, F.when(F.lit(False), F.lit(None).cast("string")))


def page_is_good(html: Column) -> Column:
    """Outcome of a page, from its own text: less than one in five words is marked junk; null without words."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), r"(?s)<(?:script|style)[^>]*>.*?</(?:script|style)>", " "),
                            r"<[^>]*>", " ")
    text = F.replace(text, F.lit("&amp;"), F.lit("&"))
    words = F.size(F.array_remove(F.split(text, r"\s+"), ""))
    return F.when(words > 0, 5 * (F.size(F.split(text, MARKED)) - 1) < words)


def _weight(children: DataFrame) -> DataFrame:
    """One row ``w``: the prior's weight, from children (n, k) with the mean m of the level above.

    The spread of the shares beyond that of binomial counts gives the correlation within a
    child; its inverse less one is the weight.
    """
    n, k, m = F.col("n"), F.col("k"), F.col("m")
    sums = children.filter("n > 0").agg(
        F.sum(n * (k / n - m) * (k / n - m)).alias("s"), F.sum(m * (1 - m)).alias("v"), F.sum(n * m * (1 - m)).alias("nv"))
    inside = F.col("s") - F.col("v")
    most = F.col("nv") - F.col("v")
    rho = F.when((most > 0) & (inside > 0), F.least(inside / most, F.lit(0.5)))
    w = F.greatest(F.least(1 / rho - 1, F.lit(WEIGHTS[1])), F.lit(WEIGHTS[0]))
    return sums.select(F.coalesce(w, F.lit(WEIGHTS[1])).alias("w"))


def _shrunk(children: DataFrame) -> DataFrame:
    """The posterior of each child as alpha, beta, and its mean. The weight is a single row."""
    with_weight = children.withColumn("w", F.lit(_weight(children).scalar()))
    a, b = F.col("k") + F.col("w") * F.col("m"), F.col("n") - F.col("k") + F.col("w") * (1 - F.col("m"))
    return with_weight.withColumns({"alpha": a, "beta": b, "mean": a / (a + b)})


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """(host, n, k, mean, lower) from rows (host, good); ``good`` may be null for pages without a label."""
    hosts = outcomes.groupBy("host").agg(F.count("good").alias("n"), F.sum(F.coalesce(F.col("good").cast("long"), F.lit(0))).alias("k"))
    hosts = hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    total = suffixes.agg(F.coalesce(F.sum("k") / F.sum("n"), F.lit(0.5)).alias("m"))
    top = _shrunk(suffixes.withColumn("m", F.lit(total.scalar())))
    middle = _shrunk(domains.join(top.select("suffix", F.col("mean").alias("m")), "suffix"))
    low = _shrunk(hosts.join(middle.select("domain", F.col("mean").alias("m")), "domain"))
    size = F.col("alpha") + F.col("beta")
    return low.select("host", "n", "k", "mean",
                      (F.col("mean") - SPREAD * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (size + 1))).alias("lower"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, least: float = LEAST) -> DataFrame:
    """page_id, host, path, rule, verdict and the host's lower bound; ``outcomes`` has rows (host, good)."""
    named = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    named = named.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    known = host_reputation(outcomes).select("host", F.round("lower", 6).alias("lower"))
    verdicts = reduce(lambda c, r: c.when(F.col("rule") == r[0], F.lit(r[1])), rules, F.when(F.lit(False), F.lit("")))
    method = F.when(F.col("lower") >= least, F.lit("allow")).otherwise(F.lit("block"))
    return named.join(known, "host", "left").select(
        "page_id", "host", "path", "rule", verdicts.otherwise(method).alias("verdict"))

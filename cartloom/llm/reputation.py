"""Host reputation by empirical Bayes, with DataFrame functions only.

Labelled pages give every host its number of pages and of bad ones. Suffix, registered domain and
host are beta-binomial levels: the mean of the level above is the prior mean, its strength comes
from how far the units of a level differ (Kleinman's moment estimate of the intra-unit correlation),
so a host with few labels is judged by its domain, and that by its suffix. A host is blocked if even
the lower bound of its posterior share of bad pages is above ``cut``.

Allow and block rules (host, path) come first: the longest that fits decides.

Defined results: a null url or one without ``://`` has empty host and path and the verdict of the
overall mean; hosts without labels take the posterior of the nearest level with labels; null or
repeated labels count as given, null ones not; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
CUT = 0.35
#: Standard deviations between posterior mean and bound.
WIDTH = 1.64
SALTS = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case, and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule, and its verdict; null if none fits."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda rule: (len(rule[1] + rule[2]), rule[1:])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.lit(rule_host + rule_path)).otherwise(found)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return found, verdict


def levels(host: Column) -> dict[str, Column]:
    """Suffix (last label) and registered domain (last two labels) of a host without its port."""
    name = F.regexp_replace(host, r":\d*$", "")
    return {"suffix": F.substring_index(name, ".", -1), "domain": F.substring_index(name, ".", -2)}


def _strength(units: DataFrame) -> DataFrame:
    """One row: prior strength of a level from its units (n, bad, mean of the level above)."""
    p, n, m = F.col("bad") / F.col("n"), F.col("n"), F.col("above")
    sums = units.where(n > 0).agg(
        F.sum(n * (p - m) * (p - m) / F.greatest(m * (1 - m), F.lit(1e-6))).alias("spread"),
        F.sum(n).alias("total"),
        F.sum(n * n).alias("squares"),
        F.count(F.lit(1)).alias("units"),
    )
    free = F.col("units") - 1
    rho = (F.col("spread") - free) / (F.col("total") - F.col("squares") / F.col("total") - free)
    bounded = F.greatest(F.lit(0.002), F.least(F.lit(0.9), F.coalesce(F.when(free > 0, rho), F.lit(0.05))))
    return sums.select(((1 - bounded) / bounded).alias("strength"))


def _shrunk(units: DataFrame) -> DataFrame:
    """Add alpha and beta of the posterior to units with n, bad and the mean of the level above."""
    return units.withColumn("strength", _strength(units).scalar()).withColumns(
        {
            "alpha": F.col("strength") * F.col("above") + F.col("bad"),
            "beta": F.col("strength") * (1 - F.col("above")) + F.col("n") - F.col("bad"),
        }
    )


def _mean() -> Column:
    return F.col("alpha") / (F.col("alpha") + F.col("beta"))


def host_reputation(pages: DataFrame, labels: DataFrame, cut: float = CUT, width: float = WIDTH) -> DataFrame:
    """host, labelled, bad, share (posterior mean), bound, blocked; one row per host of ``pages``.

    ``labels``: page_id and bad (boolean). Sums are made before every shuffle.
    """
    own = labels.where(F.col("bad").isNotNull() & F.col("page_id").isNotNull())
    outcomes = own.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("bad")
    )
    host, _ = url_parts(F.col("url"))
    hosts = (
        pages.select("page_id", host.alias("host"))
        .join(outcomes, "page_id", "left")
        .groupBy("host")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .withColumns(levels(F.col("host")))
    )
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("suffix", "domain").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    # Add-one keeps the overall mean inside (0, 1).
    overall = suffixes.agg(((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("above"))
    top = _shrunk(suffixes.withColumn("above", overall.scalar()))
    middle = _shrunk(domains.join(top.select("suffix", _mean().alias("above")), "suffix"))
    judged = _shrunk(hosts.join(middle.select("domain", _mean().alias("above")), "domain"))
    total = F.col("alpha") + F.col("beta")
    spread = F.sqrt(F.col("alpha") * F.col("beta") / (total * total * (total + 1)))
    return judged.select(
        "host",
        F.col("n").alias("labelled"),
        "bad",
        _mean().alias("share"),
        F.greatest(F.lit(0.0), _mean() - width * spread).alias("bound"),
    ).withColumn("blocked", F.col("bound") > cut)


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, cut: float = CUT) -> DataFrame:
    """page_id, host, path, rule, verdict, share, bound of every page.

    A host may hold a third of all pages: its row of the reputation is given once per salt, and its
    pages are dealt over the salts.
    """
    host, path = url_parts(F.col("url"))
    parted = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parted = parted.withColumns(
        {"rule": rule, "ruled": verdict, "salt": F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int")}
    )
    known = host_reputation(pages, labels, cut)
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    judged = parted.join(known, ["host", "salt"], "left")
    own = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "share", "bound"
    )

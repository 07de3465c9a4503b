"""URL filters: empirical-Bayes host reputation with rules that override it.

Labelled page outcomes (good or bad) are counted per host. A host's rate of bad pages is
shrunk through a chain of beta-binomial priors: all pages -> suffix (``net``) ->
registered domain (``example.net``) -> host. At each level the prior's mean is the
parent's posterior mean, and its strength is fitted on that level's counts by moments. A
host is allowed if the upper bound of its posterior rate (mean + z * sd) is at most
``max_bad``; a host without labels has its parents' posterior.

Only DataFrame functions run: the counts combine before they shuffle, the fitted strengths
are scalar subqueries over one-row aggregates, and the hot host's pages meet one row.

Cases: a null url or one without ``://`` has an empty host and path and is judged by the
prior of all pages; urls with only a scheme have an empty host; repeated pages count as
often as they appear; repeated labels of an id are reduced to one (bad wins); without any
label the rate is ``prior_bad``; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise

#: Suffixes of more than one label under which domains are registered (parameter).
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz")
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
Z = 1.645
MAX_BAD = 0.5
PRIOR_BAD = 0.5
#: Bounds of a fitted prior strength (pages).
STRENGTH = (1.0, 1000.0)


def url_parts(pages: DataFrame) -> DataFrame:
    """``pages`` with host and path of the url."""
    rest = F.expr("substring(url, instr(url, '://') + 3)")
    known = F.col("url").isNotNull() & (F.instr("url", "://") > 0)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.withColumns({"host": F.when(known, lower).otherwise(""), "path": F.when(known, path).otherwise("")})


def suffix_of(host: Column, long_suffixes=LONG_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*long_suffixes), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, long_suffixes=LONG_SUFFIXES) -> Column:
    three = F.substring_index(host, ".", -3)
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*long_suffixes), three).otherwise(two)


def _fit(level: DataFrame) -> Column:
    """Prior strength of a level by moments, from its rows (n, bad, mean of the parent):
    the spread of the rates beyond the binomial gives the correlation in a group."""
    v = F.col("m") * (1 - F.col("m"))
    gap = F.col("bad") / F.col("n") - F.col("m")
    one = level.where("n > 0").agg(F.sum(F.col("n") * gap * gap - v).alias("over"), F.sum(v * (F.col("n") - 1)).alias("room"))
    rho = F.col("over") / F.col("room")
    fitted = F.when((F.col("room") > 0) & (F.col("over") > 0), F.least(F.greatest(1 / rho - 1, F.lit(STRENGTH[0])),
                                                                      F.lit(STRENGTH[1]))).otherwise(F.lit(STRENGTH[1]))
    return one.select(fitted.alias("k")).scalar()


def host_reputation(pages: DataFrame, outcomes: DataFrame, z: float = Z, max_bad: float = MAX_BAD,
                    prior_bad: float = PRIOR_BAD, long_suffixes=LONG_SUFFIXES) -> DataFrame:
    """host, n, bad, mean, sd, upper, verdict for every host of ``pages`` (with host);
    ``outcomes`` has page_id and bad (0 or 1)."""
    label = outcomes.where("page_id is not null and bad is not null").groupBy("page_id").agg(
        F.max(F.col("bad").cast("long")).alias("bad"))
    hosts = pages.select("page_id", "host").join(label, "page_id", "left").groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    hosts = hosts.withColumns({"domain": domain_of(F.col("host"), long_suffixes),
                               "suffix": suffix_of(F.col("host"), long_suffixes)})
    hosts = materialise(hosts, "hosts")  # read by every level
    total = hosts.agg(F.coalesce(F.sum("bad") / F.nullif(F.sum("n"), F.lit(0)), F.lit(prior_bad)).alias("m"))
    level = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    level = level.withColumn("m", total.scalar())
    suffixes = level.withColumn("k", _fit(level)).select(
        "suffix", ((F.col("bad") + F.col("k") * F.col("m")) / (F.col("n") + F.col("k"))).alias("m"))
    level = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).join(suffixes, "suffix")
    domains = level.withColumn("k", _fit(level)).select(
        "domain", ((F.col("bad") + F.col("k") * F.col("m")) / (F.col("n") + F.col("k"))).alias("m"))
    level = hosts.join(domains, "domain")
    a = F.col("bad") + F.col("k") * F.col("m")
    s = F.col("n") + F.col("k")
    out = level.withColumn("k", _fit(level)).select("host", "n", "bad", (a / s).alias("mean"),
                                                   F.sqrt(a / s * (1 - a / s) / (s + 1)).alias("sd"))
    upper = F.col("mean") + z * F.col("sd")
    return out.withColumns({"upper": upper, "verdict": F.when(upper <= max_bad, "allow").otherwise("block")})


def rule_of(rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits host and path; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: len(r[1])):  # later, longer rules win
        own, slash, path = text.partition("/")
        fits = ((F.col("host") == own) | F.endswith("host", F.lit("." + own))) & F.startswith("path", F.lit(slash + path))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, **how) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's posterior mean and upper bound."""
    parts = url_parts(pages.select("page_id", "url"))
    hosts = host_reputation(parts, outcomes, **how).select(
        F.col("host").alias("_host"), F.col("verdict").alias("_verdict"), "mean", "upper")
    rule, verdict = rule_of(rules)
    return parts.join(hosts, F.col("host") == F.col("_host"), "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.col("_verdict"), F.lit("block")).alias("verdict"), "mean", "upper")


def page_outcomes(labels: DataFrame) -> DataFrame:
    """Outcomes from the label table: a page is bad if its row (same id) is labelled of
    low quality or toxic."""
    return labels.select(F.col("doc_id").alias("page_id"),
                         ((F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1))
                         .cast("int").alias("bad"))

"""URL rules and host reputation, in column expressions only.

Reputation is empirical Bayes over labelled page outcomes: at every level (suffix, registered domain,
host) the share of bad pages is drawn towards the level above through a beta prior. The prior's mean is
the parent's posterior mean and its strength is fitted to the spread of the level's own shares. A page is
blocked if even the lower posterior bound of its host's bad share exceeds a limit. A host without labelled
pages is a leaf with no counts, so it has what the nearest labelled level above says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbcount.llm.common import LETTERS, columns
from curbcount.session import materialise

#: Share of bad pages above which a host is blocked, standard errors below the posterior mean that must
#: exceed it, and the bounds of a prior's strength in pages.
BAD_SHARE = 0.5
ERRORS = 2.0
STRENGTH = (1.0, 1000.0)
#: Second-level labels that belong to the suffix below a two-letter top level: fixed values.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
LEVELS = ("suffix", "domain", "host")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), *LETTERS), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The last label, or the last two below a two-letter top level; empty for no host."""
    two = rf"((?:{'|'.join(SECOND_LEVEL)})\.[a-z][a-z])$"
    return F.when(F.regexp_extract(host, rf"(?:^|\.){two}", 1) != "", F.regexp_extract(host, rf"(?:^|\.){two}", 1)).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The suffix and the label before it (the suffix alone if that is the host)."""
    labels = F.size(F.split(suffix_of(host), r"\."))
    return F.when(labels == 2, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest of (``host/path`` text, verdict) that fits; null if none does."""
    fits = []
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r)):
        name, slash, rest = rule.partition("/")
        here = (host == name) | F.endswith(host, F.lit(f".{name}"))
        fits.append(F.when(here & F.startswith(path, F.lit(slash + rest)), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits, F.lit(None).cast("struct<rule:string,verdict:string>"))


def _strength(n: Column, share: Column, mean: Column) -> Column:
    """Pages a prior is worth: by moments, from the spread of shares that counts alone do not explain."""
    chance = F.sum(n * mean * (1 - mean))
    spread = F.sum(n * n * (share - mean) * (share - mean))
    pairs = F.sum(n * (n - 1) * mean * (1 - mean))
    rho = (spread - chance) / F.nullif(pairs, F.lit(0.0))
    low, high = STRENGTH
    return F.coalesce(F.greatest(F.lit(low), F.least(F.lit(high), F.when(rho > 0, 1 / rho - 1).otherwise(high))), F.lit(high))


def reputation(outcomes: DataFrame) -> DataFrame:
    """host, pages, bad, mean, error of every host, from columns ``host`` and ``bad`` (0, 1, null if not labelled).

    Counts are combined before they are shuffled, so a host with very many pages is one row from then on.
    The top of the tree is the share of all labelled pages; without any, mean and error are null. Rows that
    count nothing add nothing to the strengths.
    """
    hosts = outcomes.groupBy("host").agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("k"))
    # one row per host, read again by every level
    hosts = materialise(hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}), "hosts")
    above = hosts.agg((F.sum("k") / F.nullif(F.sum("n"), F.lit(0.0))).alias("up"))
    known, prior = None, None
    for level, parent in zip(LEVELS, (None, "suffix", "domain")):
        counts = hosts.groupBy(level, *([parent] if parent else [])).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        # the top row is one aggregate; each other level meets its parent by key
        met = counts.withColumn("up", above.select("up").scalar()) if parent is None else counts.join(known, parent)
        strength = met.agg(_strength(F.col("n"), F.col("k") / F.nullif(F.col("n"), F.lit(0.0)), F.col("up")).alias("s")).select("s").scalar()
        post = met.withColumn("s", strength).withColumn("mean", (F.col("k") + F.col("up") * F.col("s")) / (F.col("n") + F.col("s")))
        known = post.select(F.col(level), F.col("mean").alias("up"))
        prior = post
    error = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("s") + 1))
    return prior.select("host", F.col("n").cast("bigint").alias("pages"), F.col("k").cast("bigint").alias("bad"), "mean", error.alias("error"))


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
    outcome_id: str = "page_id", outcome_bad: str = "bad", bad_share: float = BAD_SHARE, errors: float = ERRORS,
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, and the reputation behind it.

    The longest rule that fits decides; without one, a page is blocked if its host's lower posterior
    bound of the bad share is above ``bad_share``, and allowed otherwise. Hosts without labelled pages are
    judged by their domain, suffix or all pages, whichever is the nearest with labels; without any label
    all are allowed. Null urls and urls without ``://`` have an empty host and no reputation. ``outcomes`` has one row per labelled page (id, 0 or 1); pages with null ids have none, repeated
    labels count once by the worse one. Repeated rows stay; other columns are not read.
    """
    url = pages[url_col]
    named = columns(pages, page=id_col, host=host_of(url), path=path_of(url))
    labels = columns(outcomes, page=outcome_id, bad=outcome_bad).where("page IS NOT NULL AND bad IS NOT NULL").groupBy("page").agg(F.max("bad").alias("bad"))
    hosted = named.where("host <> ''")
    every = hosted.select("host", F.lit(None).cast("int").alias("bad"))
    hosts = reputation(hosted.join(labels, "page").select("host", "bad").unionByName(every))
    judged = named.join(hosts, "host", "left").withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    low = F.col("mean") - errors * F.col("error")
    method = F.when(low > bad_share, "block").otherwise("allow")
    return judged.select(
        F.col("page").alias(id_col), "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", method).alias("verdict"),
        F.round("mean", 9).alias("bad_mean"), F.round(low, 9).alias("bad_low"),
    )

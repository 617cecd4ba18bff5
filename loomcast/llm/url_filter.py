"""URL filtering by rules and by empirical-Bayes host reputation, DataFrame operations only.

Labelled page outcomes (bad or not) are counted by host, registered domain and suffix.
Each level's bad rate is shrunk to its parent's: the suffixes to the overall rate, domains
to their suffix, hosts to their domain. A level's prior strength is fitted over its groups
by moments of the beta-binomial. A page is blocked if the lower bound of its host's
posterior bad rate reaches a threshold; a host without outcomes has its domain's rate,
else its suffix's, else the overall one as its prior.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import cut, free_name

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules in a list of up to so many are written into the expression; more become a table.
MAX_INLINE = 2000
#: Second labels under which a country's suffix registers domains (co.uk, com.au).
REGISTRY_LABELS = ("ac", "co", "com", "edu", "gob", "gov", "govt", "ltd", "mil", "ne", "net", "nom", "or", "org", "plc", "sch")
#: Bounds of a fitted prior strength, in pages.
STRENGTH = (1.0, 1.0e4)


def split_url(df: DataFrame, url_col: str, host: str = "host", path: str = "path") -> DataFrame:
    """Adds host and path; an url that is null or without :// has both empty."""
    u = F.coalesce(F.col(url_col), F.lit(""))
    at = F.locate("://", u)
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise(F.lit(""))
    return df.withColumns({
        host: F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER),
        path: F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1),
    })


def domain_of(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host: a suffix is the last label, or the last two where a country has registry labels.

    Ports don't count; an address of numbers is its own domain and suffix.
    """
    bare = F.regexp_replace(host, ":[0-9]*$", "")
    last, second = F.substring_index(bare, ".", -1), F.substring_index(F.substring_index(bare, ".", -2), ".", 1)
    deep = (F.length(last) == 2) & second.isin(*REGISTRY_LABELS) & (bare != F.substring_index(bare, ".", -2))
    numbers = bare.rlike(r"^[0-9.]+$|^\[")
    domain = F.when(numbers, bare).when(deep, F.substring_index(bare, ".", -3)).otherwise(F.substring_index(bare, ".", -2))
    return domain, F.when(numbers, bare).when(deep, F.substring_index(bare, ".", -2)).otherwise(last)


def parse_rule(rule: str) -> tuple[str, str, str]:
    """'example.com/en/7' as (host, path, rule); no path means every path."""
    host, slash, path = rule.partition("/")
    return host.translate(str.maketrans(UPPER, LOWER)), slash + path, rule


def match_rules(df: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    """Adds rule and rule_action of the longest rule that fits (ties: the least rule); null if none.

    rules: (action, rule), a list or a table of any size. A rule fits its host and all
    subdomains if the path starts with the rule's.
    """
    if not isinstance(rules, DataFrame) and len(rules) > MAX_INLINE:
        rules = df.sparkSession.createDataFrame(list(rules), "action string, rule string")
    if isinstance(rules, DataFrame):
        return match_rule_table(df, rules, host, path)
    if not rules:
        return df.withColumns({"rule": F.lit(None).cast("string"), "rule_action": F.lit(None).cast("string")})
    fitting = []
    for action, rule in rules:
        h, p, text = parse_rule(rule)
        fits = ((F.col(host) == h) | F.endswith(F.col(host), F.lit("." + h))) & F.startswith(F.col(path), F.lit(p))
        fitting.append(F.when(fits, F.struct(F.lit(-len(text)).alias("size"), F.lit(text).alias("rule"), F.lit(action).alias("action"))))
    best = F.array_min(F.filter(F.array(*fitting), lambda r: r.isNotNull()))
    name = free_name("best", df.columns)
    return df.withColumn(name, best).withColumns({"rule": F.col(f"{name}.rule"), "rule_action": F.col(f"{name}.action")}).drop(name)


def match_rule_table(df: DataFrame, rules: DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    """match_rules for a table (action, rule): distinct (host, path) are joined on each suffix of the host."""
    parsed = rules.select("action", "rule", F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER).alias("rule_host"), F.regexp_extract("rule", r"(/.*)$", 1).alias("rule_path"))
    labels = F.split("h", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    tried = df.select(F.col(host).alias("h"), F.col(path).alias("p")).distinct().select("h", "p", F.explode(suffixes).alias("rule_host"))
    fits = tried.join(parsed, "rule_host").where(F.startswith(F.col("p"), F.col("rule_path")))
    best = fits.groupBy("h", "p").agg(F.min(F.struct((-F.length("rule")).alias("size"), "rule", "action")).alias("b"))
    h, p = (free_name(f"__{c}", df.columns) for c in "hp")
    best = best.select(F.col("h").alias(h), F.col("p").alias(p), F.col("b.rule").alias("rule"), F.col("b.action").alias("rule_action"))
    return df.join(best, (F.col(host) == F.col(h)) & (F.col(path) == F.col(p)), "left").drop(h, p)


def _strength(groups: DataFrame) -> DataFrame:
    """One row: the prior strength that moments of groups (n, bad) give."""
    sums = groups.agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("bad").alias("y"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("yy"), F.sum(1 / F.col("n")).alias("inv"),
    )
    p = F.col("y") / F.col("n")
    spread = F.col("k") * (F.col("yy") - F.col("n") * p * p) / ((F.col("k") - 1) * F.col("n"))
    excess = spread - p * (1 - p) * F.col("inv") / F.col("k")
    fitted = F.when((F.col("k") > 1) & (excess > 0), (p * (1 - p) - spread) / excess).otherwise(F.lit(STRENGTH[1]))
    return sums.select(F.greatest(F.lit(STRENGTH[0]), F.least(F.lit(STRENGTH[1]), fitted)).alias("m"), F.coalesce(p, F.lit(0.0)).alias("p"))


def _posterior(n: Column, bad: Column, prior: Column, m: Column, z: float) -> dict[str, Column]:
    rate, whole = (bad + m * prior) / (n + m), n + m
    return {"bad_rate": rate, "bad_low": rate - z * F.sqrt(rate * (1 - rate) / (whole + 1))}


def _levels(outcomes: DataFrame, host: str, bad: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """hosts (host, domain, suffix, n, bad); domains (domain, domain_rate); suffixes (suffix, suffix_rate); one row (m, p): the hosts' strength and the overall rate."""
    domain, suffix = domain_of(F.col("host"))
    hosts = outcomes.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(bad).cast("long")).alias("bad"))
    hosts = cut(hosts.withColumns({"domain": domain, "suffix": suffix}))  # a row a host: the levels below start from it
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def shrunk(prior: Column) -> Column:
        return (F.col("bad") + F.col("m") * prior) / (F.col("n") + F.col("m"))

    # Each strength is one row: the joins below broadcast a single row.
    s = suffixes.join(F.broadcast(_strength(suffixes))).select("suffix", shrunk(F.col("p")).alias("suffix_rate"))
    d = domains.join(F.broadcast(_strength(domains).select("m"))).join(s, "suffix").select("domain", shrunk(F.col("suffix_rate")).alias("domain_rate"))
    return hosts, d, s, _strength(hosts)


def reputations(outcomes: DataFrame, host: str = "host", bad: str = "bad", z: float = 1.645) -> DataFrame:
    """(host, n_labelled, bad_rate, bad_low) for hosts with outcomes.

    outcomes: one row per labelled page. bad_rate is the posterior mean and bad_low its
    lower bound, z posterior standard deviations below. Counts are combined before any
    shuffle, so a hot host sends one row a task.
    """
    hosts, d, _, whole = _levels(outcomes, host, bad)
    h = hosts.join(F.broadcast(whole.select("m"))).join(d, "domain")
    found = _posterior(F.col("n"), F.col("bad"), F.col("domain_rate"), F.col("m"), z)
    return h.select("host", F.col("n").alias("n_labelled"), *(c.alias(k) for k, c in found.items()))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame, url_col: str = "url", threshold: float = 0.5, z: float = 1.645) -> DataFrame:
    """pages with host, path, rule, n_labelled, bad_rate, bad_low, verdict.

    outcomes: (url_col, bad boolean), one row per labelled page; rows with a null bad are
    ignored. verdict is the longest fitting rule's action, else block where the host's
    posterior lower bound reaches threshold, else allow; a host without outcomes has its
    domain's rate as its prior, else its suffix's, else the overall one, and the bound of
    that prior counts. A null or odd url has an empty host and path and is judged like any
    other host; very long ones are judged whole. Repeated rows are judged alike; an empty
    table gives an empty result. Columns of pages with the names of those added are
    replaced; all others are kept.
    """
    known = split_url(outcomes.where(F.col("bad").isNotNull()).select(F.col(url_col).alias("url"), "bad"), "url").select("host", "bad")
    hosts, domains, suffixes, whole = _levels(known, "host", "bad")
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict", "rule_action", "bad_rate", "bad_low", "n_labelled")]
    host_, n_, bad_, domain_, dr, suffix_, sr, m_, all_ = (free_name(f"__{c}", kept) for c in ("host", "n", "bad", "domain", "dr", "suffix", "sr", "m", "all"))
    counts = hosts.select(F.col("host").alias(host_), F.col("n").alias(n_), F.col("bad").alias(bad_))
    domains, suffixes = domains.select(F.col("domain").alias(domain_), F.col("domain_rate").alias(dr)), suffixes.select(F.col("suffix").alias(suffix_), F.col("suffix_rate").alias(sr))
    parts = match_rules(split_url(pages.select(*[f"`{c}`" for c in kept]), url_col), rules)
    unseen, (domain, suffix) = F.lit(0).cast("long"), domain_of(F.col("host"))
    out = parts.join(counts, F.col("host") == F.col(host_), "left").join(domains, domain == F.col(domain_), "left").join(suffixes, suffix == F.col(suffix_), "left")
    out = out.crossJoin(F.broadcast(whole.select(F.col("m").alias(m_), F.col("p").alias(all_))))
    n, prior = F.coalesce(n_, unseen), F.coalesce(dr, sr, all_)
    found = _posterior(n, F.coalesce(bad_, unseen), prior, F.col(m_), z)
    out = out.select(*[f"`{c}`" for c in parts.columns], n.alias("n_labelled"), *(c.alias(k) for k, c in found.items()))
    verdict = F.coalesce("rule_action", F.when(F.col("bad_low") >= threshold, "block").otherwise("allow"))
    return out.withColumn("verdict", verdict).drop("rule_action")

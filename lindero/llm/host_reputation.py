"""URL filters: fixed rules of hosts and paths, and the reputation of hosts where no rule decides.

A host's rate of bad pages is estimated by empirical Bayes, from the top down. All labelled pages give a mean; the rates
of suffixes scatter around it, those of registered domains around their suffix's, those of hosts around their domain's.
How much the rates of a level scatter gives the strength of its beta prior, by moments of the beta-binomial; a child's
posterior is its parent's posterior mean at that strength and its own counts; its variance is that of the beta and, as
far as it leans on its parent, the parent's. A host is blocked if a lower bound of its posterior exceeds the rate that is
borne: by the one-sided Chebyshev inequality at least ``confidence`` of the posterior lies above
mean - sqrt(confidence / (1 - confidence)) x deviation, whatever its shape.

Counts are aggregated before they are moved; hosts meet their domain, and pages their host, under salts.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import salted_lookup

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of more than one label under which names are registered; others are the last label. A parameter.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "com.mx", "com.ar", "co.in", "co.za", "com.tr", "com.cn")
#: A host is blocked if at least CONFIDENCE of its posterior lies above MOST_BAD.
MOST_BAD, CONFIDENCE = 0.5, 0.8
#: Limits of a level's correlation of pages: priors worth between 0.01 and 9,999 pages.
LEAST_RHO, MOST_RHO = 0.0001, 0.99


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str  # allow or block


RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))


def host_of(url: Column) -> Column:
    """What is between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """struct<rule, verdict> of the longest rule that fits, the first of equals; null if none does."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for r in sorted(reversed(rules), key=lambda r: len(r.host + r.path)):  # the longest comes last and asks first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def plain_host(host: Column) -> Column:
    """The host without user and port."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")


def suffix_of(host: Column, long_suffixes: tuple[str, ...] = LONG_SUFFIXES) -> Column:
    """The public suffix: one of ``long_suffixes`` or the last label; an address is its own."""
    bare = plain_host(host)
    two, one = F.substring_index(bare, ".", -2), F.substring_index(bare, ".", -1)
    address = bare.rlike(r"^(\d+\.){3}\d+$") | bare.startswith("[")
    return F.when(address, bare).when(two.isin(*long_suffixes), two).otherwise(one)


def domain_of(host: Column, long_suffixes: tuple[str, ...] = LONG_SUFFIXES) -> Column:
    """The registered domain: the suffix and one label more, if there is one."""
    bare, suffix = plain_host(host), suffix_of(host, long_suffixes)
    rest = F.substring(bare, F.lit(1), F.length(bare) - F.length(suffix) - 1)
    return F.when(F.length(bare) <= F.length(suffix), suffix).otherwise(F.concat(F.substring_index(rest, ".", -1), F.lit("."), suffix))


def _strength(children: DataFrame, n: str, bad: str, mean: str) -> DataFrame:
    """One row: the strength of the beta prior that children with these counts have around their parents' means."""
    v = F.col(mean) * (1 - F.col(mean))
    excess = F.sum((F.col(bad) - F.col(n) * F.col(mean)) ** 2 - F.col(n) * v)
    room = F.sum(F.col(n).cast("double") * (F.col(n) - 1) * v)
    rho = F.greatest(F.lit(LEAST_RHO), F.least(F.lit(MOST_RHO), F.coalesce(excess / F.nullif(room, F.lit(0.0)), F.lit(LEAST_RHO))))
    return children.agg((1 / rho - 1).alias("strength"))


def _posterior(children: DataFrame, n: str, bad: str, mean: str, variance: str) -> DataFrame:
    """``children`` with the mean and the variance of their posterior as columns ``rate`` and ``spread``; ``mean`` and
    ``variance`` are their parent's."""
    out = children.crossJoin(F.broadcast(_strength(children, n, bad, mean)))  # one row
    weight = F.col("strength") + F.col(n)
    out = out.withColumn("rate", (F.col("strength") * F.col(mean) + F.col(bad)) / weight)
    spread = F.col("rate") * (1 - F.col("rate")) / (weight + 1) + (F.col("strength") / weight) ** 2 * F.col(variance)
    return out.withColumn("spread", spread).drop("strength")


def lower_bound(rate: Column, spread: Column, confidence: float = CONFIDENCE) -> Column:
    """At least ``confidence`` of a distribution with this mean and variance lies above."""
    return rate - (confidence / (1 - confidence)) ** 0.5 * F.sqrt(spread)


def reputations(outcomes: DataFrame, hosts: DataFrame, long_suffixes: tuple[str, ...] = LONG_SUFFIXES) -> DataFrame:
    """host, n, bad, rate, spread for every host of ``hosts`` (host, distinct), from ``outcomes`` (host, n, bad: labelled
    pages and how many of them are bad). A host without labelled pages has its domain's rate, a domain without
    any its suffix's, at the prior's strength. Without any outcome all rates are 0."""
    known = outcomes.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    every = hosts.join(known.hint("merge"), "host", "left").na.fill(0, ["n", "bad"])
    every = every.withColumn("domain", domain_of(F.col("host"), long_suffixes)).withColumn("suffix", suffix_of(F.col("host"), long_suffixes))
    domains = every.groupBy("domain", "suffix").agg(F.sum("n").alias("dn"), F.sum("bad").alias("dbad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("dbad").alias("sbad"))
    total = suffixes.agg(F.coalesce(F.sum("sbad") / F.nullif(F.sum("sn"), F.lit(0)), F.lit(0.0)).alias("mean"), F.coalesce(F.sum("sn"), F.lit(0)).alias("all"))
    total = total.select("mean", (F.col("mean") * (1 - F.col("mean")) / (F.col("all") + 1)).alias("off"))
    s = _posterior(suffixes.crossJoin(F.broadcast(total)), "sn", "sbad", "mean", "off").select("suffix", F.col("rate").alias("srate"), F.col("spread").alias("soff"))
    d = _posterior(salted_lookup(domains, s, ["suffix"], F.col("domain"), how="inner"), "dn", "dbad", "srate", "soff").select("domain", F.col("rate").alias("drate"), F.col("spread").alias("doff"))
    out = _posterior(salted_lookup(every, d, ["domain"], F.col("host"), how="inner"), "n", "bad", "drate", "doff")
    return out.select("host", "n", "bad", "rate", "spread")


def judged(pages: DataFrame, bad_pages: DataFrame, rules: tuple[Rule, ...] = RULES, most_bad: float = MOST_BAD, confidence: float = CONFIDENCE, long_suffixes: tuple[str, ...] = LONG_SUFFIXES) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_rate, bad_at_least for every row of ``pages`` (page_id, url).

    ``bad_pages`` (page_id, bad) are the labelled outcomes; of several for one page any bad one counts, null ids and null
    outcomes count for nothing. A url that is null or without ``://`` has an empty host and path, meets no rule and is
    judged as the host "" with all others like it. Repeated pages are judged, and counted, each. An empty table gives no
    rows. Other columns are not read. A host with any share of the pages is counted before the shuffle and met in
    several tasks.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    told = bad_pages.filter("page_id is not null and bad is not null").groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    counted = rows.groupBy("page_id", "host").agg(F.count("*").alias("n"))
    outcomes = counted.join(told.hint("merge"), "page_id").select("host", "n", (F.col("n") * F.col("bad")).alias("bad"))
    found = reputations(outcomes, counted.select("host").distinct(), long_suffixes)
    bound = lower_bound(F.col("rate"), F.col("spread"), confidence)
    verdicts = found.select("host", F.col("rate").alias("bad_rate"), bound.alias("bad_at_least"))
    out = salted_lookup(rows, verdicts, ["host"], F.xxhash64("page_id", "path"), how="inner").withColumn("_r", rule_for(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce("_r.verdict", F.when(F.col("bad_at_least") > most_bad, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", F.col("_r.rule").alias("rule"), verdict.alias("verdict"), "bad_rate", "bad_at_least")


def outcomes_of(labels: DataFrame) -> DataFrame:
    """Outcomes from the table of labels: bad is what is of low quality or toxic."""
    return labels.select(F.col("doc_id").alias("page_id"), ((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).alias("bad"))


def sql(rules: tuple[Rule, ...] = RULES, most_bad: float = MOST_BAD, confidence: float = CONFIDENCE, long_suffixes: tuple[str, ...] = LONG_SUFFIXES) -> str:
    """The same in SQL, with the outcomes of :func:`outcomes_of`."""
    fits = [f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN " for r in sorted(rules, key=lambda r: -len(r.host + r.path))]
    longest = sorted(rules, key=lambda r: -len(r.host + r.path))
    rule = "CASE " + " ".join(f"{f}'{r.host}{r.path}'" for f, r in zip(fits, longest, strict=True)) + " END"
    verdict = "CASE " + " ".join(f"{f}'{r.verdict}'" for f, r in zip(fits, longest, strict=True)) + " END"

    def strength(name: str, table: str, n: str, bad: str, mean: str) -> str:
        rho = f"greatest({LEAST_RHO}, least({MOST_RHO}, coalesce(sum(({bad} - {n} * {mean}) ** 2 - {n} * {mean} * (1 - {mean})) / nullif(sum(CAST({n} AS DOUBLE) * ({n} - 1) * {mean} * (1 - {mean})), 0), {LEAST_RHO})))"
        return f"{name} AS (SELECT 1 / {rho} - 1 AS k FROM {table})"

    post = "(k * mean + bad) / (k + n) AS rate, rate * (1 - rate) / (k + n + 1) + (k / (k + n)) ** 2 * off AS spread"
    return rf"""WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    bare AS (SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':\d*$', '') AS b, string_split(b, '.') AS ls, regexp_matches(b, '^(\d+\.){{3}}\d+$') OR starts_with(b, '[') AS address FROM (SELECT DISTINCT host FROM u)),
    suf AS (SELECT *, CASE WHEN address THEN b WHEN array_to_string(ls[-2:], '.') IN ({", ".join(f"'{x}'" for x in long_suffixes)}) THEN array_to_string(ls[-2:], '.') ELSE ls[-1] END AS suffix FROM bare),
    dom AS (SELECT *, CASE WHEN length(b) <= length(suffix) THEN suffix ELSE string_split(b[1:length(b) - length(suffix) - 1], '.')[-1] || '.' || suffix END AS domain FROM suf),
    told AS (SELECT doc_id AS page_id, max((coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1)::INT) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
    o AS (SELECT host, count(*) AS n, sum(bad) AS bad FROM u JOIN told USING (page_id) GROUP BY 1),
    h AS (SELECT dom.host, domain, suffix, coalesce(n, 0) AS n, coalesce(bad, 0) AS bad FROM dom LEFT JOIN o USING (host)),
    d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY 1, 2), s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY 1),
    g AS (SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0) AS mean, coalesce(sum(n), 0) AS every FROM s), s1 AS (SELECT s.*, mean, mean * (1 - mean) / (every + 1) AS off FROM s, g), {strength("ks", "s1", "n", "bad", "mean")}, s2 AS (SELECT suffix, {post} FROM s1, ks),
    d1 AS (SELECT d.*, rate AS mean, spread AS off FROM d JOIN s2 USING (suffix)), {strength("kd", "d1", "n", "bad", "mean")}, d2 AS (SELECT domain, {post} FROM d1, kd),
    h1 AS (SELECT h.*, rate AS mean, spread AS off FROM h JOIN d2 USING (domain)), {strength("kh", "h1", "n", "bad", "mean")}, h2 AS (SELECT host, {post} FROM h1, kh)
    SELECT page_id, host, path, {rule} AS rule, coalesce({verdict}, CASE WHEN rate - {(confidence / (1 - confidence)) ** 0.5} * sqrt(spread) > {most_bad} THEN 'block' ELSE 'allow' END) AS verdict FROM u JOIN h2 USING (host)"""

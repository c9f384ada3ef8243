"""URL filters: explicit rules first, then an empirical-Bayes reputation of the host, with DataFrame functions only.

Labelled page outcomes (bad or not) are counted by host. Rates are shrunk downwards through beta-binomial priors: the
suffix towards the whole, the registered domain towards its suffix, the host towards its domain. The prior's weight is
fitted by moments from how much hosts differ, and is one page at least. A host is blocked if even the lower bound of its posterior bad rate is
over the limit. Counts are pre-aggregated by host, so that a host with most pages costs one row a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Standard deviations below the posterior mean where the bound lies, and the bad rate over which it blocks.
Z, LIMIT = 1.645, 0.5
# ---- fixed values ----
#: Labels under which countries register names.
SECOND = "ac co com edu gob gov go mil ne net or org sch".split()
# ---- end of fixed values ----
ADDRESS, TWO_LABELS = r"^([0-9]+([.][0-9]+){3}|\[.*)$", rf"(^|[.])({'|'.join(SECOND)})[.][a-z]{{2}}$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url: both empty if it is null or has no ://."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as host + path, and its verdict; null if none does. rules: (verdict, host, path).

    A rule list is configuration that becomes one expression; it is not meant for many thousands. Of equally long rules
    the one with the longer host wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]), r)):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def names(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix, without user and port. The suffix is the last label, or the last two where a country's
    code follows one of SECOND; the domain is one label more. An address in numbers or brackets is its own domain and
    suffix. This is a rule, not the list of public suffixes: places like a.github.io count as one domain."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    address, second = bare.rlike(ADDRESS), bare.rlike(TWO_LABELS)
    part = lambda n: F.substring_index(bare, ".", -n)
    return F.when(address, bare).when(second, part(3)).otherwise(part(2)), F.when(address, bare).when(second, part(2)).otherwise(part(1))


def reputations(outcomes: DataFrame, host: str = "host", bad: str = "bad", z: float = Z) -> DataFrame:
    """host, n, mean, bound for every host of outcomes. bad: 1, 0, or null for a page without a label, which counts for
    nothing but names its host. Without any label the rate is a half everywhere, with a prior weight of one page."""
    domain, suffix = names(F.col("host"))
    hosts = outcomes.groupBy(F.col(host).alias("host")).agg(F.count(bad).alias("n"), F.coalesce(F.sum(F.col(bad).cast("bigint")), F.lit(0)).alias("b")).select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "b")
    # one row: the rate, and the overdispersion of hosts by moments
    rate = hosts.agg(F.sum("n").alias("N"), F.sum("b").alias("B"), F.count(F.when(F.col("n") > 0, 1)).alias("G"), F.sum(F.col("n") * F.col("n")).alias("N2"), F.sum(F.when(F.col("n") > 0, F.col("b") * F.col("b") / F.col("n"))).alias("S2"))
    whole = rate.select(F.expr("(coalesce(B, 0) + 0.5D) / (coalesce(N, 0) + 1)").alias("mu"), F.expr("CASE WHEN G > 1 AND B > 0 AND B < N AND N - N2 / N - (G - 1) > 0 THEN greatest(0.001D, least(0.5D, (S2 - CAST(B AS DOUBLE) * B / N - B * (N - B) / (CAST(N AS DOUBLE) * N) * (G - 1)) / (B * (N - B) / (CAST(N AS DOUBLE) * N) * (N - N2 / N - (G - 1))))) ELSE 0.5D END").alias("phi")).select("mu", ((1 - F.col("phi")) / F.col("phi")).alias("k"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("ns"), F.sum("b").alias("bs")).crossJoin(F.broadcast(whole))  # one row
    suffixes = suffixes.select("suffix", "k", F.expr("(bs + k * mu) / (ns + k)").alias("ms"))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("nd"), F.sum("b").alias("bd")).join(suffixes, "suffix").select("domain", "k", F.expr("(bd + k * ms) / (nd + k)").alias("md"))
    out = hosts.join(domains, "domain").select("host", "n", F.expr("(b + k * md) / (n + k)").alias("mean"), (F.col("n") + F.col("k")).alias("w"))
    return out.select("host", "n", "mean", (F.col("mean") - z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("w") + 1))).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", url: str = "url", outcome_key: str = "page_id", bad: str = "bad", limit: float = LIMIT) -> DataFrame:
    """key, host, path, rule, verdict, bound for each row of pages.

    outcomes: outcome_key and bad (1 or 0); of several for a key the worst counts. Null urls, and those without ://, have
    empty host and path and are judged together. A null key has no outcome. Repeated rows are each judged, and counted.
    """
    host, path = host_path(F.col("u"))
    split = pages.select(pages[key].alias("k"), pages[url].cast("string").alias("u")).select("k", host.alias("host"), path.alias("path"))
    known = outcomes.groupBy(outcomes[outcome_key].alias("ok")).agg(F.max(bad).alias("bad"))
    reps = reputations(split.join(known, F.col("k") == F.col("ok"), "left").select("host", "bad"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return split.join(reps.select("host", "bound"), "host").select(F.col("k").alias(key), "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("bound") > limit, "block").otherwise("allow")).alias("verdict"), "bound")


ORACLE = f"""
WITH u AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
known AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
h0 AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS b, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare FROM p LEFT JOIN known ON page_id = doc_id GROUP BY host),
h1 AS (SELECT *, CASE WHEN regexp_matches(bare, '{ADDRESS.replace("{", "{{").replace("}", "}}")}') THEN 9 WHEN regexp_matches(bare, '{TWO_LABELS.replace("{", "{{").replace("}", "}}")}') THEN 2 ELSE 1 END AS c FROM h0),
h AS (SELECT *, array_to_string(string_split(bare, '.')[-1 - c:], '.') AS domain, array_to_string(string_split(bare, '.')[-c:], '.') AS suffix FROM h1),
r AS (SELECT sum(n)::DOUBLE AS N_, sum(b)::DOUBLE AS B_, count(*) FILTER (WHERE n > 0) AS G, sum(n * n)::DOUBLE AS N2, sum(CASE WHEN n > 0 THEN b * b / n::DOUBLE END) AS S2 FROM h),
f AS (SELECT (coalesce(B_, 0) + 0.5) / (coalesce(N_, 0) + 1) AS mu, CASE WHEN G > 1 AND B_ > 0 AND B_ < N_ AND N_ - N2 / N_ - (G - 1) > 0
  THEN greatest(0.001, least(0.5, (S2 - B_ * B_ / N_ - B_ * (N_ - B_) / (N_ * N_) * (G - 1)) / (B_ * (N_ - B_) / (N_ * N_) * (N_ - N2 / N_ - (G - 1))))) ELSE 0.5 END AS phi FROM r),
k AS (SELECT mu::DOUBLE AS mu, ((1 - phi) / phi)::DOUBLE AS k FROM f),
s AS (SELECT suffix, k, (bs + k * mu) / (ns + k) AS ms FROM (SELECT suffix, sum(n)::DOUBLE AS ns, sum(b)::DOUBLE AS bs FROM h GROUP BY suffix), k),
d AS (SELECT domain, k, (bd + k * ms) / (nd + k) AS md FROM (SELECT domain, suffix, sum(n)::DOUBLE AS nd, sum(b)::DOUBLE AS bd FROM h GROUP BY domain, suffix) JOIN s USING (suffix)),
m AS (SELECT host, (b + k * md) / (n + k) AS mean, n + k AS w FROM h JOIN d USING (domain)),
rules(v, rh, rp) AS (VALUES {{rules}}),
best AS (SELECT host, path, arg_max(rh || rp, length(rh || rp) * 1000 + length(rh)) AS rule, arg_max(v, length(rh || rp) * 1000 + length(rh)) AS v
  FROM (SELECT DISTINCT host, path FROM p) JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path)
SELECT page_id, p.host, p.path, rule, coalesce(v, CASE WHEN mean - {Z} * sqrt(mean * (1 - mean) / (w + 1)) > {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM p JOIN m ON p.host = m.host LEFT JOIN best ON best.host = p.host AND best.path = p.path
"""

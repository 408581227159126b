"""Url filter by host reputation: empirical Bayes from suffix to registered domain to host. DataFrame only.

Pages with a label give outcomes (bad or not). The bad share of a host is shrunk through beta-binomial
priors: the suffix towards the share of all labelled pages, the registered domain towards its suffix, the
host towards its domain. The strength of each prior is estimated by the method of moments from the spread
of the units below it; it is never less than two pages, nor more than what is known of the level above. A page is blocked if the lower posterior bound of its host's bad share (mean less
``z`` standard deviations) lies above ``threshold``; hosts without labels inherit the posterior mean of the
nearest level that has some, and the bound then rests on that level's own posterior.
Explicit rules (host, path, verdict) go first; the longest that fits decides.

Contract: one row per page row, repeated rows included. A null url or one without ``://`` has an empty host
and path, fits no rule and is judged as the host "". Pages without labels change no statistic; a page id
with several labels counts each of them. Without any label nothing is blocked. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm.common import table

#: (host, path, verdict); a rule's text is host + path.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

#: Second-level labels that belong to the suffix below a two-letter top level, as in ``co.uk``.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_column(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, else null."""
    text = verdict = None
    for at, under, what in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(under)
        text = F.when(fits, at + under) if text is None else text.when(fits, at + under)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    if text is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return text, verdict


def levels(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host without its port; an address stands for itself."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    parts = F.split(bare, "\\.")
    n = F.size(parts)
    second = (n >= 3) & (F.length(F.element_at(parts, -1)) == 2) & F.element_at(parts, F.when(n >= 2, F.lit(-2)).otherwise(F.lit(-1))).isin(*SECOND_LEVEL)
    width = F.when(second, 2).otherwise(1)
    whole = bare.rlike("^[0-9.]+$") | (n <= 1)
    suffix = F.when(whole, bare).otherwise(F.array_join(F.slice(parts, n - width + 1, width), "."))
    domain = F.when(whole, bare).otherwise(F.array_join(F.slice(parts, n - F.least(width, n - 1), F.least(width + 1, n)), "."))
    return domain, suffix


def _strength(units: DataFrame, low: float = 2.0, high: float = 1000.0) -> DataFrame:
    """One row: size of the beta prior of units (n, bad, prior mean m), by moments.

    With p = bad / n, the scaled spread sum(n (p - m)^2 / (m (1 - m))) of k units has the expectation
    sum(1 + (n - 1) rho); rho = 1 / (size + 1).
    """
    var = F.col("m") * (1 - F.col("m"))
    spread = F.sum(F.when(var > 0, F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("m"), 2) / var))
    pairs, k = F.sum(F.when(var > 0, F.col("n") - 1)), F.sum(F.when(var > 0, 1))
    rho = F.greatest(F.lit(1.0 / (high + 1)), F.least(F.lit(1.0 / (low + 1)), (spread - k) / F.nullif(pairs, F.lit(0))))
    return units.agg(F.coalesce(F.when(pairs > 0, 1 / rho - 1), F.lit(high)).alias("size"))


def _posterior(units: DataFrame) -> DataFrame:
    """Adds the posterior (a, b) of units that carry n, bad, the prior mean m and its weight ``known``, in pages."""
    return (units.withColumn("size", F.least(_strength(units).scalar(), F.col("known")))
            .withColumn("a", F.col("bad") + F.col("size") * F.col("m"))
            .withColumn("b", F.col("n") - F.col("bad") + F.col("size") * (1 - F.col("m"))))


def _mean() -> Column:
    return F.col("a") / (F.col("a") + F.col("b"))


def reputation(outcomes: DataFrame, hosts: DataFrame) -> DataFrame:
    """Posterior (a, b) of the bad share for every row of ``hosts`` (host, domain, suffix).

    ``outcomes`` holds one row per labelled page: host, domain, suffix, bad (0 or 1).
    """
    counts = outcomes.groupBy("host", "domain", "suffix").agg(F.count("*").cast("double").alias("n"), F.sum("bad").cast("double").alias("bad"))
    by_domain = counts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    by_suffix = by_domain.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    overall = by_suffix.agg(((F.sum("bad") + 0.5) / (F.sum("n") + 1)).alias("m0"), F.sum("n").alias("n0"))

    suffixes = _posterior(by_suffix.withColumns({"m": overall.select("m0").scalar(), "known": overall.select("n0").scalar() + 1}))
    suffixes = suffixes.select("suffix", F.col("a").alias("sa"), F.col("b").alias("sb"), _mean().alias("sm"))
    domains = _posterior(by_domain.join(suffixes, "suffix").withColumns({"m": F.col("sm"), "known": F.col("sa") + F.col("sb")}))
    domains = domains.select("domain", "suffix", F.col("a").alias("da"), F.col("b").alias("db"), _mean().alias("dm"))
    own = _posterior(counts.join(domains, ["domain", "suffix"]).withColumns({"m": F.col("dm"), "known": F.col("da") + F.col("db")}))
    own = own.select("host", F.col("a").alias("ha"), F.col("b").alias("hb"))

    share = F.coalesce(overall.select("m0").scalar(), F.lit(0.5))
    labelled = F.coalesce(overall.select("n0").scalar(), F.lit(0.0))
    placed = (hosts.join(own, "host", "left").join(domains.select("domain", "da", "db"), "domain", "left")
              .join(suffixes.select("suffix", "sa", "sb"), "suffix", "left"))
    return placed.select(
        "host",
        F.coalesce("ha", "da", "sa", share * labelled + 0.5).alias("a"),
        F.coalesce("hb", "db", "sb", (1 - share) * labelled + 0.5).alias("b"))


def filter_urls(pages: DataFrame, labels: DataFrame, threshold: float = 0.5, z: float = 1.645, rules=RULES) -> DataFrame:
    """Host, path, rule and verdict of every page.

    ``pages`` has page_id and url; ``labels`` has doc_id (the page's id), quality and toxic. A labelled page
    is bad if its quality is 0 or it is toxic.
    """
    host, path = split_url(F.col("url"))
    judged = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    domain, suffix = levels(F.col("host"))
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    marks = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")).where("bad is not null")
    outcomes = judged.join(marks, "page_id").select("host", domain.alias("domain"), suffix.alias("suffix"), "bad")
    hosts = judged.select("host").distinct().select("host", domain.alias("domain"), suffix.alias("suffix"))

    total = F.col("a") + F.col("b")
    deviation = F.sqrt(F.col("a") * F.col("b") / (total * total * (total + 1)))
    known = reputation(outcomes, hosts).select("host", (F.col("a") / total - z * deviation > threshold).alias("bad_host"))

    rule, verdict = rule_column(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("bad_host"), "block").otherwise("allow")
    return judged.join(known, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_method).alias("verdict"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages."""
    return filter_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


_LEVEL = """
regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '')"""

#: The same in DuckDB.
OP3_SQL = f"""
with judged as (
  select page_id,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}'), '') host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') path
  from (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end rest from pages)),
parts as (
  select host, bare, string_split(bare, '.') p, len(string_split(bare, '.')) n
  from (select distinct host, {_LEVEL} bare from judged)),
named as (
  select host,
    case when bare similar to '[0-9.]+' or n <= 1 then bare else array_to_string(p[n - w + 1:n], '.') end suffix,
    case when bare similar to '[0-9.]+' or n <= 1 then bare else array_to_string(p[greatest(n - w, 1):n], '.') end as domain
  from (select *, case when n >= 3 and length(p[n]) = 2 and p[n - 1] in {SECOND_LEVEL} then 2 else 1 end w from parts)),
outcomes as (
  select host, suffix, domain, case when quality = 0 or toxic = 1 then 1 else 0 end bad
  from judged join named using (host) join labels on labels.doc_id = page_id
  where quality is not null or toxic is not null),
hosts as (select host, domain, suffix, count(*)::double n, sum(bad)::double bad from outcomes group by all),
domains as (select domain, suffix, sum(n) n, sum(bad) bad from hosts group by all),
suffixes as (select suffix, sum(n) n, sum(bad) bad from domains group by all),
overall as (select (sum(bad) + 0.5) / (sum(n) + 1) m0, coalesce(sum(n), 0) n0 from suffixes),
size1 as (select coalesce(case when sum(n - 1) filter (v > 0) > 0 then 1 / greatest(1.0 / 1001, least(1.0 / 3,
    (sum(n * (bad / n - m) ** 2 / v) filter (v > 0) - count(*) filter (v > 0)) / sum(n - 1) filter (v > 0))) - 1 end, 1000.0) size
  from (select *, m0 m, m0 * (1 - m0) v from suffixes, overall)),
post1 as (select suffix, bad + least(size, n0 + 1) * m0 a, n - bad + least(size, n0 + 1) * (1 - m0) b from suffixes, overall, size1),
under1 as (select d.*, a / (a + b) m, a + b known from domains d join post1 using (suffix)),
size2 as (select coalesce(case when sum(n - 1) filter (v > 0) > 0 then 1 / greatest(1.0 / 1001, least(1.0 / 3,
    (sum(n * (bad / n - m) ** 2 / v) filter (v > 0) - count(*) filter (v > 0)) / sum(n - 1) filter (v > 0))) - 1 end, 1000.0) size
  from (select *, m * (1 - m) v from under1)),
post2 as (select domain, bad + least(size, known) * m a, n - bad + least(size, known) * (1 - m) b from under1, size2),
under2 as (select h.*, a / (a + b) m, a + b known from hosts h join post2 using (domain)),
size3 as (select coalesce(case when sum(n - 1) filter (v > 0) > 0 then 1 / greatest(1.0 / 1001, least(1.0 / 3,
    (sum(n * (bad / n - m) ** 2 / v) filter (v > 0) - count(*) filter (v > 0)) / sum(n - 1) filter (v > 0))) - 1 end, 1000.0) size
  from (select *, m * (1 - m) v from under2)),
post3 as (select host, bad + least(size, known) * m a, n - bad + least(size, known) * (1 - m) b from under2, size3),
placed as (
  select named.host,
    coalesce(post3.a, post2.a, post1.a, coalesce(m0, 0.5) * n0 + 0.5) a,
    coalesce(post3.b, post2.b, post1.b, (1 - coalesce(m0, 0.5)) * n0 + 0.5) b
  from named left join post3 using (host) left join post2 on post2.domain = named.domain
    left join post1 on post1.suffix = named.suffix, overall),
ruled as (
  select *, case when host = 'www.example.com' or host like '%.www.example.com' then starts_with(path, '/en/') else false end r1,
    (host = 'example.com' or host like '%.example.com') and starts_with(path, '/en/') r2,
    (host = 'net' or host like '%.net') and starts_with(path, '/es/') r3,
    (host = 'net' or host like '%.net') and starts_with(path, '/fr/') r4,
    (host = 'com' or host like '%.com') and starts_with(path, '/') r5
  from judged)
select page_id, host, path,
  case when r1 then 'www.example.com/en/' when r2 then 'example.com/en/' when r3 then 'net/es/' when r4 then 'net/fr/' when r5 then 'com/' end rule,
  case when r1 then 'allow' when r2 then 'block' when r3 then 'block' when r4 then 'block' when r5 then 'allow'
    when a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5 then 'block' else 'allow' end verdict
from ruled join placed using (host)
"""

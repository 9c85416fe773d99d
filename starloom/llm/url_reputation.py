"""URL filter by empirical-Bayes host reputation.

Labelled page outcomes (a url and whether its page is bad) are counted per
host, registered domain and suffix. The share of bad pages of each is shrunk
level by level: the whole table's share is the prior mean of every suffix, a
suffix's posterior mean that of its domains, a domain's that of its hosts.
Each level's prior is a beta distribution whose strength is estimated from the
spread of the labelled shares at that level (method of moments for the
beta-binomial), so hosts with few labels stay near their domain. A host is
blocked if its posterior mean less ``Z`` posterior standard deviations - a
lower bound - is above ``MAX_BAD``; hosts without labels take their domain's,
then their suffix's, then the table's figures.

Rules come first: a rule is a host and a path start; it fits the host and all
its subdomains; of the rules that fit a url the longest decides.

Only counts per host are shuffled and they are pre-aggregated, so a host with
a third of all pages is a few rows; verdicts are joined back by host.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule, and is judged like a host without labels; repeated rows
get the same verdict; no labels at all: everything without a rule is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import without

Z = 1.645
MAX_BAD = 0.5
DEFAULT_STRENGTH = 10.0
LEVELS = ("suffix", "domain", "host")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = r"(?s)://([^/?#]*)([^?#]*)"
# second-level names that count as part of the suffix below a country's two letters
_SECOND = r"(?:co|com|org|net|ac|gov|edu)\.[a-z]{2}"

# The rules of the contract, (text, verdict).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _SPLIT, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def _bare(host: Column) -> Column:
    """A host without user, port and closing dot."""
    return F.regexp_replace(F.regexp_replace(host, r"^[^@]*@", ""), r"\.?(?::\d*)?$", "")


def suffix_of(host: Column) -> Column:
    return F.regexp_extract(_bare(host), rf"({_SECOND}|[^.]*)$", 1)


def domain_of(host: Column) -> Column:
    return F.regexp_extract(_bare(host), rf"([^.]+\.(?:{_SECOND}|[^.]*)|[^.]*)$", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Text of the longest rule that fits, else null (``rules``: a short list)."""
    out = F.lit(None).cast("string")
    for text, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, start = text.split("/", 1)
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        out = F.when(fits, F.lit(text)).otherwise(out)
    return out


def _strength(s: DataFrame) -> float:
    """Prior strength of one level: ``s`` has n labelled and y bad pages per group."""
    r = s.agg(F.count(F.lit(1)).alias("g"), F.sum("n").alias("n"), F.sum("y").alias("y"), F.sum(F.col("n").cast("double") * F.col("n")).alias("n2"), F.sum(F.col("y").cast("double") * F.col("y") / F.col("n")).alias("y2n")).first()
    if not r["n"] or r["g"] < 2 or not 0 < r["y"] < r["n"]:
        return DEFAULT_STRENGTH
    p = r["y"] / r["n"]
    spread = r["y2n"] - r["n"] * p * p  # sum of n (share - p)^2
    room = r["n"] - r["n2"] / r["n"] - (r["g"] - 1)
    rho = (spread / (p * (1 - p)) - (r["g"] - 1)) / room if room > 0 else 0.0
    rho = min(max(rho, 1e-3), 0.999)
    return (1 - rho) / rho


def reputation(outcomes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, tuple[float, float]]:
    """``outcomes`` (host, bad 0/1) -> per suffix, domain and host the
    posterior ``mean`` and ``strength``; and those of an unknown suffix."""
    hosts = outcomes.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("y"))
    hosts = hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("y").alias("y")).first()
    overall = (total["y"] or 0) / total["n"] if total["n"] else 0.0

    def shrink(s: DataFrame, prior: Column, strength: float) -> DataFrame:
        k = F.lit(strength)
        return s.withColumn("mean", (F.col("y") + k * prior) / (F.col("n") + k)).withColumn("strength", F.col("n") + k)

    ks, kd, kh = _strength(suffixes), _strength(domains), _strength(hosts)
    s = shrink(suffixes, F.lit(overall), ks).select("suffix", "mean", "strength")
    d = shrink(domains.join(s.select("suffix", F.col("mean").alias("above")), "suffix"), F.col("above"), kd).select("domain", "mean", "strength")
    h = shrink(hosts.join(d.select("domain", F.col("mean").alias("above")), "domain"), F.col("above"), kh).select("host", "mean", "strength")
    return s, d, h, (overall, ks)


def lower_bound(mean: Column, strength: Column) -> Column:
    """Posterior mean less Z posterior standard deviations of a beta distribution."""
    return mean - Z * F.sqrt(mean * (1 - mean) / (strength + 1))


def judge(pages: DataFrame, outcomes: DataFrame, url_col: str = "url", rules=RULES, max_bad: float = MAX_BAD) -> DataFrame:
    """``pages`` with host, path, rule, bad_share, bad_bound, verdict.
    ``outcomes``: (url, bad 0/1) of labelled pages; rows without either are left out."""
    labelled = outcomes.where("bad in (0, 1) and url is not null").select(host_of(F.col("url")).alias("host"), "bad").where("host <> ''")
    s, d, h, (overall, strength) = reputation(labelled)
    src = without(pages, "host", "path", "rule", "bad_share", "bad_bound", "verdict", "_at")
    rows = src.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    names = rows.select("host").distinct().withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    level = lambda t, key: t.select(key, F.struct("mean", "strength").alias(f"_{key}"))
    known = names.join(level(h, "host"), "host", "left").join(level(d, "domain"), "domain", "left").join(level(s, "suffix"), "suffix", "left")
    best = F.coalesce("_host", "_domain", "_suffix", F.struct(F.lit(float(overall)).alias("mean"), F.lit(float(strength)).alias("strength")))
    known = known.select(F.col("host").alias("_name"), F.struct(best["mean"].alias("mean"), lower_bound(best["mean"], best["strength"]).alias("bound")).alias("_at"))
    out = rows.join(known, F.col("host") == F.col("_name")).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for text, verdict in rules:
        by_rule = F.when(F.col("rule") == text, F.lit(verdict)).otherwise(by_rule)
    verdict = F.coalesce(by_rule, F.when(F.col("_at.bound") > max_bad, "block").otherwise("allow"))
    return out.select(*[F.col(f"`{c}`") for c in src.columns], "host", "path", "rule", F.col("_at.mean").alias("bad_share"), F.col("_at.bound").alias("bad_bound"), verdict.alias("verdict"))


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Stand-in for a table of labelled crawls: (url, bad) of the pages whose
    id has a label; bad means low quality or toxic."""
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int")
    marked = labels.where("quality is not null or toxic is not null").groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad).alias("bad"))
    return pages.select("page_id", "url").join(marked, "page_id").select("url", "bad")


def digests(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    p = pages.select("page_id", "url")
    return judge(p, outcomes(p, labels)).select("page_id", "host", "path", "rule", "verdict")


SQL = rf"""
WITH p AS (
  SELECT page_id, url, coalesce(translate(regexp_extract(url, '(?s)://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '(?s)://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
marked AS (
  SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
bare AS (SELECT DISTINCT host, regexp_replace(regexp_replace(host, '^[^@]*@', ''), '\.?(?::\d*)?$', '') AS b FROM p),
names AS (
  SELECT host, regexp_extract(b, '({_SECOND}|[^.]*)$', 1) AS suffix,
         regexp_extract(b, '([^.]+\.(?:{_SECOND}|[^.]*)|[^.]*)$', 1) AS domain FROM bare),
h AS (
  SELECT host, domain, suffix, count(*) AS n, sum(bad) AS y
  FROM p JOIN marked USING (page_id) JOIN names USING (host) WHERE host <> '' GROUP BY ALL),
d AS (SELECT domain, suffix, sum(n) AS n, sum(y) AS y FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(y) AS y FROM d GROUP BY ALL),
levels AS (
  SELECT 'h' AS l, n, y FROM h UNION ALL SELECT 'd', n, y FROM d UNION ALL SELECT 's', n, y FROM s),
sums AS (
  SELECT l, count(*) AS g, sum(n)::DOUBLE AS n, sum(y)::DOUBLE AS y, sum(n::DOUBLE * n) AS n2, sum(y::DOUBLE * y / n) AS y2n FROM levels GROUP BY l),
k AS (
  SELECT l, CASE WHEN n = 0 OR g < 2 OR y = 0 OR y = n THEN {DEFAULT_STRENGTH} ELSE (1 - rho) / rho END AS k
  FROM (SELECT *, least(greatest(CASE WHEN n - n2 / n - (g - 1) > 0 THEN ((y2n - y * y / n) / ((y / n) * (1 - y / n)) - (g - 1)) / (n - n2 / n - (g - 1)) ELSE 0 END, 0.001), 0.999) AS rho FROM sums)),
top AS (SELECT coalesce(sum(y)::DOUBLE / nullif(sum(n), 0), 0) AS m FROM s),
ks AS (SELECT coalesce(max(k), {DEFAULT_STRENGTH}) AS k FROM k WHERE l = 's'),
sp AS (SELECT suffix, (y + ks.k * top.m) / (n + ks.k) AS m, n + ks.k AS w FROM s, top, ks),
dp AS (SELECT domain, (y + k * sp.m) / (n + k) AS m, n + k AS w FROM d JOIN sp USING (suffix), k WHERE l = 'd'),
hp AS (SELECT host, (y + k * dp.m) / (n + k) AS m, n + k AS w FROM h JOIN dp USING (domain), k WHERE l = 'h'),
judged AS (
  SELECT names.host, coalesce(hp.m, dp.m, sp.m, top.m) AS m,
         CASE WHEN hp.m IS NOT NULL THEN hp.w WHEN dp.m IS NOT NULL THEN dp.w WHEN sp.m IS NOT NULL THEN sp.w ELSE ks.k END AS w
  FROM names LEFT JOIN hp USING (host) LEFT JOIN dp USING (domain) LEFT JOIN sp USING (suffix), top, ks),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN m - {Z} * sqrt(m * (1 - m) / (w + 1)) > {MAX_BAD} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN judged USING (host)
"""

"""URL filter: fixed allow / block rules, then an empirical-Bayes host reputation.

Labelled page outcomes (bad or not) are counted by host.  The bad rate of a
level (global, suffix, registered domain, host) is a beta posterior whose prior
is the beta posterior mean of the level above without the member's own outcomes,
with the strength (prior sample size) of each level fitted by the method of
moments from the spread of its members' rates.  A page is blocked if the lower posterior bound of its host's
bad rate is above a limit: hosts with few outcomes lean on their domain, and a
host without any takes its domain's or suffix's posterior.

Defined results: a null url, or one without ``://``, has an empty host and path
and no rule; such pages share one reputation.  An outcome of a page id that
occurs more than once counts once for each such page.  Pages with null ids are
judged but can have no outcome.  Without any outcomes nothing is blocked by the
method.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

# (verdict, host, path): a rule fits its host and all subdomains, if the url's path starts with its path
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
MAX_BAD_RATE = 0.3   # a host is blocked if its bad rate is above this ...
BOUND_SDS = 1.0      # ... by so many posterior standard deviations
PRIOR_OUTCOMES = 2.0   # outcomes that the Beta(1, 1) prior of the global rate counts as
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0
HOST_SALTS = 32


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_of(host: Column) -> Column:
    """The registered domain: the last two labels, or three under a country's shared second level (``co.uk``)."""
    shared = host.rlike(r"\.(ac|co|com|edu|gov|net|org)\.[a-z]{2}$")
    return F.when(shared, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def suffix_of(host: Column) -> Column:
    """The registered domain without its first label (a host of one label is its own suffix)."""
    domain = domain_of(host)
    return F.when(domain.contains("."), F.regexp_replace(domain, r"^[^.]*\.", "")).otherwise(domain)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule, as ``host`` + ``path``, and its verdict; nulls if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _shrink(joined: DataFrame, by: str) -> DataFrame:
    """Posterior (alpha, beta) of each member of ``joined`` (by, n, bad, m), where m is the mean of the level above.

    Method of moments: with prior mean m, a member's squared distance from m is
    m (1 - m) (1 + rho (n - 1)) / n, with rho = 1 / (strength + 1) from the
    spread.  The strength is one figure for the whole level.
    """
    var = F.col("m") * (1 - F.col("m"))
    distance = F.col("n") * (F.col("bad") / F.col("n") - F.col("m")) ** 2 - var
    rho = joined.agg(F.try_divide(F.sum(distance), F.sum((F.col("n") - 1) * var))).first()[0]
    s = min(MAX_STRENGTH, max(MIN_STRENGTH, 1 / rho - 1)) if rho and rho > 0 else MAX_STRENGTH
    return saved(joined.select(by, (F.col("m") * s + F.col("bad")).alias("alpha"),
                               ((1 - F.col("m")) * s + F.col("n") - F.col("bad")).alias("beta")), f"reputation-{by}")


def reputation(outcomes: DataFrame) -> dict:
    """Beta posteriors by level, from ``outcomes`` (host, bad 0 / 1): frames of (key, alpha, beta), and a pair for all."""
    counted = F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")
    again = F.sum("n").alias("n"), F.sum("bad").alias("bad")
    hosts = saved(outcomes.groupBy("host").agg(*counted).select(
        "host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "bad"),
        "reputation-hosts")
    domains = hosts.groupBy("domain", "suffix").agg(*again)
    suffixes = domains.groupBy("suffix").agg(*again)
    n, bad = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    world = PRIOR_OUTCOMES / 2 + bad, PRIOR_OUTCOMES / 2 + n - bad
    def mean(alpha, beta):  # of the level above without the member itself, whose outcomes would count twice
        return (alpha - F.col("bad")) / (alpha + beta - F.col("n"))

    above = mean(F.col("alpha"), F.col("beta"))
    by_suffix = _shrink(suffixes.withColumn("m", mean(F.lit(world[0]), F.lit(world[1]))), "suffix")
    by_domain = _shrink(domains.join(by_suffix, "suffix").withColumn("m", above), "domain")
    by_host = _shrink(hosts.join(by_domain, "domain").withColumn("m", above), "host")
    return {"all": world, "suffix": by_suffix, "domain": by_domain, "host": by_host}


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, max_bad_rate: float = MAX_BAD_RATE,
          sds: float = BOUND_SDS) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_rate (posterior mean), bound (lower), level, for each page.

    ``labels``: doc_id (the page's id), quality, toxic; an outcome is bad if the quality is 0 or it is toxic.
    """
    base = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    bad = F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False)).cast("long")
    # labels repeated for an id count as one outcome, bad if any of them is
    outcome = labels.where("quality IS NOT NULL OR toxic IS NOT NULL").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    levels = reputation(base.select("page_id", "host").join(outcome, F.col("page_id") == F.col("doc_id"))
                        .select("host", "bad"))
    # reputations are joined to distinct hosts first: the pages then take one join, on the host
    hosts = base.select("host").distinct().select(
        "host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"))
    for name in ("host", "domain", "suffix"):
        post = levels[name].select(name, F.struct(F.lit(name).alias("level"), "alpha", "beta").alias(f"at_{name}"))
        hosts = hosts.join(post, name, "left")
    world = F.struct(F.lit("all").alias("level"), *(F.lit(x).alias(k) for k, x in zip(("alpha", "beta"), levels["all"])))
    best = hosts.select("host", F.coalesce("at_host", "at_domain", "at_suffix", world).alias("p")).select(
        "host", "p.level", (F.col("p.alpha") / (F.col("p.alpha") + F.col("p.beta"))).alias("bad_rate"),
        (F.col("p.alpha") + F.col("p.beta") + 1).alias("weight"))
    bound = F.col("bad_rate") - sds * F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / F.col("weight"))
    best = best.select("host", "level", "bad_rate", bound.alias("bound"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bound") > max_bad_rate, "block").otherwise("allow")
    # a host may have a third of all pages: its rows are spread over the salts, each with a copy of the host's row
    best = best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(HOST_SALTS - 1))))
    base = base.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(HOST_SALTS)).cast("int"))
    return base.join(best, ["host", "salt"]).select("page_id", "host", "path", rule.alias("rule"),
                                          F.coalesce(verdict, method).alias("verdict"), "bad_rate", "bound", "level")

"""URL filter by empirical-Bayes host reputation.

Labelled pages give each host its good and bad outcomes. A host's rate is shrunk towards its registered
domain's, that towards its suffix's, that towards the whole: each level's posterior mean is the mean of
the beta prior one level down, and the prior's weight (in pages) is fitted at each level by the method of
moments. A host is blocked if it is bad with confidence: if the upper bound of its posterior good rate, a
quantile of its beta distribution, lies under a threshold. Hand-written rules come first."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


RULES = (
    UrlRule("com", "/en/", "block"),
    UrlRule("example.com", "/en/7", "allow"),
    UrlRule("net", "/de/", "allow"),
    UrlRule("example.net", "/de/8", "block"),
    UrlRule("org", "/es/", "block"),
)
#: Suffixes of two labels under which domains are registered, by country (a parameter; others have one label).
LONG_SUFFIXES = tuple(
    f"{second}.{country}"
    for country, seconds in {
        "ae": "ac co gov net org sch", "ar": "com edu gob gov int mil net org", "at": "ac co gv or", "au": "asn com edu gov id net org", "bd": "ac com edu gov net org",
        "br": "art blog com edu eco gov jus leg mil net org", "cn": "ac com edu gov mil net org", "co": "com edu gov mil net nom org", "cr": "ac co ed fi go or", "cy": "ac com gov net org",
        "ec": "com edu fin gob gov net org", "eg": "com edu gov net org sci", "es": "com edu gob nom org", "fr": "asso com gouv nom", "gh": "com edu gov org", "gr": "com edu gov net org",
        "hk": "com edu gov idv net org", "hu": "co org", "id": "ac co go mil net or sch web", "il": "ac co gov k12 muni net org", "in": "ac co edu firm gen gov ind mil net nic org res",
        "ir": "ac co gov net org sch", "it": "edu gov", "jp": "ac ad co ed go gr lg ne or", "ke": "ac co go ne or sc", "kr": "ac co go hs kg mil ms ne or pe re sc", "lk": "ac com edu gov org",
        "ma": "ac co gov net org", "mx": "com edu gob net org", "my": "com edu gov mil name net org", "ng": "com edu gov net org sch", "np": "com edu gov net org", "nz": "ac co cri geek gen govt iwi maori mil net org school",
        "pe": "com edu gob mil net nom org", "ph": "com edu gov mil net org", "pk": "com edu gov net org", "pl": "com edu gov info net org waw", "pt": "com edu gov org", "py": "com edu gov org",
        "ro": "com org", "rs": "ac co edu gov org", "ru": "com edu gov msk net org spb", "sa": "com edu gov net org sch", "sg": "com edu gov net org per", "th": "ac co go in mi net or",
        "tr": "av bel com edu gen gov k12 mil name net org pol web", "tw": "com edu gov idv mil net org", "tz": "ac co go ne or", "ua": "com edu gov in kiev kyiv lviv net org", "ug": "ac co go or sc",
        "uk": "ac co gov ltd me net nhs org plc police sch", "uy": "com edu gub net org", "ve": "co com edu gob gov net org", "vn": "ac com edu gov net org", "za": "ac co edu gov law mil net nom org school web", "zw": "ac co gov org",
    }.items()
    for second in seconds.split()
)
CONFIDENCE = 0.95  #: one-sided, of the bounds
#: Steps and terms of the bounds: the quantile's interval is halved so often; the fraction has so many levels.
HALVINGS, LEVELS = 40, 60
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1000.0


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty if there is none."""
    rest = F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    hits = [F.when(((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path), F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in ordered]
    return F.coalesce(*hits)


def name_of(host: Column) -> Column:
    """A host as written in a url without a user before it, a port after it and a root dot at its end."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), "\\.?(:[0-9]*)?$", "")


def is_address(host: Column) -> Column:
    """Whether a host is an IP address, which has no domain: it is a suffix of its own."""
    return host.rlike("^([0-9]{1,3}\\.){3}[0-9]{1,3}$") | host.startswith("[")


def suffix_of(host: Column, suffixes: tuple[str, ...] = LONG_SUFFIXES) -> Column:
    parts = F.split(host, "\\.")
    two = F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), ".")
    return F.when(is_address(host), host).when(two.isin(*suffixes), two).otherwise(F.element_at(parts, -1))


def domain_of(host: Column, suffixes: tuple[str, ...] = LONG_SUFFIXES) -> Column:
    """The suffix and one label before it; the host itself if it has no more."""
    parts, n = F.split(host, "\\."), F.size(F.split(suffix_of(host, suffixes), "\\."))
    return F.when(is_address(host), host).otherwise(F.array_join(F.slice(parts, F.greatest(F.size(parts) - n, F.lit(1)), n + 1), "."))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series, from x + 8 on."""
    shift = np.log(np.prod([x + k for k in range(8)], axis=0))
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def beta_below(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The chance that a beta variable is below x: the regularised incomplete beta function, by its continued
    fraction on the side where that converges fast."""
    flip = x > (a + 1) / (a + b + 2)
    x, a, b = np.where(flip, 1 - x, x), np.where(flip, b, a), np.where(flip, a, b)
    front = np.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * np.log(np.maximum(x, 1e-300)) + b * np.log1p(-np.minimum(x, 1 - 1e-16))) / a
    value = np.ones_like(x)
    for k in range(LEVELS, 0, -1):
        m = k // 2
        step = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) if k % 2 == 0 else -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        value = 1 + step / value
    tail = np.clip(front / value, 0, 1)
    return np.where(flip, 1 - tail, tail)


def beta_quantile(q: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """By halving: monotone, and within 2^-40 whatever the shape."""
    low, high = np.zeros(len(a)), np.ones(len(a))
    for _ in range(HALVINGS):
        mid = (low + high) / 2
        under = beta_below(mid, a, b) < q
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    return (low + high) / 2


def bounds(a: Column, b: Column) -> Column:
    """Struct (low, high): the bounds of a beta distribution, each with CONFIDENCE; one row for each host."""

    @F.pandas_udf("low double, high double")
    def run(x, y):
        import pandas as pd

        x, y = np.maximum(x.to_numpy(float), 1e-9), np.maximum(y.to_numpy(float), 1e-9)
        return pd.DataFrame({"low": beta_quantile(1 - CONFIDENCE, x, y), "high": beta_quantile(CONFIDENCE, x, y)})

    return run(a, b)


def _weight(groups: DataFrame) -> tuple[float, float]:
    """(mean good rate, prior's weight) of groups (good, bad): one row of sums reaches the driver."""
    n = F.col("good") + F.col("bad")
    got = groups.select("good", n.alias("n")).where("n > 0").agg(F.sum("good").alias("good"), F.sum("n").alias("n"), F.sum(F.col("good") * F.col("good") / F.col("n")).alias("sq"), F.count("*").alias("groups")).first()
    if not got["n"]:
        return 0.5, 2.0
    mean = got["good"] / got["n"]
    spread = got["sq"] / got["n"] - mean * mean  # weighted variance of the rates
    within = mean * (1 - mean) * got["groups"] / got["n"]  # what chance alone gives
    between = spread - within
    if between <= 0:
        return mean, MOST_WEIGHT
    return mean, min(max(mean * (1 - mean) / between - 1, LEAST_WEIGHT), MOST_WEIGHT)


def reputations(outcomes: DataFrame, suffixes: tuple[str, ...] = LONG_SUFFIXES) -> DataFrame:
    """outcomes (host string, good boolean) -> host, domain, suffix, good, bad, rate, low, high: posterior
    mean and bounds of the good rate of every host in outcomes. User, port and root dot do not belong to the
    names that domains are found from; IP addresses are domains of their own. Rows with good null count as unlabelled:
    their hosts are judged by domain and suffix alone. Grouping is partial on the map side, so one host may
    hold any share of the rows; a null host is the empty one."""
    one = outcomes.select(F.coalesce("host", F.lit("")).alias("host"), F.col("good").cast("int").alias("y"))
    hosts = one.groupBy("host").agg(F.coalesce(F.sum("y"), F.lit(0)).cast("double").alias("good"), F.coalesce(F.sum(1 - F.col("y")), F.lit(0)).cast("double").alias("bad"))
    hosts = hosts.withColumn("name", name_of(F.col("host")))
    hosts = hosts.withColumns({"domain": domain_of(F.col("name"), suffixes), "suffix": suffix_of(F.col("name"), suffixes)})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("good").alias("d_good"), F.sum("bad").alias("d_bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("d_good").alias("s_good"), F.sum("d_bad").alias("s_bad"))
    mean, w_suffix = _weight(suffixes.select(F.col("s_good").alias("good"), F.col("s_bad").alias("bad")))
    _, w_domain = _weight(domains.select(F.col("d_good").alias("good"), F.col("d_bad").alias("bad")))
    _, w_host = _weight(hosts)

    def shrunk(good: str, bad: str, prior: Column, weight: float) -> Column:
        return (F.col(good) + prior * weight) / (F.col(good) + F.col(bad) + weight)

    s = suffixes.select("suffix", shrunk("s_good", "s_bad", F.lit(mean), w_suffix).alias("s_rate"))
    d = domains.join(s, "suffix").select("domain", shrunk("d_good", "d_bad", F.col("s_rate"), w_domain).alias("d_rate"))
    h = hosts.join(d, "domain").withColumn("rate", shrunk("good", "bad", F.col("d_rate"), w_host))
    weight = F.col("good") + F.col("bad") + w_host
    h = h.withColumn("bounds", bounds(F.col("rate") * weight, (1 - F.col("rate")) * weight))
    return h.select("host", "domain", "suffix", "good", "bad", "rate", "bounds.low", "bounds.high")


def url_filter(pages: DataFrame, outcomes: DataFrame, threshold: float = 0.5, rules: tuple[UrlRule, ...] = RULES, suffixes: tuple[str, ...] = LONG_SUFFIXES) -> DataFrame:
    """One row per row of pages (page_id, url; other columns are ignored): page_id, host, path, rule,
    verdict, rate, high. outcomes: (page_id, good), of labelled pages; a page with several counts each,
    one with none or a null adds nothing.

    verdict is the longest fitting rule's, else block if high < threshold, else allow. A url that is null
    or has no :// has an empty host, which has a reputation like any other. A null page_id has no
    outcomes; repeated rows get a row each; an empty table gives none. Reputations are joined on the host;
    the join's rows are spread by Spark's skew handling where one host holds many."""
    url = pages["url"].cast("string")
    own = pages.select(pages["page_id"].cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    labelled = outcomes.select(outcomes["page_id"].cast("long").alias("page_id"), outcomes["good"].cast("boolean").alias("good"))
    rep = reputations(own.join(labelled, "page_id", "left"), suffixes).select(F.col("host").alias("rep_host"), F.xxhash64("host").alias("rep_key"), "rate", "high")
    # the second key makes Spark shuffle both sides for this join, which lets it split a host's rows
    out = own.withColumn("key", F.xxhash64("host")).join(rep, (F.col("key") == rep["rep_key"]) & (F.col("host") == rep["rep_host"]), "left")
    hit = rule_of(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("high") < threshold, "block").otherwise("allow")
    return out.withColumn("hit", hit).select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", by_method).alias("verdict"), "rate", "high")

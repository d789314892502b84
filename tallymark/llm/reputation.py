"""URL filters: listed rules first, then the empirical-Bayes reputation of the host.

Labelled outcomes of pages are counted by host and shrunk through beta-binomial priors: host towards registered domain, domain
towards suffix, suffix towards the global rate. A host is blocked when the lower bound of its rate of bad pages exceeds a
threshold, so a host with few outcomes is not blocked for them. All steps are DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import LOWER, UPPER, ascii_lower, joined_small, saved
from tallymark.llm.shrinkage import STRONGEST, UNKNOWN, WEAKEST, lower_bound, posteriors

#: Host up to `/`, `?`, `#` or the end after the first `://`, then the path up to `?`, `#` or the end.
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Suffixes of two labels below which names are registered; any other suffix is the last label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "co.nz", "com.br", "co.in", "co.za")

#: A numeric address instead of a name, and what stands for the suffix of all of them (no name can have it).
ADDRESS = r"(?s)\A(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|\[.*\])\z"
ADDRESSES = "[address]"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, PARTS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The text and the verdict of the longest rule that fits (of equally long ones, the first in the list); null if none."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, F.lit(rule.text)).otherwise(name), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def site_of(host: Column) -> Column:
    """The bare name or address of a host: without user, port and closing dot."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r":[0-9]*\z", ""), r"(?<=.)\.\z", "")


def site_levels(host: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> tuple[Column, Column]:
    """(suffix, registered domain) of a host; a host of one label is its own suffix and domain.

    User, port and a closing dot tell nothing of the site. An address (four numbers, or in brackets) is a domain of its own, and
    all addresses share ADDRESSES as their suffix.
    """
    site = site_of(host)
    two = F.substring_index(site, ".", -2)
    double, address = two.isin(list(suffixes)), site.rlike(ADDRESS)
    suffix = F.when(address, F.lit(ADDRESSES)).when(double, two).otherwise(F.substring_index(site, ".", -1))
    return suffix, F.when(address, site).when(double, F.substring_index(site, ".", -3)).otherwise(two)


def host_posteriors(urls: DataFrame, outcomes: DataFrame, key: str, url: str = "url", suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """suffix, domain, host, n, bad, alpha, beta for every host of `urls` (columns `key` and `url`).

    `outcomes` has `key` and a boolean `is_bad`; rows whose key or `is_bad` is null tell nothing, each other row is one outcome of
    every page with that key. Outcomes are counted before they meet the pages.
    """
    counted = outcomes.filter(F.col(key).isNotNull() & F.col("is_bad").isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("is_bad").cast("bigint")).alias("bad")
    )
    pages = urls.select(key, host_of(F.col(f"`{url}`")).alias("host")).join(counted, key, "left")
    hosts = pages.groupBy("host").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    suffix, domain = site_levels(F.col("host"), suffixes)
    return posteriors(saved(hosts.select(suffix.alias("suffix"), domain.alias("domain"), "host", "n", "bad"), "hosts"), ["suffix", "domain", "host"])


def url_filter(
    pages: DataFrame, outcomes: DataFrame, key: str = "page_id", url: str = "url",
    rules: Sequence[Rule] = RULES, z: float = 2.0, threshold: float = 0.5, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES,
) -> DataFrame:
    """`key`, host, path, rule, verdict, host_outcomes and bad_bound for each row of `pages`.

    The verdict is the longest rule's, else `block` where the lower posterior bound of the host's bad rate is over `threshold`,
    else `allow`. A null URL, or one without `://`, has an empty host and path; the pages without a host count as one host.
    Without outcomes nothing but the rules blocks. Repeated rows are judged alike; other columns of `pages` are not read.
    """
    hosts = host_posteriors(pages.select(key, url), outcomes, key, url, suffixes)
    bounds = hosts.select("host", F.col("n").alias("host_outcomes"), lower_bound(z).alias("bad_bound"))
    parts = pages.select(key, host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = joined_small(parts, bounds, ["host"])
    method = F.when(F.col("bad_bound") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        key, "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"),
        "host_outcomes", F.round("bad_bound", 6).alias("bad_bound"),
    )


def page_outcomes(labels: DataFrame) -> DataFrame:
    """page_id and is_bad from quality and toxicity labels: of low quality or toxic is bad; labels and pages share their ids."""
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = F.col("quality").isNotNull() | F.col("toxic").isNotNull()
    return labels.select(F.col("doc_id").alias("page_id"), F.when(known, bad).alias("is_bad"))


def sql(z: float = 2.0, threshold: float = 0.5) -> str:
    two = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
    cases = sorted(RULES, key=lambda r: -len(r.text))
    fits = {r: f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))" for r in cases}
    rule = "CASE " + " ".join(f"WHEN {fits[r]} THEN '{r.text}'" for r in cases) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits[r]} THEN '{r.verdict}'" for r in cases) + " END"

    def level(name: str, keys: str, parent: str, source: str) -> str:
        mean = f"(k - bad) / (m - n) AS mean FROM ({source}), total"
        if parent:
            above = f"(SELECT {parent}, alpha AS k, alpha + beta AS m FROM {parent})"
            mean = f"(k - bad) / (m - n) AS mean FROM ({source}) JOIN {above} USING ({parent})"
        return f"""{name}_m AS (SELECT {keys}, n, bad, {mean}),
{name}_s AS (
  SELECT CASE WHEN coalesce(w, 0) = 0 THEN {UNKNOWN} WHEN s <= e THEN {STRONGEST}
    ELSE least(greatest(1.0::DOUBLE / ((s - e) / w) - 1.0::DOUBLE, {WEAKEST}::DOUBLE), {STRONGEST}::DOUBLE) END::DOUBLE AS k
  FROM (SELECT sum(n * pow(bad::DOUBLE / n - mean, 2)) AS s, sum(mean * (1 - mean)) AS e, sum(mean * (1 - mean) * (n - 1)) AS w
        FROM {name}_m WHERE n > 0)),
{name} AS (SELECT {keys}, n, bad, mean * k + bad AS alpha, (1 - mean) * k + n - bad AS beta FROM {name}_m, {name}_s)"""

    return f"""
WITH parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
counted AS (
  SELECT doc_id AS page_id, count(*) AS n, sum((coalesce(quality = 0, false) OR coalesce(toxic = 1, false))::BIGINT)::BIGINT AS bad
  FROM labels WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY 1),
hosts AS (
  SELECT host, coalesce(sum(n), 0)::BIGINT AS n, coalesce(sum(bad), 0)::BIGINT AS bad FROM parts LEFT JOIN counted USING (page_id) GROUP BY 1),
sites AS (
  SELECT host, n, bad, CASE WHEN two IN ({two}) THEN two ELSE labels[-1] END AS suffix,
    CASE WHEN two IN ({two}) THEN array_to_string(labels[-3:], '.') ELSE two END AS domain
  FROM (SELECT *, string_split(host, '.') AS labels, array_to_string(string_split(host, '.')[-2:], '.') AS two FROM hosts)),
total AS (SELECT coalesce(sum(bad), 0) + 0.5::DOUBLE AS k, coalesce(sum(n), 0) + 1.0::DOUBLE AS m FROM hosts),
{level("suffix", "suffix", "", "SELECT suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM sites GROUP BY suffix")},
{level("domain", "suffix, domain", "suffix", "SELECT suffix, domain, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM sites GROUP BY ALL")},
{level("site", "host", "domain", "SELECT suffix, domain, host, n, bad FROM sites")},
bounds AS (SELECT host, n, greatest(mean - {z} * sqrt(mean * (1 - mean) / (alpha + beta + 1)), 0) AS bound
  FROM (SELECT host, n, alpha, beta, alpha / (alpha + beta) AS mean FROM site))
SELECT page_id, host, path, {rule} AS rule,
  coalesce({verdict}, CASE WHEN bound > {threshold} THEN 'block' ELSE 'allow' END) AS verdict, n AS host_outcomes, round(bound, 6) AS bad_bound
FROM parts JOIN bounds USING (host)
"""

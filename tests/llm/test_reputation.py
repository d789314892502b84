import random
import re

from pyspark.sql import functions as F

from tallymark.llm import shrinkage
from tallymark.llm.reputation import ADDRESSES, RULES, Rule, host_posteriors, page_outcomes, site_levels, url_filter

URLS = [
    None, "", "plain", "http://A.Example.NET/en/x?y#z", "https://example.com", "https://example.com/de", "https://x.EXAMPLE.com/de/1", "https://notexample.com/de/1",
    "http://a.org/fr/", "http://a.org/fr", "ftp://h.net#f/", "http://h.net/", "x://y://z/p", "http://h.net?/en/", "http:///p", "http://a.org\n/fr/x", "http://Ä.net/Ä",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def ruled(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return (best.text, best.verdict) if best else (None, None)


def test_hosts_paths_and_rules(spark):
    rows = [(i, u, "h", "r") for i, u in enumerate(URLS)] + [(0, None, "", ""), (None, "http://a.b/", "", "")]
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = url_filter(spark.createDataFrame(rows, "page_id bigint, url string, host string, rule string"), page_outcomes(labels)).collect()
    assert len(got) == len(rows)
    wanted = sorted(((i, *parts(u), ruled(*parts(u))[0], ruled(*parts(u))[1] or "allow") for i, u, *_ in rows), key=repr)
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=repr) == wanted


def test_bad_hosts_are_blocked_by_their_bound(spark):
    rng = random.Random(1)
    pages, labels = [], []
    for host, n, rate in (("bad.shop", 200, 0.95), ("good.shop", 200, 0.02), ("few.shop", 1, 1.0), ("a.mixed.co.uk", 60, 0.3), ("quiet.shop", 0, 0)):
        for i in range(max(n, 1)):
            key = len(pages)
            pages.append((key, f"http://{host}/{i}"))
            if n:
                labels.append((key, 0 if rng.random() < rate else 1, 0))
    labels += [(None, 0, 0), (5, None, None), (10**9, 0, 0)]
    out = url_filter(
        spark.createDataFrame(pages, "page_id bigint, url string"), page_outcomes(spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    ).collect()
    verdicts = {r.host: (r.verdict, r.host_outcomes) for r in out}
    assert verdicts["bad.shop"] == ("block", 200) and verdicts["good.shop"] == ("allow", 200)
    assert verdicts["few.shop"] == ("allow", 1) and verdicts["a.mixed.co.uk"][0] == "allow" and verdicts["quiet.shop"] == ("allow", 0)


def test_longest_rule_wins_and_empty_tables(spark):
    rules = (Rule("b.c", "/", "block"), Rule("c", "/x/y/", "allow"), Rule("b.c", "/x/", "allow"), Rule("z.c", "/", "block"))
    df = spark.createDataFrame([(1, "h://a.b.c/x/1"), (2, "h://b.c/y"), (3, "h://c/x/y/"), (4, "h://z.c/x/y/")], "page_id bigint, url string")
    none = spark.createDataFrame([], "page_id bigint, is_bad boolean")
    got = {r.page_id: r.rule for r in url_filter(df, none, rules=rules).collect()}
    assert got == {1: "b.c/x/", 2: "b.c/", 3: "c/x/y/", 4: "c/x/y/"}
    assert url_filter(df.limit(0), none).count() == 0


def test_strength():
    assert shrinkage.strength(None, None, None) == shrinkage.UNKNOWN
    assert shrinkage.strength(1.0, 2.0, 5.0) == shrinkage.STRONGEST
    assert shrinkage.strength(100.0, 1.0, 10.0) == shrinkage.WEAKEST


def test_users_ports_dots_and_addresses(spark):
    wanted = {
        "a.b.example.com": ("com", "example.com"), "example.com:8080": ("com", "example.com"), "example.com.": ("com", "example.com"),
        "me:pw@www.example.co.uk:1": ("co.uk", "example.co.uk"), "example.com.:80": ("com", "example.com"), "example.com:": ("com", "example.com"),
        "1.2.3.4": (ADDRESSES, "1.2.3.4"), "9.8.3.4:81": (ADDRESSES, "9.8.3.4"), "[2001:db8::1]:443": (ADDRESSES, "[2001:db8::1]"),
        "[::1]": (ADDRESSES, "[::1]"), "1.2.3.com": ("com", "3.com"), "localhost": ("localhost", "localhost"), "": ("", ""), ".": (".", "."), "co.uk": ("co.uk", "co.uk"),
    }
    df = spark.createDataFrame([(h,) for h in wanted], "host string")
    got = {r.host: (r.suffix, r.domain) for r in df.select("host", *[c.alias(n) for c, n in zip(site_levels(F.col("host")), ("suffix", "domain"))]).collect()}
    wanted["."] = ("", ".")
    assert got == wanted


def test_ports_share_a_domain_and_addresses_do_not(spark):
    urls = ["http://x.com:81/a", "http://x.com:82/a", "http://1.2.3.4/a", "http://9.8.3.4/a", "http://y.zone.io/a", "http://z.zone.io/a"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    outcomes = spark.createDataFrame([(i, True) for i in (0, 2, 4)], "page_id bigint, is_bad boolean")
    hosts = {r.host: r for r in host_posteriors(pages, outcomes, "page_id").collect()}
    assert {h: r.domain for h, r in hosts.items()} == {
        "x.com:81": "x.com", "x.com:82": "x.com", "1.2.3.4": "1.2.3.4", "9.8.3.4": "9.8.3.4", "y.zone.io": "zone.io", "z.zone.io": "zone.io"
    }
    other = {r.host: r.domain for r in host_posteriors(pages, outcomes, "page_id", suffixes=("zone.io",)).collect()}
    assert other["y.zone.io"] == "y.zone.io" and other["z.zone.io"] == "z.zone.io"

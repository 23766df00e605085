import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from playmetrics.llm import queries, url_filter
from playmetrics.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string, host string, bad boolean, m double, n long"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "", "clash", True, 0.1, 1) for i, u in urls], PAGES)


def verdicts(spark, urls, outcomes=()):
    labels = spark.createDataFrame(list(outcomes), "page_id long, bad boolean, host string")
    found = url_filter.filter_urls(pages(spark, urls), labels, URL_RULES)
    return {r["page_id"]: r for r in found.collect()}


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("http://a.com/x", "a.com", "/x", "com/", "allow"),
    ("http://a.com", "a.com", "", None, "allow"),
    ("HTTP://Sub.Example.COM/en/1?q#f", "sub.example.com", "/en/1", "example.com/en/", "block"),
    ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("http://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"),
    ("x://net/es/a://b", "net", "/es/a://b", "net/es/", "block"),
    ("x://a.net/esx", "a.net", "/esx", None, "allow"),
    ("http://É.org?x=/y", "É.org", "", None, "allow"),
    ("http:///p", "", "/p", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    ("a\n://b.net/fr/\nx", "b.net", "/fr/\nx", "net/fr/", "block"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
])
def test_rules(spark, url, host, path, rule, verdict):
    got = verdicts(spark, [(1, url)])[1]
    assert (got["host"], got["path"], got["rule"], got["verdict"]) == (host, path, rule, verdict)


def brute(hosts):
    """Posterior share and its lower bound of every host, level by level."""
    def level(units, prior):
        known = [(b, n, prior(k)) for k, (b, n) in units.items() if n]
        top = sum(n * (b / n - m) ** 2 - m * (1 - m) for b, n, m in known)
        below = sum(m * (1 - m) * (n - 1) for b, n, m in known)
        c = max(top / below if below else 0.0, 1e-9)
        low, high = url_filter.STRENGTH
        s = max(low, min(high, 1 / c - 1))
        return {k: (prior(k) * s + b, (1 - prior(k)) * s + n - b) for k, (b, n) in units.items()}

    suffix, domain = (lambda h: h.rsplit(".", 1)[-1]), (lambda h: ".".join(h.split(".")[-2:]))
    by_suffix, by_domain = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for host, (b, n) in hosts.items():
        for table, key in ((by_suffix, suffix(host)), (by_domain, domain(host))):
            table[key][0] += b
            table[key][1] += n
    mean = (sum(b for b, _ in hosts.values()) + 0.5) / (sum(n for _, n in hosts.values()) + 1)
    p = lambda post: lambda key: post[key][0] / sum(post[key])
    suffixes = level(by_suffix, lambda _: mean)
    domains = level(by_domain, lambda d: p(suffixes)(suffix(d)))
    found = level(hosts, lambda h: p(domains)(domain(h)))
    return {
        h: (a / (a + b), a / (a + b) - url_filter.BOUND * math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1))))
        for h, (a, b) in found.items()
    }


def test_reputation_against_brute_force(spark):
    rng = random.Random(5)
    hosts = {}
    for d in range(12):
        share = rng.choice([0.05, 0.9])
        for h in range(rng.randint(1, 5)):
            n = rng.choice([0, 1, 3, 50, 400])
            hosts[f"h{h}.d{d}.{rng.choice(['org', 'info'])}"] = (
                sum(rng.random() < share for _ in range(n)), n
            )
    df = spark.createDataFrame([(h, b, n) for h, (b, n) in hosts.items()], "host string, bad long, n long")
    found = {r["host"]: r for r in url_filter.reputation(df).collect()}
    expected = brute(hosts)
    assert {r["host_verdict"] for r in found.values()} == {"allow", "block"}
    for host, (p, low) in expected.items():
        assert found[host]["p"] == pytest.approx(p, abs=1e-9)
        assert found[host]["low"] == pytest.approx(low, abs=1e-9)
        assert found[host]["host_verdict"] == ("block" if low > url_filter.THRESHOLD else "allow")


def test_outcomes_decide_where_no_rule_fits(spark):
    urls = [(i, "http://spam.org/a") for i in range(60)] + [(i, "http://fine.org/a") for i in range(60, 120)]
    outcomes = [(i, i < 60, "x") for i in range(0, 120, 2)] + [(None, True, "x"), (4, None, "x")]
    found = verdicts(spark, urls + [(1, "http://spam.org/b")], outcomes)
    assert {found[i]["verdict"] for i in range(60)} == {"block"}
    assert {found[i]["verdict"] for i in range(60, 120)} == {"allow"}


def test_longest_public_suffix_and_addresses(spark):
    expected = {
        "a.b.co.uk": ("co.uk", "b.co.uk"), "b.co.uk": ("co.uk", "b.co.uk"), "co.uk": ("co.uk", "co.uk"),
        "x@a.b.co.uk:80": ("co.uk", "b.co.uk"), "b.co.uk.": ("co.uk", "b.co.uk"),
        "a.b.x.co.uk": ("x.co.uk", "b.x.co.uk"), "a.nco.uk": ("uk", "nco.uk"), "uk": ("uk", "uk"),
        "www.example.com": ("com", "example.com"), "": ("", ""), "1.2.3.4": ("1.2.3.4", "1.2.3.4"),
        "9.2.3.4:80": ("9.2.3.4:80", "9.2.3.4:80"), "[::1.2.3.4]": ("[::1.2.3.4]", "[::1.2.3.4]"),
    }
    levels = url_filter._levels(F.col("host"), ("co.uk", "x.co.uk", "com"))
    hosts = spark.createDataFrame([(h,) for h in expected], "host string")
    got = hosts.select(*[c.alias(k) for k, c in levels.items()]).collect()
    assert {r["host"]: (r["suffix"], r["domain"]) for r in got} == expected


def test_one_owner_does_not_move_another_below_a_public_suffix(spark):
    rows = [(f"h{i}.spam.co.uk", 50, 50) for i in range(20)] + [("new.spam.co.uk", 0, 0), ("new.fine.co.uk", 0, 0)]
    rows += [(f"h{i}.fine.co.uk", 0, 50) for i in range(20)] + [(f"w{i}.com", 0, 50) for i in range(20)]
    hosts = spark.createDataFrame(rows, "host string, bad long, n long")
    found = {r["host"]: r for r in url_filter.reputation(hosts, suffixes=queries.PUBLIC_SUFFIXES).collect()}
    assert found["new.fine.co.uk"]["p"] < 0.1
    assert found["new.spam.co.uk"]["p"] > 0.9 and found["new.spam.co.uk"]["host_verdict"] == "block"


def test_empty_table(spark):
    assert verdicts(spark, []) == {}
    assert verdicts(spark, [], [(1, True, "x")]) == {}


def test_pages_are_read_once_for_the_sums_and_once_for_the_verdicts(spark, tmp_path, monkeypatch):
    pages(spark, [(i, f"http://h{i % 3}.org/{i}") for i in range(9)]).write.parquet(f"{tmp_path}/pages")
    table = spark.read.parquet(f"{tmp_path}/pages")
    labels = spark.createDataFrame([(1, True)], "page_id long, bad boolean")
    plans = []

    def recorded(df, store=url_filter.store):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df)

    monkeypatch.setattr(url_filter, "store", recorded)
    found = url_filter.filter_urls(table, labels, URL_RULES)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    reads = [text.count(f"{tmp_path}/pages]") for text in plans]
    assert reads[0] == reads[-1] == 1 and sum(reads) == 2
    assert found.count() == 9


def test_a_very_long_url_and_a_busy_host(spark):
    long_host = "a." * 100_000 + "org"
    urls = [(i, "http://busy.info/" + str(i)) for i in range(400)]
    urls += [(400 + i, f"http://h{i}.calm.info/") for i in range(100)]
    urls += [(900, f"http://{long_host}/" + "p" * 500_000), (901, "x" * 500_000), (902, "http://" + ":1" * 100_000)]
    labels = [(i, i % 10 != 0, "x") for i in range(300)] + [(400 + i, False, "x") for i in range(50)]
    found = verdicts(spark, urls, labels)
    assert len(found) == len(urls)
    assert {found[i]["verdict"] for i in range(400)} == {"block"}
    assert {found[i]["verdict"] for i in range(400, 500)} == {"allow"}
    assert (found[900]["host"], len(found[900]["path"])) == (long_host, 500_001)
    assert (found[901]["host"], found[902]["host"]) == ("", ":1" * 100_000)

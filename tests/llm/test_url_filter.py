import itertools
import random

import pytest

from badgeflow.llm import url_filter as uf


def brute_given(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = rest[:cut].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    path = rest[cut:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [(len(h + p), h + p, v) for v, h, p in uf.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


URLS = [
    "http://a.example.com/en/1", "https://WWW.Example.COM/en/1?x=1", "http://x.www.example.com/en/", "http://example.com", "http://com/",
    "http://notexample.com/en/2", "http://b.net/es/", "http://net/es/9#a", "http://b.net/esx", "http://b.net?/es/", "http://b.net#/fr/", "://c.net/fr/q",
    "no scheme", "", None, "a://b://c.com/en/", "http:///es/", "http://É.NET/es/", "http://b.net/fr/?u=http://x.com/", "http://a.com/\nen/",
]


def test_given_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", "x") for i, u in enumerate(URLS)] + [(1, URLS[1], "x", "x"), (None, URLS[0], "x", "x")],
                                  "page_id long, url string, host string, rule string")
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    found = {(r.page_id, r.url): (r.host, r.path, r.rule, r.verdict) for r in uf.verdicts(pages, labels).collect()}
    assert len(found) == len(URLS) + 1
    for (_, url), got in found.items():
        host, path, rule, verdict = brute_given(url)
        assert got == (host, path, rule, verdict or "allow"), url


def tokens_of(url):
    host, path, *_ = brute_given(url)
    query = url.split("#")[0].partition("?")[2]
    marked = [f"host:{p}" for p in host.split(".")] + [f"path:{p}" for p in path.split("/")] + [f"query:{p.partition('=')[0]}" for p in query.split("&")]
    return {t for t in marked if not t.endswith(":")}


@pytest.mark.parametrize("seed", [12, 13])
def test_mined_rules_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    hosts, pages, labels = ["a.x.org", "b.x.org", "spam.x.org", "c.y.org"], [], []
    for i in range(300):
        url = f"http://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'win'])}/{rng.randrange(20)}?{rng.choice(['ref=1', 'page=2&ref=x', ''])}"
        pages.append((i, url))
        bad = "spam" in url and rng.random() < 0.8 or "/win/" in url and "page" in url or rng.random() < 0.1
        if rng.random() < 0.7:
            labels.append((i, bad))
    known = dict(labels)
    baskets = [(tokens_of(u), known[i]) for i, u in pages if i in known]
    counts = {}
    for tokens, bad in baskets:
        for n in range(1, len(tokens) + 1):
            for c in itertools.combinations(sorted(tokens), n):
                k = counts.setdefault(frozenset(c), [0, 0])
                k[0] += 1
                k[1] += bad
    good = {c for c, (n, b) in counts.items() if b >= uf.MIN_PAGES and b / n >= uf.MIN_CONFIDENCE}
    least = {c for c in good if not any(o < c for o in good)}
    assert least
    table = spark.createDataFrame(pages, "page_id long, url string")
    marks = spark.createDataFrame(labels, "page_id long, bad boolean")
    mined = uf.without_longer(uf.mined_rules(uf.parsed(table), marks))
    assert {frozenset(r.tokens) for r in mined.collect()} == least
    found = {r.page_id: r.verdict for r in uf.verdicts(table, marks, rules=[("allow", "c.y.org", "/")]).collect()}
    for i, u in pages:
        blocked = "c.y.org" not in u and any(c <= tokens_of(u) for c in least)
        assert found[i] == ("block" if blocked else "allow")


def test_tokens_that_come_together_do_not_multiply(spark):
    """Thirty shared tokens: as rules alone, and in pairs with a token that is harmless alone."""
    keys = "&".join(f"k{i}=1" for i in range(30))
    urls = [(f"http://form{i}.org/login?{keys}", True) for i in range(6)]
    urls += [(f"http://a.org/{i}/sell?{keys.replace('k', 'q')}", True) for i in range(25)]  # bad together only
    urls += [(f"http://b.org/{i}?{keys.replace('k', 'q')}", False) for i in range(60)]
    urls += [(f"http://c.org/{i}/sell", False) for i in range(60)]
    urls += [(f"http://d.org/{i}/", False) for i in range(200)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id long, url string")
    marks = spark.createDataFrame([(i, bad) for i, (_, bad) in enumerate(urls)], "page_id long, bad boolean")
    found = {frozenset(r.tokens) for r in uf.without_longer(uf.mined_rules(uf.parsed(pages), marks)).collect()}
    want = {frozenset(["path:login"])} | {frozenset([f"query:k{i}"]) for i in range(30)} | {frozenset(["host:a"])}
    want |= {frozenset(["path:sell", f"query:q{i}"]) for i in range(30)}
    assert found == want


def mined(spark, hosts):
    """hosts: name, bad pages, all pages"""
    rows = [(h, i < bad) for h, bad, n in hosts for i in range(n)]
    pages = spark.createDataFrame([(k, f"http://{h}/p{k}") for k, (h, _) in enumerate(rows)], "page_id long, url string")
    marks = spark.createDataFrame([(k, bad) for k, (_, bad) in enumerate(rows)], "page_id long, bad boolean")
    return {t for r in uf.without_longer(uf.mined_rules(uf.parsed(pages), marks)).collect() for t in r.tokens}


def test_hosts_of_few_pages_need_more_than_chance(spark):
    hosts = [("fine", 0, 1000), ("mixed", 30, 300), ("five", 5, 5), ("four", 4, 4), ("half", 6, 12), ("nineteen", 19, 22), ("many", 20, 40)]
    assert mined(spark, hosts) == {"host:five", "host:nineteen", "host:many"}


def test_a_rule_needs_as_many_pages_in_a_large_table(spark):
    hosts = [("spam", 20, 20), ("fine", 0, 500)]
    assert mined(spark, hosts) == {"host:spam"}
    n = 250_000  # at the former share of 1e-4 these asked for 25 bad pages
    rows = spark.range(n).selectExpr("id AS page_id", "concat('http://', if(id < 20, 'spam', 'fine'), '/') AS url", "id < 20 AS bad")
    found = uf.mined_rules(uf.parsed(rows), rows.select("page_id", "bad")).collect()
    assert [r.tokens for r in found] == [["host:spam"]]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert uf.verdicts(none, spark.createDataFrame([(1, True)], "page_id long, bad boolean")).collect() == []

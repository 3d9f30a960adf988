import numpy as np
import pytest

from catalith.llm.hosts import RankConfig, default_rules, host_links, host_scores, judged_pages


def test_rules_and_odd_urls(spark):
    urls = [
        "HTTPS://A.Example.ORG/en/12?x#y", "http://example.org/en/2", "x://example.org/es/", "http://notexample.org/es/a", "http://org", "http://a.com/fr/", "http://a.com/de/x",
        "http://a.com?q=/fr/", "no scheme/org/", None, "http:///path", "a://b.net://c/d", "http://a.net/fr/", "",
    ]
    rows = [(i, u, "<a href='/x'>", 1) for i, u in enumerate(urls)] + [(None, "http://z.org/", None, 1), (3, urls[3], "", 2)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, verdict int")
    got = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in judged_pages(pages, default_rules(pages)).collect()}
    assert got >= {
        (0, "a.example.org", "/en/12", "example.org/en/1", "block"), (1, "example.org", "/en/2", "org/", "allow"), (2, "example.org", "/es/", "example.org/es/", "block"),
        (3, "notexample.org", "/es/a", "org/", "allow"), (4, "org", "", None, "allow"), (5, "a.com", "/fr/", "com/fr/", "allow"), (6, "a.com", "/de/x", "com/de/", "block"),
        (8, "", "", None, "allow"), (9, "", "", None, "allow"), (10, "", "/path", None, "allow"), (11, "b.net:", "//c/d", None, "allow"), (13, "", "", None, "allow"),
        (None, "z.org", "/", "org/", "allow"),
    }
    assert judged_pages(pages.limit(0), default_rules(pages)).count() == 0


def test_scores_travel_along_links_and_back(spark):
    pages = spark.createDataFrame(
        [
            ("good.org", '<a href="http://mid.net/1">x</a><a href="HTTP://MID.net/2">x</a><a href=//other.net>x</a><a href="/own">x</a>'),
            ("mid.net", "<a class='b' href='http://far.net'>x</a>"), ("linker.net", '<a href="http://bad.com/">x</a>'), ("bad.com", None), ("", '<a href="http://bad.com/">'),
        ],
        "host string, html string",
    )
    config = RankConfig(parents=False, steps=12)
    links = host_links(pages, config)
    edges = {(r["src"], r["dst"]): r["weight"] for r in links.collect()}
    assert edges == {("good.org", "mid.net"): 2, ("good.org", "other.net"): 1, ("mid.net", "far.net"): 1, ("linker.net", "bad.com"): 1}
    seeds = spark.createDataFrame([("good.org", 3, 1), ("bad.com", 0, 4)], "host string, good bigint, bad bigint")
    got = {r["host"]: (r["trust"], r["distrust"]) for r in host_scores(links, seeds, config).collect()}
    nodes = sorted({n for e in edges for n in e})
    at = {n: i for i, n in enumerate(nodes)}
    for k, start in enumerate(({"good.org": 1.0}, {"good.org": 0.2, "bad.com": 0.8})):
        m = np.zeros((len(nodes), len(nodes)))
        for (s, d), w in edges.items():
            s, d = (s, d) if k == 0 else (d, s)
            m[at[d], at[s]] = w
        m /= np.maximum(m.sum(0), 1e-300)
        seed = np.array([start.get(n, 0.0) for n in nodes])
        score = seed
        for _ in range(config.steps):
            score = 0.85 * m @ score + 0.15 * seed
        assert [got.get(n, (0, 0))[k] for n in nodes] == pytest.approx(score.tolist())


def test_parents_and_verdicts(spark):
    html = '<a href="http://spam.com/de/">x</a>'
    pages = spark.createDataFrame(
        [(1, "http://spam.com/de/a", ""), (2, "http://a.b.ring.net/x", html), (3, "http://ring.net/", ""), (4, "http://lone.net/", "")], "page_id bigint, url string, html string"
    )
    got = {r["page_id"]: r["verdict"] for r in judged_pages(pages, default_rules(pages)).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow"}

import random

from pyspark.sql import functions as F

from quarry.operators.components import connected_components
from quarry.llm.registry import URL_RULES
from quarry.llm.urls import Rule, judge_urls, page_links


def closure(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {x: find(x) for x in parent}


def test_components_against_union_find(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(1000, 1000 + i) for i in range(400)] + [(i, i + 1) for i in range(2000, 2090)]
    edges = [e for e in edges if e[0] != e[1]]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == closure(edges)
    assert got.count() == len(closure(edges))


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")).count() == 0


def test_rules(spark):
    urls = ["HTTP://A.Example.NET/en/1?q", "http://example.net/de/", "x://net/", "http://x.net", "http://example.com/de/9#f", "http://notexample.com/de/1", "http://a.org/fr/x", "http://org/fr", None, "no scheme", "a://b://c/d", ""]
    got = judge_urls(spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string"), URL_RULES)
    rows = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()}
    assert rows[0] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert rows[1] == ("example.net", "/de/", "net/", "block") and rows[2] == ("net", "/", "net/", "block")
    assert rows[3] == ("x.net", "", None, "allow") and rows[4] == ("example.com", "/de/9", "example.com/de/", "block")
    assert rows[5][2:] == (None, "allow") and rows[6] == ("a.org", "/fr/x", "org/fr/", "allow") and rows[7][2] is None
    assert rows[8] == rows[9] == rows[11] == ("", "", None, "allow") and rows[10][:2] == ("b:", "//c/d")


def test_decisions_spread_with_allow_first(spark):
    rules = [Rule("block", "bad.com"), Rule("allow", "good.com")]
    link = '<html><LINK href="{}" rel="canonical"></html>'
    pages = [
        (1, "http://alias.org/x", link.format("http://bad.com/home")),
        (2, "https://alias.org/x#y", ""),
        (3, "http://second.org/", '<meta http-equiv="refresh" content="0; url=http://alias.org/x">'),
        (4, "http://both.org/", link.format("//bad.com/z") + '<meta property="og:url" content="http://good.com/">'),
        (5, "http://free.org/", link.format("/self")),
        (6, None, link.format("http://bad.com/")),
        (7, "http://bad.com/q", None),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in judge_urls(df, rules, page_links(df)).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block"}


def test_relative_targets_are_resolved(spark):
    page = "http://a.org/d/e/p.html?k="
    cases = [
        ("next.html", "", "a.org/d/e/next.html"), ("./a", "", "a.org/d/e/a"), ("../../../x/./y", "", "a.org/x/y"), ("?p=2", "", "a.org/d/e/p.html?p=2"),
        ("/r/../s", "", "a.org/s"), ("//b.org:80/t", "", "b.org/t"), ("https://c.org:443", "", "c.org/"), ("http://c.org:443/", "", "c.org:443/"), ("q", '<base href="/z/w">', "a.org/z/q"),
        ("q", '<base href="http://d.org/v/">', "d.org/v/q"), ("..", "", "a.org/d/"), ("mailto:x@y.z", "", None), ("#f", "", None), ("a?u=../b", "", "a.org/d/e/a?u=../b"),
    ]
    rows = [(i, f"{page}{i}", f'{base}<link rel="canonical" href="{t}">') for i, (t, base, _) in enumerate(cases)]
    got = {r.a: r.b for r in page_links(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {f"a.org/d/e/p.html?k={i}": want for i, (_, _, want) in enumerate(cases) if want}


def test_every_tag_counts(spark):
    html = '<link rel=canonical href=/one><link rel=canonical href=/two><meta http-equiv="refresh" content="0; url=three"><meta property="og:url" content="/four"><meta property="og:url" content="/five">'
    df = spark.createDataFrame([(1, "http://a.org/x/y", html), (2, None, html), (3, "http://a.org/", None)], "page_id long, url string, html string")
    assert sorted(r.b for r in page_links(df).collect()) == ["a.org/five", "a.org/four", "a.org/one", "a.org/two", "a.org/x/three"]


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert judge_urls(df, URL_RULES, page_links(df)).count() == 0
    assert judge_urls(df, [], None).select(F.col("verdict")).count() == 0


def test_very_long_urls(spark):
    far = "http://deep.org/" + "a/../" * 30_000 + "end"
    pages = [(1, "http://bad.com/" + "x" * 300_000, None), (2, "http://a.org/", f'<link rel=canonical href="http://bad.com/{"y" * 100_000}">'), (3, far, "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: (r.host, len(r.path), r.verdict) for r in judge_urls(df, [Rule("block", "bad.com")], page_links(df)).collect()}
    assert got == {1: ("bad.com", 300_001, "block"), 2: ("a.org", 1, "block"), 3: ("deep.org", len(far) - 15, "allow")}

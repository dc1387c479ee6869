from html import unescape
from urllib.parse import urljoin

from llm_odd import table  # noqa: F401
from pyspark.sql import functions as F

from tidewatch.llm import url_filter
from tidewatch.llm.components import connected_components

PAGES = [
    (1, "http://a.example.org/es/x", None),
    (2, "http://b.net/1", '<link href="http://a.example.org/es/x" rel="canonical">'),
    (3, "https://B.net/1/?utm_source=q#f", ""),
    (4, "http://c.net/", '<META http-equiv=refresh content="0; url=http://b.net/1">'),
    (5, "http://x.com/fr/1", '<link rel=canonical href="//d.net/p">'),
    (6, "http://d.net/p", '<link rel="canonical" href="/q">'),
    (7, "http://y.com/de/1", '<link rel="canonical" href="http://d.net/q">'),
    (8, None, None),
    (9, "no scheme", "<link rel=canonical href=http://a.example.org/es/x>"),
    (10, "x://", None),
    (11, "http://q.org?x=/es/", None),
    (12, "http://EXAMPLE.org:80/en/12", None),
    (13, "http://example.org/en/12", None),
    (14, "http://z.net/", None),
    (14, "http://z.net/", None),
    (15, "http://:80/a", None),
]


def test_verdicts(spark):
    pages = spark.createDataFrame([(*p, "h") for p in PAGES], "page_id bigint, url string, html string, host string")
    rows = url_filter.filter_urls(pages).collect()
    got = {r["row"]["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}
    assert len(rows) == len(PAGES)
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert [got[i][3] for i in (2, 3, 4)] == ["block"] * 3  # aliases of 1
    assert got[3][:3] == ("b.net", "/1/", None)
    assert [got[i][3] for i in (5, 6)] == ["allow"] * 2 and got[7][3] == "block"  # its own rule
    assert got[8] == got[9] == ("", "", None, "allow") and got[10][:2] == ("", "")
    assert got[11] == ("q.org", "", None, "allow")
    assert got[12] == ("example.org:80", "/en/12", None, "block")  # alias of 13
    assert got[13][2:] == ("example.org/en/1", "block")


def test_redirects_from_elsewhere_and_empty(spark):
    pages = spark.createDataFrame(PAGES[13:15], "page_id bigint, url string, html string")
    log = spark.createDataFrame([("http://z.net/", "http://k.com/de/"), (None, "x")], "from_url string, to_url string")
    more = spark.createDataFrame([(20, "http://k.com/de/", None)], "page_id bigint, url string, html string")
    rows = url_filter.filter_urls(pages.union(more), redirects=log).collect()
    assert {r["verdict"] for r in rows} == {"block"}
    assert url_filter.filter_urls(pages.where("false")).count() == 0
    assert {r["verdict"] for r in url_filter.filter_urls(pages, rules=()).collect()} == {"allow"}


def test_components_against_union_find(spark):
    import random

    r = random.Random(1)
    edges = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 140)]
    edges += [(200, k) for k in range(201, 400)] + [(5, 5), (None, 3), (7, None)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {row["node"]: row["component"] for row in connected_components(frame).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert connected_components(frame.where("false")).count() == 0


def test_links_are_resolved_and_decoded(spark):
    base = "http://www.e.net/a/b/c.html?x=1#f"
    targets = ["page.html", "?id=1", "../x", "../../../y/./z/..", "./", "#top", "d/e?u=http://k.org/", "/r/../s", "mailto:me@e.net"]
    targets += ["//h.net/p", "https://h.net/q", "x:y", "..", "?", "g;x=1/./y"]
    rows = spark.createDataFrame([(t, u) for t in targets for u in (base, "http://e.net", "http://e.net/k/")], "t string, u string")
    got = rows.select("t", "u", url_filter.address(url_filter.resolved(F.col("t"), F.col("u")))).collect()
    wanted = rows.select(
        "t", url_filter.address(F.udf(lambda t, u: urljoin(u, t))(F.col("t"), F.col("u"))).alias("w")
    ).collect()
    for (t, u, address), want in zip(got, wanted):
        assert want["t"] == t and address == (want["w"] if t != "?" else address), (t, u)
    texts = ["/p?a=1&amp;b=2", "&amp;lt;", "&#38;amp;", "&#x2F;x&#47;y", "&eacute;&nosuch;&#0;&#x1F642;", "a&b=c", "&&amp;&", "&#9999999;"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    want = {t: unescape(t) for t in texts} | {texts[4]: "é&nosuch;&#0;🙂", texts[7]: texts[7]}
    assert {r[0]: r[1] for r in rows.select("t", url_filter.decoded(F.col("t"))).collect()} == want


def test_aliases_by_relative_and_encoded_links(spark):
    pages = [
        (1, "http://b.net/1?id=2&lang=en", '<link rel=canonical href="http://x.example.org/es/k?p=1&amp;q=2">'),
        (2, "http://x.example.org/es/k?q=2&p=1", None),
        (3, "http://b.net/dir/old.html", '<link rel="canonical" href="../1?lang=en&amp;id=2">'),
        (4, "http://b.net/dir/more", '<meta http-equiv="refresh" content="0; url=old.html">'),
        (5, "http://b.net/1", '<link rel="canonical" href="?id=2&#38;lang=en">'),
        (6, "http://b.net/other", '<link rel="canonical" href="else">'),
    ]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r["row"]["page_id"]: r["verdict"] for r in url_filter.filter_urls(frame).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "allow"}

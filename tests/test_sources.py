"""Recorded responses of our own making."""

import pytest

from millrace.sources import pages as P
from millrace.sources import responses as R

RSS = b"""<?xml version="1.0"?><rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>x</title>
<item><title>One</title><link>https://e.com/1</link><pubDate>Fri, 01 May 2026 10:00:00 GMT</pubDate><description>&lt;p&gt;a &amp;amp; b&lt;/p&gt;</description><category> Deep  Dive </category></item>
<item><title>Two</title><guid>https://e.com/2</guid><dc:date>2026-01-01T00:00:00Z</dc:date><category>other</category></item>
<item><title>Three</title><link>https://e.com/3</link><pubDate>recently</pubDate><category>deep dive</category></item>
<item><title>Known</title><link>https://e.com/k</link><category>deep dive</category></item></channel></rss>"""
ATOM = b"""<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A</title><id>urn:1</id><link rel="self" href="https://e.com/s"/><link href="https://e.com/a"/>
<updated>2026-05-01T00:00:00Z</updated><content type="xhtml"><div>some <b>bold</b></div></content><category term="t"/></entry></feed>"""
MAP = b"<urlset><url><loc>https://e.com/p</loc><lastmod>2026-05-01</lastmod></url><url><loc>https://e.com/q</loc></url></urlset>"


def test_feeds():
    rss = R.feed_entries(RSS)
    assert [(e["pos"], e["url"], e["published"]) for e in rss][:3] == [(0, "https://e.com/1", "Fri, 01 May 2026 10:00:00 GMT"), (1, "https://e.com/2", "2026-01-01T00:00:00Z"), (2, "https://e.com/3", "recently")]
    atom = R.feed_entries(ATOM)[0]
    assert (atom["url"], atom["published"], atom["categories"]) == ("https://e.com/a", "2026-05-01T00:00:00Z", ["t"])
    assert [e["published"] for e in R.sitemap_entries(MAP)] == ["2026-05-01", None]
    with pytest.raises(ValueError):
        R.sitemap_entries(b"<sitemapindex><sitemap><loc>x</loc></sitemap></sitemapindex>")
    with pytest.raises(ValueError):
        R.feed_entries(b'<!DOCTYPE x [<!ENTITY a "b">]><rss><item><title>&a;</title></item></rss>')


def test_names_of_other_namespaces_and_document_types():
    feed = b"""<!DOCTYPE rss><rss xmlns:m="http://example.org/m/" xmlns:a="http://www.w3.org/2005/Atom"><item><m:title>No</m:title><a:link href="https://x.test/self"/><title>Yes</title><link>https://x.test/1</link></item></rss>"""
    assert [(e["title"], e["url"]) for e in R.feed_entries(feed)] == [("Yes", "https://x.test/1")]
    with pytest.raises(ValueError):
        R.feed_entries(b'<!DOCTYPE r [<!ENTITY a SYSTEM "file:///x">]><r><item><title>t</title></item></r>')


@pytest.mark.parametrize("address", ["192.88.99.7", "5f00::9", "3fff:1::1", "::9.9.9.9", "2001:4:112::5", "64:ff9b:1::1", "100::1", "2002:808:808::1", "fe80::2%eth1", "::ffff:192.168.3.4", "0.1.2.3", "255.255.255.255"])
def test_closed_ranges(address):
    assert not P.public_address(address)


def test_open_addresses():
    assert all(map(P.public_address, ["9.9.9.9", "2620:fe::fe", "64:ff9b::9.9.9.9", "::ffff:9.9.9.9", "192.88.98.1", "100.128.0.1"]))


def test_feed_items(spark):
    rows = spark.createDataFrame([("s", "u", 200, RSS), ("bad", "u", 200, b"<rss"), ("no", "u", 403, None)], "source_id string, url string, status int, body binary")
    known = spark.createDataFrame([("https://e.com/k",)], "url string")
    settings = spark.createDataFrame([("s", 5, 7, ["DEEP dive"])], "source_id string, max_items int, window_days int, categories array<string>")
    items = R.feed_items(rows, known, settings, R.feed_column("body"), "2026-05-03 00:00:00").orderBy("rank").collect()
    assert [(r.rank, r.title, r.summary) for r in items] == [(1, "One", "a & b"), (2, "Three", None)]
    assert {(r.source_id, r.reason) for r in R.unreadable(rows, R.feed_column("body")).collect()} == {("bad", "parse"), ("no", "auth")}


def test_json(spark):
    hits = b'{"hits": [{"objectID": "1", "points": 3, "title": "a"}, {"objectID": "2", "points": null, "title": "b", "url": "https://e.com"}, {"objectID": "3", "points": 9}]}'
    again = b'{"hits": [{"objectID": "1", "points": 99, "title": "later"}]}'
    rows = spark.createDataFrame([("s", "q1", hits), ("s", "q2", again), ("t", "q", b"not json")], "source_id string, url string, body binary")
    assert [(r.object_id, r.points, r["rank"]) for r in R.search_items(rows, 2).orderBy("rank").collect()] == [("3", 9, 1), ("1", 3, 2)]
    from pyspark.sql import functions as F

    releases = spark.createDataFrame([("s", "u", b'[{"tag_name": "v1", "created_at": "2026-01-01", "body": "x"}, {"name": "n", "published_at": "p"}]')], "source_id string, url string, body binary")
    assert [(r.title, r.published) for r in R.release_items(releases, F.lit("o/r")).orderBy("pos").collect()] == [("o/r v1", "2026-01-01"), ("o/r n", "p")]
    papers = spark.createDataFrame([("s", "u", b'[{"title": "t", "paper": {"id": "1", "upvotes": 4}}, {"id": "2"}, {"id": "3"}]')], "source_id string, url string, body binary")
    assert [(r.paper_id, r.title, r.upvotes) for r in R.paper_items(papers, 2).orderBy("pos").collect()] == [("1", "t", 4), ("2", None, 0)]


def test_head(spark):
    page = b"<head><title>T</title><meta property='og:title' content='OG'><meta name=date content=2026-01-01></head><meta property='og:description' content='late'>"
    assert R.page_head(page) == {"title": "OG", "published": "2026-01-01", "description": None}
    got = spark.createDataFrame([(page,), (None,)], "b binary").select(R.head_column("b").alias("h")).select("h.*").collect()
    assert [r.title for r in got] == ["OG", None]


PAGE = """<html><head><title>x</title><meta name="author" content="Ann"><link rel="canonical" href="/c"></head><body><nav>menu</nav><main>around<article><h2>Head</h2><p>First <code>x</code> line.</p>
<ul><li>a</li><li>b</li></ul><pre>k = 1
  l</pre><p style="display:none">secret</p><span class="sr-only">hidden</span><blockquote>said</blockquote><table><tr><td>1</td><td>2</td></tr></table><a href="/l#x">link</a></article></main><footer>foot</footer></body></html>"""


def test_pages(spark):
    out = P.main_content(PAGE)
    assert out["body_text"] == "## Head\n\nFirst `x` line.\n\n- a\n- b\n\n```\nk = 1\n  l\n```\n\n> said\n\n1 | 2\n\nlink"
    assert (out["author"], out["canonical_raw"], out["headings"], out["code_blocks"], out["links"]) == ("Ann", "/c", 1, 1, ["/l#x"])
    assert P.main_content("")["body_text"] is None and P.main_content("<p>a</div></p>b")["body_text"] == "a\n\nb"
    rows = spark.createDataFrame([(PAGE.encode(), "text/html"), (None, None)], "b binary, t string").select(P.content_column("b", "t").alias("c")).select("c.*").collect()
    assert rows[0].body_text == out["body_text"] and rows[1].body_text is None


def test_charsets_and_addresses(spark):
    assert P.decoded("é".encode("latin-1"), "text/html; charset=ISO-8859-1") == "é" and P.decoded(b"\xef\xbb\xbfa\xff") == "a�" and P.decoded(b"a", "charset=nothing") == "a"
    public = {"8.8.8.8": True, "10.0.0.1": False, "127.0.0.1": False, "::1": False, "::ffff:10.0.0.1": False, "64:ff9b::a00:1": False, "2606:4700::1111": True, "169.254.1.1": False, "224.0.0.1": False, "x": False, None: False}
    rows = spark.createDataFrame([(a,) for a in public], "a string").select("a", P.public_column("a").alias("p")).collect()
    assert {r.a: r.p for r in rows} == public

"""Listing pages of our own making."""

from millrace.sources import listings as L
from millrace.sources import responses as R

NOW = "2026-05-10 00:00:00"
INDEX = b"""<a class="nav" href="/blog/no">menu</a><a class="x post-link" href="/blog/a">A<img src=i></a><a class="post-link" href="https://e.com/blog/b">B</a><a class="post-link" href="/blog/a">again</a>
<a class="post-link" href="/other">outside</a><a class="post-link" href="/blog/known">known</a><a class="post-link" href="/blog/c">C</a>"""
CARDS = b"""<a class="tile_x1" href=" https://a.com/1 "><h3 class="headline_q">One <b>bold</b></h3><span class="author_z">Ann, 2026-05-08</span></a>
<a class="tile_x1" href="https://a.com/2"><h3 class="headline_q">Two</h3><span class="author_z">Bob - 2026-05-09</span></a><a class="tile_x1" href="https://a.com/1"><span class="author_z">2026-05-07</span></a>
<a class="tile_x1" href="https://u:p@a.com/3"><span class="author_z">2026-05-09</span></a><a class="tile_x1" href="https://a.com/4"><span class="author_z">undated</span></a><a class="other" href="https://a.com/5"><span class="author_z">2026-05-09</span></a>
<a class="tile_x1" href="https://a.com/6"><span class="author_z">2026-05-11</span></a><a class="tile_x1" href="https://a.com/old"><span class="author_z">2026-01-01</span></a>"""


def test_index_pages(spark):
    pages = spark.createDataFrame([("s", "https://e.com/blog/", INDEX), ("none", "https://n.com", b""), ("null", "https://n.com", None)], "source_id string, url string, body binary")
    settings = spark.createDataFrame([("s", "post-link", "https://e.com/blog/", 3, 7, 2)], "source_id string, link_class string, url_prefix string, max_probes int, window_days int, max_items int")
    known = spark.createDataFrame([("https://e.com/blog/known",)], "url string")
    links = L.index_links(pages, settings, known)
    assert [(r.url, r["rank"]) for r in links.orderBy("rank").collect()] == [("https://e.com/blog/a", 1), ("https://e.com/blog/b", 2), ("https://e.com/blog/c", 3)]
    heads = spark.createDataFrame([
        ("https://e.com/blog/a", "https://e.com/blog/a", "A", "2026-05-05", "d"), ("https://e.com/blog/b", "https://e.com/blog/b2", "B", "2026-05-09T01:00:00Z", None), ("https://e.com/blog/c", "https://evil.com/", "C", "2026-05-09", None),
    ], "url string, answered string, title string, published string, description string")
    items = L.index_items(links, heads, settings, known, NOW).orderBy("rank").collect()
    assert [(r["rank"], r.title, r.summary) for r in items] == [(1, "B", None), (2, "A", "d")]


def test_cards(spark):
    pages = spark.createDataFrame([("s", "https://d.com", CARDS)], "source_id string, url string, body binary")
    settings = spark.createDataFrame([("s", 7, 5)], "source_id string, window_days int, max_items int")
    got = L.card_items(pages, settings, spark.createDataFrame([], "url string"), NOW).orderBy("rank").collect()
    assert [(r.url, r.title, r.published) for r in got] == [("https://a.com/2", "Two", "2026-05-09"), ("https://a.com/1", "One bold", "2026-05-08")]


def test_sitemaps_and_lists(spark):
    schema = "source_id string, page string, pos int, url string, published string"
    entries = spark.createDataFrame([
        ("s", "m", 0, "https://e.com/p/1", "2026-05-04"), ("s", "m", 1, "https://e.com/p/2", "2026-05-09T00:00:00+09:00"), ("s", "m", 2, "https://e.com/p/3", None), ("s", "m", 3, "https://e.com/q", "2026-05-09"), ("s", "m", 4, "https://e.com/p/5", "2026-01-01"),
        ("s", "m", 5, "https://e.com/p/6", "2026-05-05"), ("s", "m", 6, None, "2026-05-05"),
    ], schema)
    settings = spark.createDataFrame([("s", "https://e.com/p/", 7, 2)], "source_id string, url_prefix string, window_days int, max_items int")
    got = L.sitemap_items(entries, settings, spark.createDataFrame([], "url string"), NOW).orderBy("rank").collect()
    assert [(r["rank"], r.url) for r in got] == [(1, "https://e.com/p/2"), (2, "https://e.com/p/6")]
    lists = spark.createDataFrame([("s", "d1", 3), ("s", "d2", 0), ("t", "d2", 1), ("t", "d1", 2), ("u", "d2", 0)], "source_id string, day string, n int")
    assert {(r.source_id, r.day) for r in L.latest_list(lists, "day", lists["n"] > 0).collect()} == {("s", "d1"), ("t", "d2")}


def test_linked_data_comes_first():
    head = b"""<head><script type="application/ld+json">[{"@type": "Person", "headline": "no"}, {"@type": "Thing", "@graph": [{"@type": ["BlogPosting"], "headline": "A &amp; B", "datePublished": "2026-05-01", "description": 3}]}]</script>
    <script type='application/ld+json'>broken</script><meta property="og:title" content="OG"><meta property="og:description" content="D"></head>"""
    assert R.page_head(head) == {"title": "A & B", "published": "2026-05-01", "description": "D"}

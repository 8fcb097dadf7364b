"""URL canonicalisation, case by case."""

import pytest
from hypothesis import given
from hypothesis import strategies as st

from millrace.functions.urls import canonical, canonical_url, resolved_links

CASES = [
    ("HTTPS://Example.COM./a/../b/./c?x=1&UTM_source=f&&y=2#top", "https://example.com/b/c?x=1&y=2"),
    ("https://example.com", "https://example.com/"), ("https://example.com?ref=x", "https://example.com/?ref=x"), ("http://example.com:80/a/", "http://example.com/a/"),
    ("https://example.com:8443/", "https://example.com:8443/"), ("https://example.com:443/x", "https://example.com/x"), ("https://e.com/%7euser%2f%c3%a9", "https://e.com/~user%2F%C3%A9"),
    ("https://e.com/é/100%", "https://e.com/%C3%A9/100%"), ("https://e.com/a/b/..", "https://e.com/a"), ("https://e.com/%2e%2e/a", "https://e.com/../a"),
    ("http://[2001:DB8:0::1]:80/", "http://[2001:db8::1]/"), ("http://[::ffff:1.2.3.4]/", "http://[::ffff:102:304]/"), ("​ https://e.com/a\n", "https://e.com/a"),
    ("https://e.com/?b=2&a=1&fbclid=1", "https://e.com/?b=2&a=1"), ("https://e.com/?utm_source", "https://e.com/"),
]


@pytest.mark.parametrize("raw, url", CASES)
def test_canonical(raw, url):
    assert canonical_url(raw) == (url, None)


@pytest.mark.parametrize("raw", ["ftp://e.com/", "mailto:a@b.c", "e.com/a", "/a", "https://", "https://u@e.com/", "https://:@e.com/", "https://e.com/a b", "http://[fe80::1%25en0]/", "http://[1.2.3.4]/",
                                 "https://e.com:port/", "https://e.com:70000/", "https://.../", "https://e.com/" + "a" * 2048])
def test_invalid(raw):
    assert canonical_url(raw) == (None, "invalid")


@pytest.mark.parametrize("raw", [None, "", "  ", "​"])
def test_missing(raw):
    assert canonical_url(raw) == (None, "missing")


@given(st.text(alphabet="abA/.?&=%#:2é ", max_size=30))
def test_canonical_urls_are_stable(tail):
    url, problem = canonical_url("https://e.com/" + tail)
    assert problem or canonical_url(url)[0] is not None


def test_columns(spark):
    rows = spark.createDataFrame([("https://E.com/a#x",), (None,), ("x",)], "u string").select(canonical("u").alias("c")).select("c.*").collect()
    assert [tuple(r) for r in rows] == [("https://e.com/a", None), (None, "missing"), (None, "invalid")]
    links = spark.createDataFrame([("https://e.com/a", ["/b", "#x", "b", "mailto:x", None]), (None, ["b"]), ("https://e.com/", None)], "base string, links array<string>")
    assert [r[0] for r in links.select(resolved_links("base", "links")).collect()] == [["https://e.com/b"], [], []]

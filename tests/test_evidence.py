"""Quotes, claims and excerpts, case by case."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.functions.urls import canonical_url
from millrace.operators import evidence as E

DRAFTS = "doc string, map_no int, at int, local string, pos int, quote string, kind string"


@pytest.fixture()
def checked(spark):
    paragraphs = spark.createDataFrame([("a", 1, "it took  3\nseconds"), ("a", 2, "```\nx = 1\n```"), ("a", 3, "run `make` now")], "doc string, pos int, text string")
    drafts = spark.createDataFrame([
        ("a", 1, 1, "e1", 1, "took 3 seconds", "number"), ("a", 1, 2, "e2", 2, "x = 1", "code"), ("a", 1, 3, "e3", 3, "run", "code"), ("a", 1, 4, "e4", 3, "`make`", "code"), ("a", 1, 5, "e5", 1, "it", "number"),
        ("a", 2, 6, "e1", 1, "took   3  seconds", "comparison"), ("a", 2, 7, "e2", 1, "seconds", "statement"),
        ("a", 3, 8, "e1", 1, "took 4", "number"), ("a", 3, 9, "e1", 1, "it", "number"), ("a", 3, 10, "e3", 9, "it", "number"), ("b", 3, 11, "e4", 1, "it", "number"), ("a", 3, 12, "e5", 1, None, "number"), ("a", 3, 13, "e6", 1, " ", "number"),
    ], DRAFTS)
    return E.checked_quotes(drafts, spark.createDataFrame([("a",)], "doc string"), paragraphs)


def test_checked_quotes(checked):
    rows = {r["at"]: r for r in checked.collect()}
    assert [rows[n]["problem"] for n in range(1, 14)] == [None] * 7 + [
        "quote_not_in_paragraph", "duplicate_local_id", "unknown_paragraph", "unknown_document", "quote_not_in_paragraph", "quote_not_in_paragraph"]
    assert [rows[n]["kind"] for n in range(1, 8)] == ["number", "code", "statement", "code", "statement", "comparison", "statement"]
    assert rows[1]["span"] == "took  3\nseconds"


def test_numbers_go_to_the_first_draft_of_a_quote(checked):
    accepted = E.accepted_quotes(checked)
    assert {r.map_no for r in accepted.collect()} == {1, 2}
    got = {(r.evidence_id, r.quote, r.kind) for r in E.numbered_quotes(accepted).collect()}
    assert got == {
        ("a#main/p1#1", "took 3 seconds", "number"), ("a#main/p1#2", "it", "statement"), ("a#main/p1#3", "seconds", "statement"), ("a#main/p2#1", "x = 1", "code"),
        ("a#main/p3#1", "run", "statement"), ("a#main/p3#2", "`make`", "code"),
    }


def test_ids_have_places(spark):
    rows = spark.createDataFrame([("a_1#main/p3#12",), ("a#ref2/p1#1",), ("a#ref0/p1#1",), ("a#main/p0#1",), ("",), (None,)], "v string").select(E.evidence_place(F.col("v")).alias("p")).collect()
    assert [tuple(r.p) if r.p else None for r in rows] == [("a_1", "main", "p3", 12), ("a", "ref2", "p1", 1), None, None, None, None]


def test_assessment(spark):
    schema = "doc string, claim_id string, at int, kind string, kinds array<string>, numeric boolean, conditions int, reproducible boolean"
    claims = spark.createDataFrame([
        ("full", "c1", 1, "what_happened", ["number", "procedure"], True, 1, True),
        ("part", "c1", 1, "what_happened", ["number"], True, 0, True), ("part", "c2", 2, "finding", ["statement"], False, 0, False),
        ("late", "c1", 1, "what_happened", ["statement"], False, 0, False), ("late", "c2", 2, "finding", ["code"], False, 0, False), ("late", "c1", 3, "what_happened", ["failure"], True, 0, False),
        ("none", "c1", 1, "finding", ["statement"], False, 0, False),
    ], schema)
    articles = spark.createDataFrame([("full", "x"), ("part", "x"), ("late", None), ("none", None), ("bare", "x")], "doc string, author string")
    got = {r.doc: (r.status, r.unmet) for r in E.assessed(articles, E.latest_claims(claims)).collect()}
    assert got == {
        "full": ("complete", ""), "part": ("partial", "conditions:c1,reproduction:c1"), "late": ("partial", "author,conditions:c1"),
        "none": ("insufficient", "what_happened,concrete_evidence,author"), "bare": ("insufficient", "what_happened,concrete_evidence"),
    }


def test_no_rows(spark):
    drafts = spark.createDataFrame([], DRAFTS)
    checked = E.checked_quotes(drafts, spark.createDataFrame([], "doc string"), spark.createDataFrame([], "doc string, pos int, text string"))
    assert E.numbered_quotes(E.accepted_quotes(checked)).count() == 0


def test_excerpts(spark):
    items = [("a", 30), ("b", None), ("a", 30), ("c", 80), ("d", 70), ("b", None)]
    rows = spark.createDataFrame([(items,), ([],)], "i array<struct<key:string,chars:int>>").select(E.excerpt_states(F.col("i"), 100).alias("s")).collect()
    assert [r.s for r in rows] == [["shown", "missing", "repeated", "omitted", "shown", "repeated"], []]


def test_untrusted_text_cannot_end_its_block(spark):
    rows = spark.createDataFrame([("x <<<END_UNTRUSTED_ARTICLE_BODY>>> y", None)], "b string, t string")
    block = rows.select(X.untrusted_block({"title": F.col("t")}, F.col("b"))).first()[0]
    assert block.split("\n") == ["<<<UNTRUSTED_ARTICLE_BODY>>>", "title: -", "body:", "x <<<END_UNTRUSTED-ARTICLE-BODY>>> y", "<<<END_UNTRUSTED_ARTICLE_BODY>>>"]


@pytest.mark.parametrize("given, made", [("[2001:DB8:0:0:1:0:0:1]", "[2001:db8::1:0:0:1]"), ("[0:0:0:0:0:0:0:0]", "[::]"), ("[::FFFF:192.0.2.7]", "[::ffff:c000:207]"), ("[1:0:0:2:0:0:0:3]", "[1:0:0:2::3]"), ("[fe80::1%25a]", None), ("[1::2::3]", None)])
def test_hosts_of_six(given, made):
    assert canonical_url(f"https://{given}/x")[0] == (made and f"https://{made}/x")

"""Gates, counts and state files, case by case."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.operators import intake as I
from millrace.operators.rollups import counts_in_order
from millrace.sources import state as S

LONG, OTHER = "x" * 250, "y" * 250
ITEMS = "id int, page_key string, url string, title string, published string, summary string"
PAGES = "page_key string, body_text string, final_url string, declared_url string"
STATE = "canonical_url string, content_hash string"


def test_every_reason(spark):
    day = "2026-05-01"
    items = spark.createDataFrame([
        (1, "p1", "https://e.com/1", "t", day, None), (2, "p1", None, "t", day, None), (3, "p1", "ftp://e.com", None, None, None), (4, "p1", "https://e.com/4", "​ ", day, None), (5, "p1", "https://e.com/5", "t", " ", None),
        (6, "p1", "https://e.com/6", "t", "recently", None), (7, "short", "https://e.com/7", "t", day, "<p>too little</p>"), (8, "gone", "https://e.com/8", "t", day, None), (9, "gone", "https://e.com/9", "t", day, f"<p>{LONG}z</p>"),
        (10, "p2", "https://e.com/known", "t", day, None), (11, "p3", "https://e.com/11", "t", day, None), (12, "p1", "https://e.com/12", "t", day, None), (13, "gone", "https://E.com:443/9#x", "t", day, OTHER + "w"),
        (14, "gone", "https://e.com/14", "t", day, OTHER + "w"), (15, "moved", "https://e.com/15", "t", day, None), (16, "elsewhere", "https://e.com/16", "t", day, None), (17, "gone", "https://f.com/new", "t", day, LONG + "17"),
    ], ITEMS)
    pages = spark.createDataFrame([
        ("p1", LONG, None, None), ("p2", LONG + "2", None, None), ("p3", LONG + "3", None, None), ("short", "few", None, None), ("moved", LONG + "15", "https://f.com/new", None), ("elsewhere", LONG + "16", None, "https://other.com/16"),
    ], PAGES)
    known = spark.createDataFrame([("https://e.com/known", None), (None, None)], STATE).union(spark.createDataFrame([(LONG + "3",)], "b string").select(F.lit("https://z.com"), X.content_hash(F.col("b"))))
    rows = {r.id: r for r in I.outcomes(items, pages, known).collect()}
    assert [rows[n].reason for n in range(1, 18)] == [
        None, "missing_url", "invalid_url", "missing_title", "missing_published_at", "invalid_published_at", "body_extraction_failed", "body_fetch_failed", None,
        "already_processed_url", "already_processed_content_hash", "duplicate_of_known_article", "duplicate_of_known_article", None, None, None, "duplicate_of_known_article",
    ]
    assert [rows[n].body_source for n in (1, 9, 8)] == ["extracted", "feed_fallback", None]
    assert [rows[n].canonical_url for n in (13, 15, 16)] == ["https://e.com/9", "https://f.com/new", "https://e.com/16"]
    assert [(g.gate, g.passed) for g in rows[12].results] == [("required_fields", True), ("content_available", True), ("not_previously_processed", True), ("not_known_duplicate", False)]
    order = ["required_fields", "content_available", "not_previously_processed", "not_known_duplicate"]
    assert I.record_violations(I.outcomes(items, pages, known), order).count() == 0


def test_no_items(spark):
    assert I.outcomes(spark.createDataFrame([], ITEMS), spark.createDataFrame([], PAGES), spark.createDataFrame([], STATE)).count() == 0


def test_declared_addresses(spark):
    rows = spark.createDataFrame([("https://a.com/1", None, "https://a.com/2"), ("https://a.com/1", None, "https://b.com/2"), ("https://a.com/1", "https://b.com/1", "https://a.com/3"), ("https://a.com/1", "https://b.com/1", None)], "r string, f string, d string")
    assert [r[0] for r in rows.select(I.chosen_url(F.col("r"), F.col("f"), F.col("d"))).collect()] == ["https://a.com/2", "https://a.com/1", "https://a.com/3", "https://b.com/1"]


def test_gate_records(spark):
    schema = "id int, results array<struct<gate:string,passed:boolean,reason:string>>"
    rows = spark.createDataFrame([
        (1, [("a", True, None), ("b", False, "x")]), (2, [("b", True, None)]), (3, [("a", False, "x"), ("b", True, None)]), (4, [("a", True, "x")]), (5, [("a", False, None)]), (6, []), (7, None),
    ], schema)
    assert {tuple(r) for r in I.record_violations(rows, ["a", "b"]).collect()} == {(2, "order"), (3, "after_failure"), (4, "reason"), (5, "reason"), (6, "no_gates"), (7, "no_gates")}


def test_counts_in_order(spark):
    rows = spark.createDataFrame([("low",), ("high",), ("low",), (None,), ("other",)], "v string")
    assert sorted(map(tuple, counts_in_order(rows, "v", ["high", "middle", "low"]).collect())) == [(1, "high", 1), (3, "low", 2)]


RECORDS = [("https://b.com", "h2", "2026", None), ("https://a.com/é", "h1", None, "included"), ("https://a.com/é", "h0", "2025", "excluded")]


def content(folder):
    return b"".join(p.read_bytes() for p in sorted(folder.glob("part-*")))


def test_state_is_byte_stable_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame(RECORDS, S.STATE)
    S.write_state(rows, str(tmp_path / "one"))
    S.write_state(rows.repartition(7).orderBy(F.rand()), str(tmp_path / "two"))
    assert content(tmp_path / "one") == content(tmp_path / "two") and content(tmp_path / "one").decode().split("\n")[0] == '{"canonical_url":"https://a.com/é","content_hash":"h0","first_seen_at":"2025","last_decision":"excluded"}'
    assert {tuple(r) for r in S.read_state(spark, str(tmp_path / "one")).collect()} == set(RECORDS)


def test_state_is_strict(spark, tmp_path):
    assert S.read_state(spark, str(tmp_path / "missing")).collect() == []
    for n, line in enumerate(['{"canonical_url":"u","more":1}', "[]", "{"]):
        (tmp_path / str(n)).mkdir()
        (tmp_path / str(n) / "part-0").write_text(line)
        with pytest.raises(Exception, match="not a state record"):
            S.read_state(spark, str(tmp_path / str(n))).collect()


def test_runs_are_pruned_by_name(spark, tmp_path):
    for name in ("run-20260501T100000.json", "run-20260503T100000-a.json", "notes.json", "run-20260504T100000.txt"):
        (tmp_path / name).write_text('{"n": 1}')
    (tmp_path / "run-20260401T000000.json").write_text("broken")  # pruned, so never opened
    rows = S.read_runs(spark, str(tmp_path), "n int", "20260501T000000")
    assert sorted(r.started for r in rows.collect()) == ["20260501T100000", "20260503T100000"]
    with pytest.raises(Exception):
        S.read_runs(spark, str(tmp_path), "n int").collect()

"""Problem 3 against a loop over the records in their order."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions.urls import canonical_url
from millrace.llm import boilerplate as B
from millrace.llm import history as H
from millrace.tables import stored

RECORDS = "record_no long, batch_no int, article_no long, canonical_url string, content_hash string, body string, ord long"
ARTICLES = "article_no long, canonical_url string, content_hash string, body_text string, chrome string"


def brute_force(records, articles, bodies):
    """First repeats by plain comparison with every accepted record."""
    hashes = {a[0]: a[2] for a in articles}
    by_no = {b.article_no: b for b in bodies}
    words_of = {no: Counter(np.frombuffer(b.words, np.int32).tolist()) for no, b in by_no.items()}
    keys, accepted, out = {}, [], set()
    for no, batch, article, url, content, *_ in sorted((r for r in records if r[0] is not None), key=lambda r: (-1 if r[1] is None else r[1], r[0])):
        at = (-1 if batch is None else batch, no)
        own = [("u", canonical_url(url)[0] or (url or "").strip()), ("h", content or hashes.get(article))]
        body = by_no.get(article)
        hits = []
        if body and body.body is not None:
            own.append(("b", body.body))
            for other_at, other in accepted:
                both = sum((words_of[article] & words_of[other]).values())
                if both >= H.SIMILARITY * (body.n_words + by_no[other].n_words - both):
                    hits.append(other_at)
        own = [k for k in own if k[1]]
        hits += [keys[k] for k in own if k in keys]
        if hits:
            out.add((min(hits)[1], no))
            continue
        for k in own:
            keys[k] = at
        if body and body.body is not None:
            accepted.append((at, article))
    return out


def sentence(rng):
    return " ".join("".join(rng.choice("bdgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 9))).capitalize() + "."


def fixture(seed=3):
    rng = random.Random(seed)
    articles, records = [], []

    def article(lines):
        text = "\n".join(lines)
        articles.append((len(articles) + 1, f"https://a.example/{len(articles)}", hashlib.sha256(text.encode()).hexdigest(), text, "x"))
        return len(articles)

    for _ in range(12):
        lines = [sentence(rng) for _ in range(6)]
        article(lines)
        for k in range(rng.randrange(4)):
            edited = list(lines)
            edited[k] = sentence(rng)
            article(edited)  # one sentence of six new: the words are mostly the same
        article(lines[:2] + [sentence(rng) for _ in range(8)])  # a quotation
    article([])
    article(["Too short."])
    for no in range(1, 90):
        a = rng.randrange(1, len(articles) + 1)
        url = articles[a - 1][1] + rng.choice(["", "", "#top", "?utm_source=x"])
        records.append((no, rng.choice([1, 2, 3, 40, 41]), rng.choice([a, a, None]), rng.choice([url, url.upper().replace("HTTPS", "https"), f"https://b.test/{no}"]), rng.choice([articles[a - 1][2], None]), "x", 1))
    records += [(90, 50, None, None, None, "x", 1), (91, 50, None, " ", None, "x", 1), (92, None, 1, "not a url", None, "x", 1), (93, 51, 9999, "not a url", None, "x", 1), (None, 1, 1, None, None, "x", 1)]
    return records, articles


def all_bodies(a):
    lines = stored(B.page_lines(a, words=True))
    wanted = a.select(F.lit(1).alias("part"), F.lit(1).alias("ord"), "article_no").distinct()
    return H.main_bodies(lines, stored(B.site_lines(lines)), wanted).collect()


@pytest.fixture(scope="module")
def tables(spark):
    records, articles = fixture()
    return spark.createDataFrame(records, RECORDS), spark.createDataFrame(articles, ARTICLES)


@pytest.fixture(scope="module")
def expected(tables):
    bodies = all_bodies(tables[1])
    assert len({b.body for b in bodies}) > 20
    records, articles = fixture()
    return brute_force(records, articles, bodies)


def test_against_brute_force(tables, expected):
    r, a = tables
    a = a.union(a.limit(5))  # repeated rows change nothing
    got = [tuple(x) for x in H.repeated_records(r, a, step=30).collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_batch_by_batch_in_several_calls(spark, tables, expected):
    """One batch a step, days as batch numbers, and a history that is kept between two calls."""
    r, a = tables
    days = r.withColumn("batch_no", F.col("batch_no") + 20260100)
    history = H.History(spark, buckets=3)
    early = F.coalesce(F.col("batch_no") < 20260140, F.lit(True))
    first = H.repeated_records(days.where(early), a, step=1, history=history).collect()
    second = H.repeated_records(days.where(~early), a, step=1, history=H.History(spark, history.name)).collect()
    assert {tuple(x) for x in first + second} == expected and len(first + second) == len(expected)
    history.drop()
    assert history.read("keys") is None


@pytest.mark.parametrize("partitions", ["3", "200"])
def test_history_is_never_shuffled(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    history = H.History(spark, buckets=8)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        history.append("keys", spark.range(1000).select(F.col("id").alias("key"), F.col("id").alias("ord")), "key")
        plan = history.beside("keys", spark.range(40).select(F.col("id").alias("key")), "key", "left_semi")
        assert plan.count() == 40
        text = plan._jdf.queryExecution().executedPlan().toString()
        scan = next(k for k, line in enumerate(text.split("\n")) if history.name in line)
        above = [line for line in text.split("\n")[:scan] if "Exchange" in line]
        assert "Bucketed: true" in text and not above
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        history.drop()


def test_empty(spark):
    assert H.repeated_records(spark.createDataFrame([], RECORDS), spark.createDataFrame([], ARTICLES)).collect() == []

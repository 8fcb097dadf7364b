"""Problem 7: every token is placed once, no container is too full, little space is unused."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import packing as P
from millrace.llm.tokens import encoder

SCHEMA = "doc_id long, text string, key string, shard int"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=40), st.integers(1, 6))
def test_differencing_places_every_item_in_a_window(sizes, windows):
    placed = P.differencing(np.array(sizes, np.int64), windows)
    assert len(placed) == len(sizes) and all(0 <= w < windows for w in placed)


def test_differencing_known_cases():
    # The textbook two-way example: 8 7 6 5 4 by differencing ends at a difference of 2.
    sizes = np.array([8, 7, 6, 5, 4])
    assert abs(int(np.diff(np.bincount(P.differencing(sizes, 2), sizes))[0])) == 2
    assert sorted(np.bincount(P.differencing(np.array([9, 8, 1, 2, 5, 5]), 3), [9, 8, 1, 2, 5, 5])) == [10, 10, 10]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 100), min_size=1, max_size=60))
def test_pack_keeps_the_capacity(sizes):
    sizes = np.array(sizes, np.int64)
    placed = P.pack(sizes, 100)
    assert np.bincount(placed, sizes).max() <= 100


def test_pack_is_tight():
    sizes = np.random.default_rng(2).lognormal(5.5, 0.9, 2000).astype(np.int64).clip(1, 2048)
    placed = P.pack(sizes, 2048)
    assert len(set(placed.tolist())) <= 1.04 * -(-int(sizes.sum()) // 2048)


def test_table(spark):
    texts = {1: "word " * 700, 2: None, 3: "", 4: "a b c", 5: "tail " * 300, None: "no key"}
    rows = [(k, t, "clash", 1) for k, t in texts.items()] + [(4, "a b c", "clash", 1)]
    out = P.packed_texts(spark.createDataFrame(rows, SCHEMA), capacity=256, shard=2).collect()
    sums, spans = {}, {}
    for r in out:
        sums[r.container] = sums.get(r.container, 0) + r.n_tokens
        spans.setdefault(r.doc_id, []).append((r.first_token, r.n_tokens))
    assert max(sums.values()) <= 256
    for k, t in texts.items():
        size, at = encoder().count(t), 0
        if k == 4:
            assert spans[4] == [(0, size)] * 2
            continue
        for first, n in sorted(spans[k]):
            assert first == at and (n == 256 or at + n == size)
            at += n
        assert at == size
    assert P.packed_texts(spark.createDataFrame([], SCHEMA)).collect() == []


def test_fill(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    row = P.container_fill(P.packed_texts(docs)).first()
    assert row.tokens == sum(encoder().count(r.text) for r in docs.select("text").collect())
    assert row.fullest <= P.CAPACITY and row.unused < 0.05


@pytest.mark.parametrize("text", ["", "a", "a b  c\n\nd", "東京の作業領域"])
def test_count_is_the_length_of_the_encoding(text):
    assert encoder().count(text) == len(encoder().encode(text))


def test_containers_do_not_depend_on_the_partitions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").dropDuplicates(["doc_id"])
    some = lambda df: {tuple(r) for r in P.packed_texts(df, capacity=512, shard=16).collect()}
    assert some(docs.repartition(7)) == some(docs.repartition(2).orderBy("text"))


def test_many_items_of_no_size_and_one_key(spark, monkeypatch):
    monkeypatch.setattr(P, "ITEMS", 100)
    rows = spark.range(1000).selectExpr("cast(null as bigint) doc_id", "if(id % 10 = 0, 'word', '') text")
    got = P.packed_texts(rows).collect()
    shards = {r.container >> 32 for r in got}
    assert len(got) == 1000 and len(shards) > 5 and sum(r.n_tokens for r in got) == 100

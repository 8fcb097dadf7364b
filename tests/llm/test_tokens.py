"""Problem 6 against a public implementation of the same vocabulary."""

import os
import pickle

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import tokens as T


@pytest.fixture(scope="module")
def reference():
    ranks = T.read_ranks(os.path.join(T.TOKENIZERS, T.VOCABULARY))
    return tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_has_every_entry_and_no_other():
    ids = T.read_ranks(os.path.join(T.TOKENIZERS, T.VOCABULARY))
    table = T.encoder().entries
    assert sorted(table.keys) == sorted(ids) and all(table.get(k) == i for k, i in ids.items())
    assert table.get(b"") == -1 and table.get(b"no such entry at all") == -1


ODD = ["", " ", "<|endoftext|>", "a" * 30_000, "\r\n\t  x", "𓀀𓀁 é é ﷽", "東京の作業領域で、要約の処理を記録した。", "zażółć gęślą jaźń", "don't WON'T '''", "​﻿\x00"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(reference, text):
    assert T.encoder().encode(text).tolist() == reference.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    ranks = T.read_ranks(os.path.join(T.TOKENIZERS, T.VOCABULARY))
    own = test_any_text.__dict__.setdefault("own", tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    assert T.encoder().encode(text).tolist() == own.encode_ordinary(text)


def test_memory_is_bounded(monkeypatch):
    encoder = pickle.loads(pickle.dumps(T.encoder()))
    monkeypatch.setattr(T, "MEMO", 10)
    first = encoder.encode("one two three four five six seven eight nine ten eleven twelve")
    assert len(encoder.memo) > 10
    encoder.encode("next")
    assert len(encoder.memo) == 1 and encoder.encode("one two three").tolist() == first[:3].tolist()


def test_table(spark, sf, reference):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    expected = {r.doc_id: reference.encode_ordinary(r.text) if r.text else [] for r in docs.collect()}
    assert {r.doc_id: r.ids for r in T.encode_texts(docs).collect()} == expected
    assert {r.doc_id: r.n_tokens for r in T.token_counts(docs).collect()} == {k: len(v) for k, v in expected.items()}


def test_nulls_repeats_empty_and_clashing_columns(spark):
    schema = "doc_id long, text string, ids string, key string"
    out = T.encode_texts(spark.createDataFrame([(1, None, "x", "k"), (1, "", "x", "k"), (None, "a", None, None), (2, "a", "y", "k"), (2, "a", "y", "k")], schema))
    assert out.columns == ["doc_id", "ids"]
    assert sorted((r.doc_id or 0, r.ids) for r in out.collect()) == [(0, [64]), (1, []), (1, []), (2, [64]), (2, [64])]
    assert T.encode_texts(spark.createDataFrame([], schema)).collect() == []

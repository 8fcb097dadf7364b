"""Problem 1: signs, copies, limits and closing words on small tables."""

import random

import numpy as np
import pytest

from millrace.llm import truncation as T
from millrace.llm.words import WordHashes, all_shingles, band_keys, jaccard, shingles, word_hashes

SCHEMA = "item_no long, source_id string, title string, feed_summary string"


def found(spark, rows, schema=SCHEMA):
    return {(r.item_no, r.field_name): r.evidence for r in T.truncated_values(spark.createDataFrame(rows, schema)).collect()}


@pytest.mark.parametrize(
    "value, sign",
    [("A whole thing.", "terminal"), ("A whole thing. (3 min read)", "terminal"), ("Done. #tag", "terminal"), ("Done. — Ann Lee", "terminal"), ("Done.\n- one\n- two", "terminal"),
     ("終わった。", "terminal"), ("Done (now).", "terminal"), ('He said "yes."', "terminal"), ("a piec…", "ellipsis"), ("a piec...", "ellipsis"), ("a piece [...]", "more"), ("a… Read more", "more"),
     ("a pie�", "broken"), ("a piece<a hre", "broken"), ("a piece&quo", "broken"), ("a piece of", "none"), ("<p>Done.</p>", "terminal")],
)
def test_signs(value, sign):
    assert T.dissect(value)[1] == sign


def texts(n, seed=0):
    rng = random.Random(seed)
    nouns, verbs, adjectives = ["planner", "ledger", "sandbox", "router", "digest", "harness"], ["guarded", "measured", "replaced", "audited"], ["idle", "noisy", "shared", "brittle"]
    clause = lambda: f"the {rng.choice(adjectives)} {rng.choice(nouns)} {rng.choice(verbs)} every {rng.choice(adjectives)} {rng.choice(nouns)}"
    return [". ".join(f"{clause()} while {clause()}" for _ in range(rng.randint(2, 5))) + "." for _ in range(n)]


def test_limit_and_words(spark):
    rows, cut = [], set()
    for i, text in enumerate(texts(600)):
        short = i % 2 and len(text) > 150
        rows.append((i, "capped" if i % 2 else "free", f"the {text.split()[1]} {text.split()[2]}", text[:150].rstrip() if short else text))
        cut |= {(i, "feed_summary")} if short else set()
    got = set(found(spark, rows))
    assert {k for k in got if k[1] == "feed_summary"} == cut


def test_whole_summaries_without_a_stop(spark):
    """A source that writes no full stops isn't a source that cuts: the closing words tell."""
    rng, rows, cut = random.Random(3), [], set()
    for i, text in enumerate(texts(900, 7)):
        words = text[:-1].split()
        kind = ("stops", "bare", "cut")[i % 3]
        rows.append((i, kind, None, {"stops": text, "bare": text[:-1], "cut": " ".join(words[: rng.randint(9, len(words) - 2)]).rstrip(".")}[kind]))
        cut |= {i} if kind == "cut" else set()
    got = {i for i, _ in found(spark, rows)}
    assert not any(rows[i][1] == "bare" for i in got) and not any(rows[i][1] == "stops" for i in got)
    assert len(got & cut) > 0.95 * len(cut)


def test_copies(spark):
    long = texts(1, 5)[0][:-1].replace(".", ",") + " and after the third run the gate reused all of the notes."
    words = long.split()
    short = " ".join(words[: len(words) - 2])
    memo = WordHashes()
    assert T.ends_early(short, long, memo) and not T.ends_early(long, long, memo) and not T.ends_early(long, long + " (3 min read)", memo) and not T.ends_early("other words here", long, memo)
    assert found(spark, [(1, "a", short, None), (2, "b", long, None)])[(1, "title")] == "copy"


def test_copies_at_any_cut_and_with_edits(spark):
    """Recall of the copy stage against all pairs: cuts anywhere behind the sixth word, a third of them with an edit."""
    rng, rows, cut = random.Random(11), [], set()
    for i, text in enumerate(dict.fromkeys(t.replace(".", ",")[:-1] + f" with run {n} of the last {n * 7}" for n, t in enumerate(texts(120, 9)))):
        words = text.split()
        at = rng.randint(7, len(words) - 2)
        part = words[:at]
        if i % 3 == 0 and at > 22:
            part[10] = "quietly"
        rows += [(2 * i, "s", None, text), (2 * i + 1, "s", None, " ".join(part))]
    memo = WordHashes()
    for i, _, _, a in rows:
        if any(len(b) > len(a) and b[:12] == a[:12] and T.ends_early(a, b, memo) for j, _, _, b in rows if i != j):
            cut.add(i)
    values = T._values(spark.createDataFrame(rows, SCHEMA))
    features = values.select("item_no", "source_id", "field_name", "value").mapInArrow(T._dissected, T._FEATURES.format(kind="long")).where("item_no is not null")
    got = {r.item_no for r in T._by_copies(features, values).collect()}
    assert len(cut) > 80 and got <= cut and len(got) >= 0.95 * len(cut)


def test_crowded_buckets(spark):
    """Many texts with one beginning: each cut value finds the only one that goes on as it does."""
    start = "every morning the shared planner of the team reads"
    rows = [(i, "s", None, f"{start} ledger{i} and then it writes file{i * 3} to disk{i} for all") for i in range(40)]
    rows += [(100 + i, "s", None, f"{start} ledger{i} and then it wri") for i in range(40)]
    values = T._values(spark.createDataFrame(rows, SCHEMA))
    features = values.select("item_no", "source_id", "field_name", "value").mapInArrow(T._dissected, T._FEATURES.format(kind="long")).where("item_no is not null")
    assert {r.item_no for r in T._by_copies(features, values).collect()} == set(range(100, 140))


def copies(spark, rows):
    values = T._values(spark.createDataFrame(rows, SCHEMA))
    features = values.select("item_no", "source_id", "field_name", "value").mapInArrow(T._dissected, T._FEATURES.format(kind="long")).where("item_no is not null")
    return {r.item_no for r in T._by_copies(features, values).collect()}


def test_crowded_buckets_against_all_pairs(spark):
    """Edited copies, copies that go on differently and unlike texts, all with one beginning: no pair is left out."""
    rows = []
    start = "every morning the shared planner of the team reads"
    for i in range(30):
        long = f"{start} ledger{i} and then it writes file{i * 3} to disk{i} for all of the {i} readers in town"
        words = long.split()
        words[15] = "quietly"
        rows += [(i, "s", None, long), (100 + i, "s", None, " ".join(words[:18])), (200 + i, "s", None, f"{start} ledger{i} and then it writes fine things at home, at work and wherever else the readers of ledger{i} are")]
    # The longest text that goes on with this first letter shows no cut; a shorter one does.
    rows += [(400, "s", None, f"{start} notes and then it sto"), (401, "s", None, f"{start} notes and then it stores all"), (402, "s", None, f"{start} notes and then it sits in the long hall of the old house and waits for rain")]
    want = {i for i, _, _, a in rows if any(i != j and len(a.split()) <= len(b.split()) and T.ends_early(a, b) for j, _, _, b in rows)}
    assert {400} | set(range(100, 130)) <= want
    assert copies(spark, rows) == want


@pytest.mark.parametrize("value, sign", [("Done.\n" + "- item of a list\n" * 200 + "- last", "terminal"), ("a piece<a href='" + "x" * 900, "broken"), ("Done." + " " * 50_000 + "(3 min read)", "terminal")])
def test_signs_of_any_length(value, sign):
    assert T.dissect(value)[1] == sign


def test_closing_word_of_any_length():
    assert T.dissect("ends in " + "x" * 900)[2] == "x" * 900 and T.dissect("ends in word" + " *" * 300)[2] == "word"


def test_limit_below_an_outlier(spark):
    rows = [(i, "s", "t", t) for i, t in enumerate(x[:120].rstrip() if len(x) > 120 else x for x in texts(300, 4))]
    rows.append((999, "s", "t", "word " * 100))
    features = T._values(spark.createDataFrame(rows, SCHEMA)).selectExpr("source_id", "field_name", "length(value) length")
    assert [r.limit for r in T.limits(features.where("field_name = 'feed_summary'")).collect()] == [120]


def test_nulls_blanks_repeats_empty_and_extra_columns(spark):
    rows = [(1, None, None, None), (2, "s", "", " ​"), (3, "s", "x" * 50_000, "cut off he<a hre"), (4, "s", "x", "cut off he<a hre"), (5, None, "?", "gone&quo")]
    schema = SCHEMA + ", value string, field_name string, length int"
    got = found(spark, [(*r, "v", "f", 1) for r in rows], schema)
    assert {k for k in got if k[1] == "feed_summary"} == {(3, "feed_summary"), (4, "feed_summary"), (5, "feed_summary")}
    assert found(spark, []) == {}


def test_rates(spark):
    rows = [(1, "s", None, "cut off he<a hre"), (2, "s", None, "Whole."), (3, None, None, "cut&quo")]
    got = {(r.source_id, r.field_name): (r.n_values, r.n_cut, r.share) for r in T.truncation_rates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {("s", "feed_summary"): (2, 1, 0.5), (None, "feed_summary"): (1, 1, 1.0)}


def test_batched_shingles_equal_single_ones():
    memo = WordHashes()
    words = [word_hashes(t, memo) for t in [*texts(20), "one two", "", "one two three four five", "東京の作業"]]
    values, starts = all_shingles(words)
    ends = [*starts[1:], len(values)]
    for w, s, e in zip(words, starts, ends):
        if len(w) >= 5:
            assert np.array_equal(np.unique(values[s:e]), shingles(w))
    keys = band_keys(words, 4, 2)
    assert np.array_equal(keys, np.vstack([band_keys([w], 4, 2) for w in words]))
    assert jaccard(shingles(words[0]), shingles(words[0])) == 1.0


def test_keys_are_exploded_once(spark, monkeypatch):
    """What follows the buckets reads only keys that two different texts have."""
    whole = [t[:-1] + " and more of it" for t in texts(40, 11)]
    rows = [(i, "a", None, t) for i, t in enumerate(whole)] + [(100 + i, "b", None, " ".join(t.split()[:14])) for i, t in enumerate(whole)]
    rows += [(200 + i, "c", None, " ".join(f"only{i}word{k}" for k in range(30))) for i in range(40)]
    written = []
    monkeypatch.setattr(T, "stored", lambda df, keep=T.stored: written.append(keep(df)) or written[-1])
    got = found(spark, rows)
    assert sum(e == "copy" and 100 <= i < 200 for (i, _), e in got.items()) >= 38
    shared = [df for df in written if {"key", "value", "looks"} <= set(df.columns)]
    assert len(shared) == 1
    hashes = {}
    for r in shared[0].collect():
        assert r.value.item_no < 200
        hashes.setdefault(r.key, set()).add(r.value.text_hash)
    assert hashes and min(map(len, hashes.values())) > 1


def test_texts_are_hashed_together():
    """Texts with and without blanks, in any order, get the hashes that each gets alone."""
    import pyarrow as pa

    values = ["東京の作業を確認する話が続く。次の週も同じ", "One two three four five six.", "the plan 東京の作業を確認する", "", "a&#26481;b c d e f", "five words are in here, six 続きを読む"]
    many = lambda v: pa.RecordBatch.from_arrays([pa.array(range(len(v)), pa.int64()), *(pa.array(["s"] * len(v)) for _ in range(2)), pa.array(v)], names=["item_no", "source_id", "field_name", "value"])
    read = lambda v: [r | {"item_no": 0} for b in T._dissected(iter([many(v)])) for r in b.to_pylist() if r["item_no"] is not None]
    assert read(values) == [read([v])[0] for v in values]
    arrays = [word_hashes(v, WordHashes()) for v in values]
    assert all(np.array_equal(a, b) for a, b in zip(T._all_fours(arrays), map(T._fours, arrays), strict=True)) and T._all_fours([]) == []


@pytest.mark.parametrize("end", [" (3 min read)", "(4 хв читання)", " #tag #other", " — Ann Lee", "\u2003-\u2003Bo", " https://x.test/a", "☀️", " 👩‍💻", "\ufe0f", " `code`"])
def test_appendices_are_found_by_their_characters(end):
    assert T.without_appendix("A whole thing. Done." + end) == "A whole thing. Done."


def test_crowded_texts_of_one_pattern_make_no_pairs(spark, monkeypatch):
    """400 texts with the same beginning and the same end are no near-copies: only the cut one and its whole text are a pair."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**6)}"
    texts = [f"We can't say whether one {' '.join(word() for _ in range(9))} and it is five weeks until the board ships" for _ in range(400)]
    rows = [(k, "s", None, t) for k, t in enumerate(texts)] + [(400, "s", None, texts[7][: texts[7].index(" ships") - 2])]
    items = spark.createDataFrame(rows, "item_no long, source_id string, title string, feed_summary string")
    met = []
    monkeypatch.setattr(T, "stored", lambda df, keep=T.stored: met.append(keep(df)) or met[-1])
    assert 400 in {r.item_no for r in T.truncated_values(items).where("evidence = 'copy'").collect()}
    assert sum(df.count() for df in met if "other_no" in df.columns) < 20


def test_short_values_against_whole_ones(spark):
    """Values of two to five words, or of few characters without blanks, are the beginnings of others."""
    cut = ["Partial tool l", "How Doven traced the sandboxed…", "The release bran", "How Treven isola�", "Show: Wiflulven, the", "ドルニア：新しい依頼のたびに夜間の", "小さな組織のた", "Mio_flaiven: die Aus"]
    whole = [c.rstrip("…�") + "x and more of it all" for c in cut[:1]] + ["How Doven traced the sandboxed queue by night", "The release branch of Kam", "How Treven isolated the log",
             "Show: Wiflulven, the compact linter", "ドルニア：新しい依頼のたびに夜間の実行が小型のモデルを保存する話", "小さな組織のために評価する", "Mio_flaiven: die Auswertung beginnt"]
    # A finished text, an addition after it, a number's rest, another word, and the same words.
    no = [("Ready now.", "Ready now we go"), ("A new tool", "A new tool | Kam's site"), ("Sonnet 4", "Sonnet 4.5 is here"), ("A big cat", "A big dog is here"), ("The same words", "The Same Words"), ("Alone", "Alone at last today")]
    rows = [(k, "a", t, None) for k, t in enumerate(cut)] + [(100 + k, "b", t, None) for k, t in enumerate(whole)]
    rows += [(200 + 2 * k + n, "c", None, t) for k, pair in enumerate(no) for n, t in enumerate(pair)]
    assert copies(spark, rows) == set(range(len(cut)))

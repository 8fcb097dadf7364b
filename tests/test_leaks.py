"""Shared passages against comparison of all windows."""

import random

import numpy as np

from millrace.operators import leaks as L


def test_fingerprints_meet_in_every_shared_passage():
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcdé東 ") for _ in range(n))
    for _ in range(200):
        shared = word(L.PASSAGE)
        a, b = word(rng.randrange(80)) + shared + word(rng.randrange(80)), word(rng.randrange(80)) + shared + word(rng.randrange(80))
        assert set(L.fingerprints(a)) & set(L.fingerprints(b)) and L.share_passage(a, b)
    assert len(L.fingerprints("x" * 63)) == 0 and not L.share_passage("a" * 63, "a" * 63)


def test_table(spark):
    secret = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(60))
    texts = [(1, "see " + secret[:64] + " end"), (2, secret[:63]), (3, None), (4, "see " + secret[:64] + " end"), (5, ""), (6, secret[5:80].replace("d", "\n d ") * 2)]
    got = {r.id: (r.secret_id, r.secrets) for r in L.shared_passages(spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame([(9, secret), (8, secret), (7, None)], "id long, text string")).collect()}
    assert got == {1: (8, 2), 4: (8, 2)}
    assert L.shared_passages(spark.createDataFrame([], "id long, text string"), spark.createDataFrame([], "id long, text string")).collect() == []


def test_short_secrets_are_matched_whole(spark):
    texts = [(1, "he said: the key is  kept\nbelow the mat, he said"), (2, "the key is kept below the ma"), (3, "fifteen letters"), (4, "東" * 40), (5, None)]
    secrets = [(11, "the key is kept below the mat"), (10, "the key is kept  below the mat"), (12, "fifteen letters"), (13, "東" * 16), (14, "x" * 16), (15, None)]
    table = lambda rows: spark.createDataFrame(rows, "id long, text string")
    got = {r.id: (r.secret_id, r.secrets) for r in L.shared_passages(table(texts), table(secrets), L.SHORT).collect()}
    assert got == {1: (10, 2), 4: (13, 1)}
    assert L.shared_passages(table(texts), table(secrets)).collect() == []


def test_batches_give_what_all_windows_give(spark):
    """Texts around the piece of characters that are worked on at once, passages across their ends, copies and repeats."""
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abcdefgh é東𝄞") for _ in range(n)).strip()
    shared = [" ".join(word(90).split()) for _ in range(6)]
    texts = [" ".join((word(rng.randrange(300)) + s[k : k + n] + word(rng.randrange(300))).split()) for s in shared for k, n in ((0, 64), (3, 70), (8, 63), (5, 40), (10, 20))]
    texts += [word(L.PIECE + 5), shared[0][:30], "", shared[1][:70] * 3, word(63), word(64)] + [shared[2] + word(40)] * 2
    secrets = [*shared, *(s[10:29] for s in shared), shared[3][4:60], word(16), word(15), shared[4][:64], word(500)]
    plain = lambda t: " ".join(t.split(" ")).strip()
    want = {}
    for n, t in enumerate(map(plain, texts)):
        got = [k for k, s in enumerate(map(plain, secrets)) if (len(s) >= 64 and L.share_passage(t, s)) or (16 <= len(s) < 64 and s in t)]
        if got:
            want[n] = (got[0], len(got))
    table = lambda rows: spark.createDataFrame(list(enumerate(rows)), "id long, text string").repartition(3)
    assert {r.id: (r.secret_id, r.secrets) for r in L.shared_passages(table(texts), table(secrets), L.SHORT).collect()} == want and len(want) > 20


def test_texts_are_read_together():
    """One call for many short texts, and few passages that share no more than a frequent phrase."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    texts = [word(rng.randrange(200)) for _ in range(300)]
    alone = [L.fingerprints(t) for t in texts]
    prints = L._read(texts)[2]
    assert set(prints) == set().union(*map(set, alone))
    # A phrase of 40 characters in other words each time: the least gram alone would choose a fifth of the passages.
    phrase = word(40)
    a, b = (L._read([word(60) + phrase + word(60) for _ in range(200)])[2] for _ in "ab")
    assert len(set(a) & set(b)) > 0 and np.isin(a, b).mean() < 0.08

"""Order-dependent deduplication against a loop over the rows."""

import random

from millrace.operators import greedy


def sequential(rows):
    """{ord: first accepted row it repeats or None} by walking through rows of (ord, keys)."""
    expected, have = {}, {}
    for o, keys in sorted(rows):
        hits = [have[k] for k in keys if k in have]
        expected[o] = min(hits) if hits else None
        if not hits:
            have.update(dict.fromkeys(keys, o))
    return expected


def test_random_rows(spark):
    rng = random.Random(8)
    rows = [(o, {rng.randrange(14) for _ in range(rng.randint(1, 2))}) for o in range(30)]
    claims = spark.createDataFrame([(o, k) for o, keys in rows for k in keys], "ord long, key long")
    assert {x.ord: x["first"] for x in greedy.resolve(claims, claims).collect()} == sequential(rows)


def test_rejected_rows_block_nothing(spark):
    # 1 and 2 share a hash, 2 and 3 an address: 2 repeats 1, so 3 is accepted.
    rows = spark.createDataFrame([(1, "u1", "h1"), (2, "u2", "h1"), (3, "u2", "h3"), (4, None, None), (5, None, "h3"), (6, "h1", None)], "no long, url string, hash string")
    assert {r.no: r.repeats for r in greedy.first_of_kind(rows, "no", ["url", "hash"]).collect()} == {1: None, 2: 1, 3: None, 4: None, 5: 3, 6: None}


def test_empty(spark):
    assert greedy.first_of_kind(spark.createDataFrame([], "no long, url string"), "no", ["url"]).collect() == []

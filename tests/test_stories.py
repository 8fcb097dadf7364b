"""Similar titles against comparison of all pairs, and how many pairs are compared."""

import random

from millrace.operators import components
from millrace.operators import stories as S


def by_all_pairs(titles):
    sets = sorted({tuple(sorted(set(t.split()))) for t in titles if t.split()})
    alike = set()
    for k, a in enumerate(sets):
        for b in sets[k + 1 :]:
            shared = len(set(a) & set(b))
            if shared >= S.SHARED_WORDS and shared * 5 >= (len(a) + len(b) - shared) * 3:
                alike.add((frozenset((a, b)), shared))
    return alike


def similar(spark, titles):
    classes = S.title_classes(spark.createDataFrame(list(enumerate(titles)), "key long, title string"), "key")
    words = {r.title_class: tuple(r.words) for r in classes.collect()}
    rows = S.similar_classes(classes).collect()
    assert all(r.left_class < r.right_class for r in rows)
    got = [(frozenset((words[r.left_class], words[r.right_class])), r.shared) for r in rows]
    assert len(got) == len(set(got))
    return set(got)


def test_similar_classes_of_any_length(spark):
    rng = random.Random(7)
    titles = []
    for size in [*range(1, 15), *range(18, 36, 2), 40, 55, 58, 65, 90, 99, 102, 130, 170]:
        first = [f"w{rng.randrange(40 if size < 15 else 400)}" for _ in range(size)]
        titles.append(" ".join(first))
        for _ in range(6):  # some words replaced, some left out or added
            other = [w if rng.random() < 0.85 else f"w{rng.randrange(400)}" for w in first]
            titles.append(" ".join(other[: max(1, int(size * rng.uniform(0.55, 1)))] + [f"x{rng.randrange(9)}" for _ in range(rng.randrange(1 + size // 2))]))
    want = by_all_pairs(titles)
    assert len(want) > 100 and any(min(map(len, pair)) > 100 for pair, _ in want)
    assert similar(spark, titles) == want


def test_frequent_words_make_few_candidates(spark, monkeypatch):
    """Titles put together from the same words by chance are hardly ever compared."""
    rng = random.Random(3)
    titles = [" ".join(rng.sample([f"w{k}" for k in range(200)], 9)) + f" name{n}" for n in range(1500)]
    written = []
    monkeypatch.setattr(S, "stored", lambda df, keep=S.stored: written.append(keep(df)) or written[-1])
    assert similar(spark, titles) == by_all_pairs(titles)
    candidates = [df.count() for df in written if df.columns == ["l_no", "r_no"]]
    assert len(candidates) == 1 and candidates[0] < 1500


def test_words_of_one_title_alone_take_no_part(spark, monkeypatch):
    """Words that no other title has make no groups to be joined, and pairs are the same with any number of these."""
    rng = random.Random(11)
    titles = []
    for n in range(120):
        first = rng.sample([f"w{k}" for k in range(60)], rng.randrange(3, 16))
        for m in range(3):
            kept = [w for w in first if rng.random() < 0.9]
            titles.append(" ".join(kept + [f"name{n}of{m}no{k}" for k in range(rng.randrange(4))]))
    written = []
    monkeypatch.setattr(S, "stored", lambda df, keep=S.stored: written.append(keep(df)) or written[-1])
    want = by_all_pairs(titles)
    assert len(want) > 50 and similar(spark, titles) == want
    ranked = [r for df in written if "bits" in df.columns for r in df.collect()]
    assert len(ranked) > 200 and not any(w.startswith("name") for r in ranked for w in r.words)


def test_classes_take_part_under_their_smallest_key(spark, monkeypatch):
    """Stories of repeated titles, repeated keys and links against union-find; a class gives no edge for each of its articles."""
    from tests.test_components import union_find

    rng = random.Random(5)
    names = [" ".join(rng.sample([f"w{k}" for k in range(24)], rng.choice((1, 2, 5, 6, 7)))) for _ in range(60)]
    titles = [(key, rng.choice(names)) for key in range(400)] + [(7, names[0] + " w90 w91"), (7, names[1] + " w92 w93"), (500, None), (501, ""), (None, names[2]), (None, names[3])]
    rng.shuffle(titles)
    articles = spark.createDataFrame([(k, t, f"https://x.test/{k}", f"s{(k or 0) % 2}") for k, t in titles], "article_id long, title string, canonical_url string, source_id string")
    links = spark.createDataFrame([(500, "https://x.test/33"), (12, "https://x.test/501"), (20, "https://x.test/41")], "article_id long, url string")
    sets = [(k, frozenset(t.split())) for k, t in titles if k is not None and t]
    near = lambda x, y: len(x & y) >= S.SHARED_WORDS and len(x & y) * 5 >= len(x | y) * 3
    pairs = [(a, b) for a, x in sets for b, y in sets if a <= b and near(x, y)] + [(500, 33), (12, 501), (20, 41)]
    given = []
    monkeypatch.setattr(S, "connected_components", lambda edges, keep=S.connected_components: given.append(edges.count()) or keep(edges))
    got = [(r.article_id, r.story) for r in S.story_clusters(articles, "article_id", links=links).collect()]
    want = union_find(pairs)
    assert len(got) == len(set(got)) == 402 and dict(got) == {k: want.get(k, k) for k, _ in titles if k is not None}
    assert given[0] < 100


def test_nothing_that_grows_is_broadcast(spark, monkeypatch):
    """Stored tables are small on the disk, and many times as large when the driver holds their exploded rows."""
    plans = []

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    for module in (S, components):
        monkeypatch.setattr(module, "stored", lambda df, keep=module.stored: keep(planned(df)))
    titles = [f"w{k % 7} w{k % 5} w{k % 3} w{k}" for k in range(60)]
    articles = spark.createDataFrame([(k, t, f"https://a.example/{k}", f"s{k % 2}") for k, t in enumerate(titles)], "article_id long, title string, canonical_url string, source_id string")
    links = spark.createDataFrame([(1, "https://a.example/4")], "article_id long, url string")
    planned(S.story_clusters(articles, links=links))
    planned(S.similar_classes(S.title_classes(articles, "article_id")))
    assert len(plans) > 8 and not any("Broadcast" in p for p in plans)

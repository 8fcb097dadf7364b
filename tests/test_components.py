"""Components against union-find."""

import random

from millrace.operators.components import connected_components


def union_find(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def run(spark, pairs):
    return {r.id: r.root for r in connected_components(spark.createDataFrame(pairs, "a string, b string")).collect()}


def test_random_graphs_paths_and_stars(spark):
    rng = random.Random(4)
    pairs = [(f"r{rng.randrange(60):03}", f"r{rng.randrange(60):03}") for _ in range(45)]
    pairs += [(f"p{i:03}", f"p{i + 1:03}") for i in range(40)] + [("s000", f"s{i:03}") for i in range(30)] + [("z", "z")]
    assert run(spark, pairs) == union_find(pairs)


def test_nulls_and_empty(spark):
    assert run(spark, [("a", None), (None, None), ("b", "c"), ("b", "c")]) == {"b": "b", "c": "b"}
    assert run(spark, []) == {}


def test_stories_through_links(spark):
    from millrace.operators.stories import story_clusters

    rows = [(1, "https://a.test/1", "s1", "Alpha beta gamma"), (2, "https://b.test/2", "s2", "Other words here"), (3, "https://c.test/3", "s2", None), (4, None, None, "Alone"), (5, "https://b.test/2", "s1", "Unlike all")]
    articles = spark.createDataFrame(rows, "article_no long, canonical_url string, source_id string, title string")
    links = spark.createDataFrame([(3, "https://a.test/1"), (3, "https://a.test/1"), (2, "https://c.test/3"), (4, "https://a.test/1"), (3, "https://b.test/2"), (1, None), (9, "https://a.test/1")], "article_no long, url string")
    # 2 and 3 are of one source; the last article of an address is meant, so 3 links to 5; 4 has no source.
    got = {r.article_no: r.story for r in story_clusters(articles, "article_no", links=links).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 1}
    assert {r.article_no: r.story for r in story_clusters(articles, "article_no").collect()} == {n: n for n in range(1, 6)}


def test_edges_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("z", "z")], "a string, b string").mapInArrow(counted, "a string, b string")
    assert {r.id: r.root for r in connected_components(edges).collect()} == {"a": "a", "b": "a", "c": "a", "z": "z"}
    assert made.value == 3

"""Problem 2 against a plain loop over the groups."""

from datetime import datetime, timedelta

from millrace.llm import representative as R

CLUSTERS = "representative string, supporting array<string>, article_id string"
SELECTIONS = "run_id string, duplicate_groups array<struct<representative_id string, duplicate_ids array<string>>>"
ARTICLES = "article_no long, article_id string, source_id string, title string, author string, published_at timestamp, fetched_at timestamp, group_id string, mask int"
SOURCES = "source_id string, trust_rank int, title string"
T0 = datetime(2026, 8, 1)


def run(spark, clusters, selections, articles, sources):
    out = R.surviving_records(
        spark.createDataFrame([(*c, "clash") for c in clusters], CLUSTERS), spark.createDataFrame(selections, SELECTIONS),
        spark.createDataFrame([(*a, "clash", 1) for a in articles], ARTICLES), spark.createDataFrame([(*s, "clash") for s in sources], SOURCES),
    )
    rows = [tuple(r) for r in out.select("group_id", "field_name", "article_id").collect()]
    assert len(rows) == len(set(rows))
    return {(g, f): a for g, f, a in rows}


def row(no, key, source="s1", title="A title that is whole", author="Ann Lee", published=T0, fetched=T0 + timedelta(days=2)):
    return (no, key, source, title, author, published, fetched)


SOURCE_ROWS = [("s1", 1), ("s2", 2), ("s3", 3)]


def test_policy_and_layers(spark):
    articles = [
        row(1, "a", "s2", author=None, fetched=T0 + timedelta(days=9)), row(2, "b", "s1", title="[title]", author="—"), row(3, "c", "s3", title="Untitled", author="Bo"),
        row(4, "d", "s1", title="n/a", author="staff", published=datetime(1970, 1, 1), fetched=T0 + timedelta(days=20)), row(5, "e", "gone"),
    ]
    got = run(spark, [("a", ["b", "c"]), ("c", ["d", "nowhere"]), ("nowhere", ["e"]), ("e", ["e", None]), (None, None)], [("r", None)], articles, SOURCE_ROWS)
    assert got == {("a", "title"): "a", ("a", "author"): "c", ("a", "published_at"): "b"}


def test_groups_through_others_and_over_runs(spark):
    articles = [row(i, k, "s1", fetched=T0) for i, k in enumerate("abcdef")]
    got = run(spark, [("b", ["a"]), ("d", [])], [("r1", [("c", ["b", "b"]), ("e", None)]), ("r2", [("f", ["c"])])], articles, SOURCE_ROWS)
    assert set(g for g, _ in got) == {"a"} and set(got.values()) == {"a"}


def test_ties_go_to_the_smallest_id_and_repeated_rows_are_candidates(spark):
    articles = [row(1, "b"), row(2, "a"), row(3, "c", fetched=T0), row(4, "c", fetched=T0 + timedelta(days=30))]
    assert run(spark, [("a", ["b"])], [("r", None)], articles, SOURCE_ROWS)[("a", "title")] == "a"
    assert run(spark, [("a", ["b", "c"])], [("r", None)], articles, SOURCE_ROWS)[("a", "title")] == "c"


def test_cut_titles_are_not_usable(spark):
    long = "How the planner measured the remote test runner against their hidden linter"
    articles = [
        row(1, "a", "s1", title=long[:40]), row(2, "b", "s2", title=long[:50] + "…"), row(3, "c", "s3", title=long), row(4, "d", "s3", title=long + " – Some Site"),
        row(5, "e", "s1", title="Other words [...]"), row(6, "f", "s3", title=None),
    ]
    got = run(spark, [("a", ["b", "c", "d"]), ("e", ["f"])], [("r", None)], articles, SOURCE_ROWS)
    assert got[("a", "title")] == "c" and ("e", "title") not in got


def peeled(records, graded):
    """{id: layer} by taking the undominated records away, again and again."""
    size = lambda m: bin(m).count("1")
    beats = lambda a, b: a[0] <= b[0] and (-a[1], a[3]) <= (-b[1], b[3]) and (size(a[2]) >= size(b[2]) if graded else a[2] & b[2] == b[2]) and a != b
    layers, left, layer = {}, list(records), 0
    while left:
        layer += 1
        top = [r for r in left if not any(beats(o, r) for o in left)]
        layers |= {r[3]: layer for r in top}
        left = [r for r in left if r not in top]
    return layers


def test_layers_are_those_of_peeling(spark):
    import random

    rng = random.Random(4)
    records = [(rng.randint(1, 4), rng.randint(1, 60), rng.randint(0, 7), f"r{n:02}") for n in range(40)]
    best = {}
    for t, at, m, k in records:
        best[(t, m)] = min(best.get((t, m), (99, 0, 0, "z")), (t, at, m, k), key=lambda r: (-r[1], r[3]))
    rows = [("g", t, T0 + timedelta(days=at), bool(m & 1), bool(m & 2), bool(m & 4), k) for t, at, m, k in records]
    df = spark.createDataFrame(rows, "g string, trust int, at timestamp, x boolean, y boolean, z boolean, id string")
    for graded in (False, True):
        got = {r.order.tie: r.layer for r in R.skyline(df, "g", ["x", "y", "z"], "trust", "at", "id", graded).collect()}
        assert got == peeled(best.values(), graded) and max(got.values()) > 2


def test_nulls_are_filled_from_the_layers_below(spark):
    """Graded: the fullest recent record survives, its missing author comes from the second layer, not from the third."""
    day = lambda n: T0 + timedelta(days=n)
    rows = [("g", 1, day(9), True, False, True, "full"), ("g", 1, day(5), False, True, False, "second"), ("g", 3, day(4), False, True, False, "third"), ("g", 2, day(3), True, True, True, "late")]
    df = spark.createDataFrame(rows[:3], "g string, trust int, at timestamp, title boolean, author boolean, published_at boolean, id string")
    got = {r.field_name: (r.tie, r.layer) for r in R.filled(R.skyline(df, "g", list(R.FIELDS), "trust", "at", "id", True), "g", list(R.FIELDS)).collect()}
    assert got == {"title": ("full", 1), "published_at": ("full", 1), "author": ("second", 2)}
    # A fuller record is undominated, so its author comes before that of the second layer: the layers decide.
    df = spark.createDataFrame(rows, df.schema)
    fields = lambda graded: {r.field_name: r.tie for r in R.filled(R.skyline(df, "g", list(R.FIELDS), "trust", "at", "id", graded), "g", list(R.FIELDS)).collect()}
    assert fields(True)["author"] == "late" and fields(False)["author"] == "second"


def test_nothing_usable_and_empty_tables(spark):
    blank = [row(i, k, title=" ", author=None, published=datetime(2099, 12, 31)) for i, k in enumerate("ab")]
    assert run(spark, [("a", ["b"])], [("r", None)], blank, SOURCE_ROWS) == {}
    assert run(spark, [], [], [], []) == {}


def test_against_brute_force(spark, sf):
    t = {n: spark.read.parquet(f"{sf.replace('0.001', '0.01')}/{n}.parquet") for n in ("article_cluster", "selector_output", "normalized_article", "feed_source")}
    articles = t["normalized_article"]
    groups = {r.article_id: r.group_id for r in R.story_groups(t["article_cluster"], t["selector_output"], articles).collect()}
    have = {r.article_id for r in articles.select("article_id").collect()}
    sets = [[r.representative, *(r.supporting or [])] for r in t["article_cluster"].collect()]
    sets += [[g.representative_id, *(g.duplicate_ids or [])] for r in t["selector_output"].collect() for g in r.duplicate_groups or []]
    from tests.test_components import union_find

    kept = [[x for x in s if x in have] for s in sets]
    roots = union_find([(s[0], x) for s in kept for x in s])
    sizes = {r: list(roots.values()).count(r) for r in roots.values()}
    assert groups == {k: r for k, r in roots.items() if sizes[r] > 1}
    out = R.surviving_records(*t.values()).collect()
    by = {(r.group_id, r.field_name): r.article_id for r in out}
    rank = {r.source_id: r.trust_rank for r in t["feed_source"].collect()}
    rows = [r for r in articles.collect() if r.article_id in groups]
    usable = lambda r: (r.author or "").strip() and r.author.strip().lower() not in R.STAND_INS and any(c.isalnum() for c in r.author)
    for g in set(groups.values()):
        best = min(((rank[r.source_id], -r.fetched_at.timestamp(), r.article_id) for r in rows if groups[r.article_id] == g and usable(r)), default=None)
        assert by.get((g, "author")) == (best and best[2])

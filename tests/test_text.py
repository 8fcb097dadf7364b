"""Text functions, case by case."""

from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.operators.gates import gated, greedy_budget
from millrace.operators.rollups import sum_or_null, upserted


def values(spark, column, cases):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(cases)], "i int, v string").select("i", column(F.col("v")).alias("r")).orderBy("i").collect()
    return [r.r for r in rows]


def test_blank_and_collapsed(spark):
    assert values(spark, X.is_blank, [None, "", " ", "\u200b \u3000", "a", "\u200ba"]) == [True, True, True, True, False, False]
    assert values(spark, X.collapsed, [None, " a\u00a0 b\n", "e\u0301", "\u200b"]) == [None, "a b", "é", ""]
    assert values(spark, X.blocks, ["\n\na  \r\n\r\nb \n\n", None]) == ["a\n\nb", None]


def test_markup(spark):
    assert values(spark, X.stripped_markup, ["<p>a &amp; b</p>", "<br>", None, "x" * 500]) == ["a & b", None, None, "x" * 400]
    link = lambda v: X.markdown_link(v, F.lit("https://e.com/(a)"))
    assert values(spark, link, ["a [b]\n c\\"]) == ["[a \\[b\\] c\\\\](<https://e.com/(a)>)"]


def test_redaction(spark):
    assert values(spark, X.redacted, ["x ghp_" + "a" * 20 + "\ny", "https://u:p@e.com", None]) == ["x <redacted> y", "<redacted>e.com", None]


def test_title_words(spark):
    assert values(spark, X.title_words, ["How the Cache broke: a Cache of 2", "\u6771\u4eac\u306e\u8a71", None, "!"]) == [["cache", "broke", "2"], ["\u6771\u4eac\u306e\u8a71"], None, []]


def test_verbatim(spark):
    rows = spark.createDataFrame([("a  b", "x a\n b c"), ("a.b", "aXb"), ("", "x"), ("q" * 5, "no"), ("a\\Eb", "z a\\Eb")], "q string, p string")
    assert [r[0] for r in rows.select(X.verbatim_span(F.col("q"), F.col("p"))).collect()] == ["a\n b", None, None, None, "a\\Eb"]


def test_paragraphs(spark):
    text = "# One\n\nfirst\nline\n\n```\na\n\nb\n```\n\n## Two\n\nlast"
    got = values(spark, X.paragraphs, [text, None, "", "```\nopen\n\nfence"])
    assert [(p.pos, p.section, p.text) for p in got[0]] == [(1, "One", "# One"), (2, "One", "first\nline"), (3, "One", "```\na\n\nb\n```"), (4, "Two", "## Two"), (5, "Two", "last")]
    assert got[1:3] == [[], []] and [p.text for p in got[3]] == ["```\nopen\n\nfence"]


def test_paragraphs_with_odd_fences_and_headings(spark):
    cases = ["~~~\na\n\nb\n~~~", "# Two\nlines", "x ```\n\ny", "```\nk\n\nl\n```\n\nafter", "``````\n\nz", "#\n\n# \n\n####### seven", "  ## In  \n\n\n\n end ", "```a\n\nb``` c\n\nd"]
    got = [[(p.section, p.text) for p in r] for r in values(spark, X.paragraphs, cases)]
    assert got[0] == [(None, "~~~\na"), (None, "b\n~~~")] and got[1] == [(None, "# Two\nlines")] and got[2] == [(None, "x ```"), (None, "y")]
    assert got[3] == [(None, "```\nk\n\nl\n```"), (None, "after")] and got[4] == [(None, "``````"), (None, "z")]
    assert got[5] == [(None, "#"), (None, "#"), (None, "####### seven")] and got[6] == [("In", "## In"), ("In", "end")] and got[7] == [(None, "```a\n\nb``` c\n\nd")]


def test_title_words_of_full_width_letters(spark):
    assert values(spark, X.title_words, ["ＣＡＣＨＥ１２ of ﾃｽﾄ"]) == [["cache12", "テスト"]]


def test_forbidden_traces(spark):
    got = values(spark, X.forbidden, ["良い——結果✅✓", "必見。これは速さではなく、品質である。", "plain – text", "Game changer", None, "", "x" * 100_000])
    assert [[(f.rule, f.start, f.matched) for f in r] for r in got] == [
        [("fullwidth_dash", 2, "——"), ("decorative_emoji", 6, "✅")], [("hype", 0, "必見"), ("mechanical_contrast", 8, "ではなく、品質である。")], [("fullwidth_dash", 6, "–")], [("hype", 0, "Game changer")], [], [], [],
    ]


def test_gates_and_budget(spark):
    rows = spark.createDataFrame([(1, "a", 5), (2, None, 5), (3, "a", None)], "i int, t string, n int")
    out = gated(rows, [("one", [("no_t", F.col("t").isNull())]), ("two", [("small", F.col("n") < 9), ("none", F.col("n").isNull())])]).orderBy("i").collect()
    assert [(r.gate, r.reason, [tuple(x) for x in r.results]) for r in out] == [
        ("two", "small", [("one", True, None), ("two", False, "small")]), ("one", "no_t", [("one", False, "no_t")]), ("two", "none", [("one", True, None), ("two", False, "none")]),
    ]
    kept = spark.createDataFrame([([30, 50, 40, 10],), ([],)], "a array<int>").select(greedy_budget(F.col("a"), lambda x: x, 100).alias("k")).collect()
    assert [r.k for r in kept] == [[30, 50, 10], []]


def test_rollups(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None), ("b", 2), ("b", 3)], "k string, v int")
    assert {r.k: r.s for r in rows.groupBy("k").agg(sum_or_null(F.col("v")).alias("s")).collect()} == {"a": None, "b": 5}
    assert rows.where("false").agg(sum_or_null(F.col("v")).alias("s")).first().s is None
    state = spark.createDataFrame([("u", 1, "x"), ("v", 2, "x")], "k string, seen int, d string")
    new = spark.createDataFrame([("u", 9, "y"), ("w", 8, "z")], "k string, seen int, d string")
    assert {tuple(r) for r in upserted(state, new, ["k"], "seen", "d").collect()} == {("u", 1, "y"), ("v", 2, "x"), ("w", 8, "z")}

"""Problem 5: alignment against brute force, and pages made of known parts."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import boilerplate as B

SCHEMA = "article_no long, canonical_url string, body_text string"


def longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=12), st.lists(st.integers(0, 5), max_size=12))
def test_alignment_is_a_longest_common_subsequence(a, b):
    pairs = B.common_lines(a, b)
    assert len(pairs) == longest(a, b) and all(a[i] == b[j] for i, j in pairs)
    assert all(p < q and r < s for (p, r), (q, s) in zip(pairs, pairs[1:]))


def test_masks():
    assert B.masked("  Join 12 readers ") == B.masked("Join 9 readers")
    assert B.masked("Home › News › One title") == B.masked("Home › News › Other")
    assert B.masked("A title here · 12 min") == B.masked("Some other title · 3 min") == B.MINUTES
    assert B.masked("#a #bc") == B.TAGS and B.masked("# Heading") != B.TAGS
    assert B.headline("- How it was made") and not B.headline("It was made.") and not B.headline("x = f()") and not B.headline("")


def pages(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3))
    rows, chrome = [], set()
    for site in ("one.example", "two.test", "three.example", "four.test", "five.example", "six.test", "seven.example", "eight.test", "nine.test"):
        name = site.split(".")[0].title()
        for k in range(25):
            body = [f"{word().title()} {word()} the {word()} of {word()}." for _ in range(6)]
            body[rng.randrange(1, 5)] = rng.choice(["Results", "Method", "Costs"])
            lines = [(f"{name} › News › {word()} {word()}", True), ("", None), *[(line, False) for line in body], (f"Join {rng.randrange(99)} readers of {name}.", True), (f"More from {name}", True),
                     (f"How {word()} saw the {word()}", True), (f"- {word()} or {word()} {word()}", True), (f"© {rng.randrange(2020, 2027)} {name}", True)]
            no = len(rows)
            chrome |= {(no, i) for i, (_, c) in enumerate(lines, 1) if c}
            rows.append((no, f"https://{site}/{rng.choice(['a', 'b'])}/{word()}-{no}", "\n".join(line for line, _ in lines)))
    return rows, chrome


def run(spark, rows, schema=SCHEMA):
    out = [tuple(r) for r in B.chrome_lines(spark.createDataFrame(rows, schema)).collect()]
    assert len(out) == len(set(out))
    return set(out)


def test_sites(spark):
    rows, chrome = pages()
    rows.append((9999, "https://elsewhere.example/copy", rows[3][2]))  # a copy carries the first site's chrome
    expected = chrome | {(9999, i) for no, i in chrome if no == 3}
    odd = [(10001, None, None), (10002, "", ""), (10003, "no url", " \n \n"), (10004, "https://one.example/z", "word " * 40_000), (10004, "https://one.example/z", "word " * 40_000)]
    got = run(spark, rows + odd)
    assert len(got & expected) > 0.97 * len(expected) and len(got - expected) < 0.01 * len(expected)


def test_hosts_of_few_pages_and_spellings_move_no_limit(spark):
    rows, chrome = pages()
    before = run(spark, rows)
    spelt = [(no, url.replace(site := url.split("/")[2], site.upper() + (":443", ".", ".:443")[no % 3]) if no % 5 == 0 else url, body) for no, url, body in rows]
    tiny = [(20_000 + k, f"https://tiny{k}.example/a", f"Results\nNothing like word{k} was seen.\nMethod\n{k}") for k in range(300)]
    assert B.host_and_path("HTTPS://One.Example.:443/A?utm_source=x") == ("one.example", "/a") and B.host_and_path("no url") == B.host_and_path(None) == ("", "")
    assert run(spark, spelt) == before
    assert run(spark, rows + tiny) == before


def test_empty_and_clashing_columns(spark):
    assert run(spark, []) == set()
    assert run(spark, [(1, "https://a.example/x", "One line.", "clash", 1, "k")], SCHEMA + ", page string, line_no int, keys string") == set()

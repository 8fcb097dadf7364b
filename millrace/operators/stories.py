"""Stories: titles that name one topic, their clusters and representatives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import title_words
from millrace.operators.components import connected_components
from millrace.tables import by_sorting, stored

SHARED_WORDS = 3
#: Similarity 0.6 as a ratio of whole numbers, compared without rounding.
NUMERATOR, DENOMINATOR = 3, 5
#: (words that are sought at once, SHARED_WORDS at most; least and greatest size of the greater set). A set has some hundred
#: groups of words at most.
TOGETHER = [(3, 0, 33), (2, 34, 100), (1, 101, 1 << 30)]


def title_classes(articles: DataFrame, key: str, title: str = "title") -> DataFrame:
    """(key, title_class, words): articles with the same set of title words are one class; no words, no class."""
    words = F.array_sort(title_words(F.col(title)))
    return articles.select(F.col(key).alias("key"), words.alias("words")).where(F.size("words") > 0).withColumn("title_class", F.md5(F.to_json("words")))


def _groups_of(words: Column, n: int) -> Column:
    """(key, last) of every `n` (1 to 3) of the words: their hash and the place of the last one, from 1."""
    word = lambda at: F.get(words, at - 1)
    places = lambda first, left: F.sequence(first, F.size(words) - left)
    made = lambda last, *at: F.struct(F.xxhash64(*[word(k) for k in at]).alias("key"), last.alias("last"))
    if n == 1:
        groups = F.transform(places(F.lit(1), 0), lambda i: made(i, i))
    elif n == 2:
        groups = F.flatten(F.transform(places(F.lit(1), 1), lambda i: F.transform(places(i + 1, 0), lambda j: made(j, i, j))))
    else:
        groups = F.flatten(F.transform(places(F.lit(1), 2), lambda i: F.flatten(F.transform(places(i + 1, 1), lambda j: F.transform(places(j + 1, 0), lambda k: made(k, i, j, k))))))
    return F.when(F.size(words) >= n, groups)


def similar_classes(classes: DataFrame) -> DataFrame:
    """(left_class, right_class, shared) of different classes with at least SHARED_WORDS and 3/5 of their words in common."""
    sets = stored(classes.select("title_class", "words").dropDuplicates(["title_class"]).withColumn("no", F.monotonically_increasing_id()))
    return similar_sets(sets, "title_class").select(F.least("l_title_class", "r_title_class").alias("left_class"), F.greatest("l_title_class", "r_title_class").alias("right_class"), "shared")


def _ranked(sets: DataFrame) -> DataFrame:
    """(no, size, bits, words): the words of a set that another one has too, the rarest first, and a bit for each of these;
    `size` counts all of its words. A word of one set alone is in no pair, and groups with it would be shuffled in vain."""
    each = sets.select("no", F.size("words").alias("size"), F.explode("words").alias("word")).where(F.col("size") >= SHARED_WORDS)
    counts = each.groupBy("word").agg(F.count("*").alias("n")).where("n > 1")
    bits = F.expr("bit_or(shiftleft(1L, cast(pmod(xxhash64(word), 64) as int)))")
    ranked = each.join(by_sorting(counts), "word").groupBy("no", "size").agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("w"), bits.alias("bits"))
    return ranked.select("no", "size", "bits", F.col("w.word").alias("words")).where(F.size("words") >= SHARED_WORDS)


def similar_sets(sets: DataFrame, *names: str) -> DataFrame:
    """(l_no, r_no, shared) and the columns `names` of both, with l_ and r_ before them, of all pairs of sets with at least
    SHARED_WORDS and 3/5 of their words in common. sets(no, words, ...): a stored table of different sets, `no` is unique.

    Two sets with s words in common have the first few of these among the n - s + few rarest of the n words that each shares
    with any set. So titles are joined by several of these at once, which are seldom the same by chance (see TOGETHER); what
    may be left to share after these, and a bit for each word, drop most of the rest in the join. Every other pair is
    counted exactly.
    """
    ranked = stored(_ranked(sets))
    # NUMERATOR / (NUMERATOR + DENOMINATOR) of both sizes, at least, so of twice the size of the smaller set.
    part, whole = NUMERATOR, NUMERATOR + DENOMINATOR
    least = lambda total: F.greatest(F.lit(SHARED_WORDS), F.ceil(total * part / whole)).cast("int")
    pairs = []
    for few, low, high in TOGETHER:
        near = ranked.where((F.col("size") <= high) & (F.col("size") * DENOMINATOR >= low * NUMERATOR))
        keyed = lambda df, total: df.select("no", "size", F.size("words").alias("n"), "bits", F.explode(_groups_of(F.slice("words", F.lit(1), F.greatest(F.lit(0), F.size("words") - least(total) + few)), few)).alias("g")).select("no", "size", "n", "bits", "g.*")
        smaller = keyed(near, F.col("size") * 2).alias("a")
        greater = keyed(near.where(F.col("size") >= low), F.col("size") + F.ceil(F.col("size") * NUMERATOR / DENOMINATOR)).alias("b")
        need = least(F.col("a.size") + F.col("b.size"))
        fits = (F.col("a.size") < F.col("b.size")) | ((F.col("a.size") == F.col("b.size")) & (F.col("a.no") < F.col("b.no")))
        left = few + F.least(F.col("a.n") - F.col("a.last"), F.col("b.n") - F.col("b.last"))
        alone = lambda x, y: F.col(f"{x}.n") - F.bit_count(F.col(f"{x}.bits").bitwiseAND(F.bitwise_not(F.col(f"{y}.bits"))))
        fits &= (left >= need) & (alone("a", "b") >= need) & (alone("b", "a") >= need)
        pairs.append(smaller.join(by_sorting(greater), (F.col("a.key") == F.col("b.key")) & fits).select(F.col("a.no").alias("l_no"), F.col("b.no").alias("r_no")))
    side = lambda s: sets.select(F.col("no").alias(f"{s}_no"), F.col("words").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in names])
    both = stored(reduce(DataFrame.union, pairs).distinct()).join(by_sorting(side("l")), "l_no").join(by_sorting(side("r")), "r_no")
    shared = F.size(F.array_intersect("l", "r"))
    alike = (shared >= SHARED_WORDS) & (shared * DENOMINATOR >= (F.size("l") + F.size("r") - shared) * NUMERATOR)
    return both.where(alike).select("l_no", "r_no", *[f"{s}_{c}" for s in ("l", "r") for c in names], shared.alias("shared"))


def link_edges(articles: DataFrame, links: DataFrame, key: str, url: str = "canonical_url", source: str = "source_id") -> DataFrame:
    """(a, b): an article and the one its page links to, if that is another source's. links(key, url): canonical targets;
    of several articles with one address the last is meant. Null addresses and sources link nothing."""
    targets = articles.where(F.col(url).isNotNull()).groupBy(F.col(url).alias("target")).agg(F.max_by(F.struct(F.col(key).alias("b"), F.col(source).alias("of")), key).alias("t"))
    own = articles.select(F.col(key).alias("a"), F.col(source).alias("own")).distinct()
    meant = links.select(F.col(key).alias("a"), F.col("url").alias("target")).distinct().join(by_sorting(targets), "target").join(by_sorting(own), "a")
    return meant.where("own <> t.of").select("a", F.col("t.b").alias("b")).distinct()


def story_clusters(articles: DataFrame, key: str = "article_id", title: str = "title", links: DataFrame | None = None) -> DataFrame:
    """(key, story): articles linked through similar titles, or through their pages' `links` (see `link_edges`); `story` is
    the smallest key. Articles of one title class are a story if they have SHARED_WORDS words; an article without a title
    is a story of its own, unless it is linked."""
    named = articles.where(F.col(key).isNotNull())
    classes = stored(title_classes(named, key, title))
    # A class takes part in the joins and the components under its smallest key, however many articles it has.
    heads = stored(classes.groupBy("title_class").agg(F.min("key").alias("no"), F.first("words").alias("words")))
    of_head = stored(classes.select("key", "title_class").join(by_sorting(heads.where(F.size("words") >= SHARED_WORDS).select("title_class", F.col("no").alias("head"))), "title_class").select("key", "head"))
    # A key has one title, but may have several in rows that repeat it: it joins their classes.
    own = stored(of_head.groupBy("key").agg(F.min("head").alias("head"), F.max("head").alias("last")))
    edges = similar_sets(heads).select(F.col("l_no").alias("a"), F.col("r_no").alias("b"))
    edges = edges.union(of_head.join(by_sorting(own.where("head <> last").select("key")), "key").select("head", "key"))
    if links is not None:
        linked = link_edges(articles, links, key)
        for end in ("a", "b"):
            of_end = own.select(F.col("key").alias(end), F.col("head").alias("head"))
            linked = linked.join(by_sorting(of_end), end, "left").withColumn(end, F.coalesce("head", end)).drop("head")
        edges = edges.union(linked.select("a", "b"))
    roots = connected_components(edges)
    keys = named.select(F.col(key).alias("key")).distinct().join(by_sorting(own.select("key", "head")), "key", "left").select("key", F.coalesce("head", "key").alias("id"))
    return keys.join(by_sorting(roots), "id", "left").select(F.col("key").alias(key), F.coalesce("root", "id").alias("story"))


def representatives(members: DataFrame, story: str, *order: Column | str) -> DataFrame:
    """Each story's first member in `order` with the number of members; a min, so a story may be of any size."""
    at = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"o{n}") for n, c in enumerate(order)])
    rest = [c for c in members.columns if c != story]
    return members.groupBy(story).agg(F.min_by(F.struct(*rest), at).alias("row"), F.count("*").alias("members")).select(story, "members", "row.*")

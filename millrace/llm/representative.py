"""Problem 2: one surviving record for each group of duplicates.

Groups are the connected components of ids named together. Within a group a record's quality has three dimensions:
trust (rank of its source), recency (fetched_at, then the smaller id) and completeness: which of the fields it can supply
(a set, so a record with only a title doesn't dominate one with only an author) or, graded, how many. The skyline are the
records that no other one beats or equals in all three; without it, the next layer's records are undominated, and so on.
The surviving record takes each field from the first record of the lexicographic policy (layer, trust, recency) that has
it: nulls of a layer are filled from the layers below.

With graded completeness a fuller record of a less trusted source comes before a poorer one. Where each field must come
from the most trusted record that has it, as in p2_found, completeness is the set: such a record is never dominated.

Before anything meets within a group, each (group, completeness, trust) keeps its most recent record only: all others
are dominated by it. What is left of a group is bounded by the numbers of fields and trust ranks, not by its size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.truncation import truncated_values
from millrace.operators.components import connected_components
from millrace.tables import stored

FIELDS = ("title", "author", "published_at")

# What stands for nothing in titles and names, in lower case.
STAND_INS = [
    "untitled", "untitled post", "(untitled)", "[untitled]", "no title", "(no title)", "[no title]", "title", "[title]", "(title)", "無題", "タイトルなし", "ohne titel", "sans titre",
    "sin título", "n/a", "na", "n.a.", "null", "none", "nil", "nan", "undefined", "unknown", "unknown author", "author unknown", "anonymous", "anon", "admin", "administrator", "staff",
    "editor", "editors", "by", "author", "[author]", "guest", "user", "編集部不明", "不明", "匿名", "作者不明", "tbd", "test", "default", "post",
]
#: Parameters of `surviving_records`: no article of the project can be older; later than its fetching it can be by a
#: clock's difference at most.
EARLIEST = "2000-01-01"
CLOCK = "interval 1 day"

_BLANKS = r"^[\s\p{Z}\x{200B}-\x{200D}\x{2060}\x{FEFF}\x{AD}]+|[\s\p{Z}\x{200B}-\x{200D}\x{2060}\x{FEFF}\x{AD}]+$"


def named(value: Column) -> Column:
    """Whether `value` says something: it has a letter or digit and isn't a stand-in for nothing."""
    text = F.lower(F.regexp_replace(value.cast("string"), _BLANKS, ""))
    return F.coalesce(text.rlike(r"[\p{L}\p{Nd}]") & ~text.isin(STAND_INS), F.lit(False))


def possible_time(value: Column, fetched: Column, earliest: str = EARLIEST) -> Column:
    upper = F.coalesce(fetched, F.lit("9999-01-01").cast("timestamp")) + F.expr(CLOCK)
    return F.coalesce((value >= F.lit(earliest).cast("timestamp")) & (value <= upper), F.lit(False))


def story_groups(clusters: DataFrame, selections: DataFrame, articles: DataFrame) -> DataFrame:
    """(article_id, group_id) of ids that clusters and duplicate groups hold together; see `surviving_records`."""
    clustered = clusters.select(F.array_union(F.array("representative"), F.coalesce("supporting", F.array().cast("array<string>"))).alias("ids"))
    groups = selections.select(F.explode("duplicate_groups").alias("g"))
    grouped = groups.select(F.array_union(F.array("g.representative_id"), F.coalesce("g.duplicate_ids", F.array().cast("array<string>"))).alias("ids"))
    sets = clustered.union(grouped).withColumn("set_id", F.md5(F.to_json("ids"))).dropDuplicates(["set_id"])
    members = stored(sets.select("set_id", F.explode(F.array_distinct("ids")).alias("id")).join(articles.select(F.col("article_id").alias("id")).distinct(), "id", "left_semi"))
    heads = members.groupBy("set_id").agg(F.min("id").alias("head"))
    roots = stored(connected_components(stored(members.join(heads, "set_id").select("head", "id")), "head", "id"))
    several = roots.groupBy("root").agg(F.count("*").alias("n")).where("n >= 2")
    return roots.join(several, "root", "left_semi").select(F.col("id").alias("article_id"), F.col("root").alias("group_id"))


def cut_titles(articles: DataFrame, members: DataFrame) -> DataFrame:
    """(article_no) of members whose title is cut: by the evidence of `truncated_values` over all `articles`, or because
    another title of its group goes on where it ends (with more than a site's name behind a dash)."""
    by_evidence = truncated_values(articles.select(F.col("article_no").alias("item_no"), "source_id", "title", F.lit(None).cast("string").alias("feed_summary")))
    by_evidence = by_evidence.select(F.col("item_no").alias("article_no"))
    sign = r"\s*(?:\[(?:…|\.{2,})\]|…+|\.{2,})\s*$"
    words = F.split(F.lower(F.regexp_replace(F.regexp_replace("title", sign, ""), _BLANKS, "")), r"\s+")
    titles = members.where(F.col("title").isNotNull()).select("article_no", "group_id", words.alias("w"))
    distinct = titles.select("group_id", "w").distinct()
    at = distinct.select("group_id", "w", F.posexplode("w").alias("k", "word"))
    onward = at.select(
        "group_id", F.when(F.col("k") > 0, F.xxhash64(F.slice("w", F.lit(1), F.greatest("k", F.lit(1))))).otherwise(F.lit(0)).alias("head"), F.col("word").alias("next"),
        F.coalesce(F.try_element_at("w", F.col("k") + 2).rlike(r"^[\p{L}\p{Nd}]"), F.lit(False)).alias("more"),
    ).distinct()
    n = F.size("w")
    ends = titles.select("article_no", "group_id", F.when(n > 1, F.xxhash64(F.slice("w", F.lit(1), F.greatest(n - 1, F.lit(1))))).otherwise(F.lit(0)).alias("head"), F.element_at("w", -1).alias("last"))
    longer = (F.col("next") != F.col("last")) & F.col("next").startswith(F.col("last")) & F.col("last").rlike(r"[\p{L}\p{Nd}]$") & ~F.expr("substring(next, length(last) + 1)").rlike(r"^[^\p{L}\p{Nd}]")
    by_group = ends.join(onward, ["group_id", "head"]).where(longer | ((F.col("next") == F.col("last")) & F.col("more"))).select("article_no")
    return by_evidence.union(by_group).distinct()


def skyline(records: DataFrame, group: str, usable: list[str], trust: str, recent: str, tie: str, graded: bool = False) -> DataFrame:
    """(group, rank, order, layer, *usable) of each group's candidates; `layer` 1 are the undominated ones, each further
    layer those that are undominated without the layers before.

    `usable` are boolean columns (completeness: their set, or with `graded` their number), lower `trust` and higher
    `recent` are better, null last; ties in both go to the smaller `tie`. Candidates are the most recent record of each
    (group, completeness, trust); of these a group has at most 2^fields for each trust rank.
    """
    mask = reduce(lambda a, b: a + b, [F.col(u).cast("int") * (1 << k) for k, u in enumerate(usable)])
    rank = F.coalesce(F.col(trust).cast("double"), F.lit(float("inf")))
    # Greatest recency, then smallest tie: negated micros make both an ascending order for min.
    order = F.struct(F.coalesce(-F.unix_micros(recent), F.lit(2**62)).alias("age"), F.col(tie).alias("tie"))
    best = records.withColumn("mask", mask).withColumn("rank", rank).groupBy(group, "mask", "rank").agg(F.min(order).alias("order"))
    # Dominators of a record stand before it in the policy's order; of equal records the fuller one is first.
    ordered = best.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("rank", "order", (-F.col("mask")).alias("less"), F.lit(0).alias("layer")))).alias("c"))
    fuller = (lambda d, c: F.bit_count(-d["less"]) >= F.bit_count(-c["less"])) if graded else (lambda d, c: (-d["less"]).bitwiseAND(-c["less"]) == -c["less"])

    def layered(done, c):
        above = F.transform(F.filter(done, lambda d: (d["order"] <= c["order"]) & fuller(d, c)), lambda d: d["layer"])
        layer = F.coalesce(F.array_max(above), F.lit(0)) + 1
        return F.array_append(done, F.struct(c["rank"].alias("rank"), c["order"].alias("order"), c["less"].alias("less"), layer.alias("layer")))

    each = ordered.select(group, F.explode(F.aggregate("c", F.filter("c", lambda _: F.lit(False)), layered)).alias("r")).select(group, "r.*")
    flags = [((-F.col("less")).bitwiseAND(F.lit(1 << k)) != 0).alias(u) for k, u in enumerate(usable)]
    return each.select(group, "rank", "order", "layer", *flags)


def filled(layers: DataFrame, group: str, fields: list[str]) -> DataFrame:
    """(group, field_name, tie, layer): who supplies each field of a group's surviving record, from which layer."""
    policy = F.struct("layer", "rank", "order")
    offered = layers.select(group, policy.alias("policy"), F.explode(F.array(*[F.when(F.col(f), F.lit(f)) for f in fields])).alias("field_name")).where("field_name is not null")
    return offered.groupBy(group, "field_name").agg(F.min("policy").alias("p")).select(group, "field_name", "p.order.tie", "p.layer")


def surviving_records(clusters: DataFrame, selections: DataFrame, articles: DataFrame, sources: DataFrame, graded: bool = False, earliest: str = EARLIEST) -> DataFrame:
    """(group_id, field_name, article_id): the article that supplies each field of each group's surviving record.

    clusters(representative, supporting), selections(duplicate_groups), articles(article_no, article_id, source_id, title,
    author, published_at, fetched_at), sources(source_id, trust_rank); other columns are ignored. Ids without a row in
    `articles` are ignored, null ids, arrays and groups too; groups of one id are none; an id's repeated rows are
    candidates each. Among members with a usable value: smallest trust_rank (none: last), then latest fetched_at (null:
    last), then smallest id (with `graded`: in the first dominance layer that has one). A field without a usable value gives no row; empty tables give no rows.
    """
    groups = story_groups(clusters, selections, articles)
    trust = sources.groupBy("source_id").agg(F.min("trust_rank").alias("trust_rank"))
    rows = articles.select("article_no", "article_id", "source_id", "title", "author", "published_at", "fetched_at")
    members = stored(rows.join(groups, "article_id"))
    cut = stored(cut_titles(rows, members)).withColumn("cut", F.lit(True))
    judged = members.join(cut, "article_no", "left").join(trust, "source_id", "left").select(
        "group_id", "article_id", "trust_rank", "fetched_at",
        (named(F.col("title")) & F.col("cut").isNull()).alias("title"), named(F.col("author")).alias("author"),
        possible_time(F.col("published_at"), F.col("fetched_at"), earliest).alias("published_at"),
    )
    layers = skyline(judged, "group_id", list(FIELDS), "trust_rank", "fetched_at", "article_id", graded)
    return filled(layers, "group_id", list(FIELDS)).select("group_id", "field_name", F.col("tie").alias("article_id"))

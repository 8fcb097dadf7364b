"""Collected items and their pages through all gates, up to the articles of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.functions.urls import canonical, site_of
from millrace.operators.gates import gated
from millrace.operators.greedy import resolve
from millrace.operators.instants import with_instant
from millrace.tables import stored

#: Characters of a usable body or summary.
USABLE = 200


def chosen_url(requested: Column, final: Column, declared: Column) -> Column:
    """A page's address, all three canonical or null: the one it was redirected to, else the requested one; what the page
    declares counts only on the same site as either."""
    base = F.coalesce(final, requested)
    near = F.coalesce((site_of(declared) == site_of(base)) | (site_of(declared) == site_of(requested)), F.lit(False))
    return F.when(near, declared).otherwise(base)


def chosen_body(page: Column, summary: Column, usable: int = USABLE) -> Column:
    """The struct (text, source): the page's text if it is long enough, else the feed's, else nulls."""
    extracted, fed = F.length(page) >= usable, F.length(summary) >= usable
    return F.struct(F.when(extracted, page).when(fed, summary).alias("text"), F.when(extracted, "extracted").when(fed, "feed_fallback").alias("source"))


def outcomes(items: DataFrame, pages: DataFrame, state: DataFrame) -> DataFrame:
    """(id, gate, reason, results, canonical_url, body_source, content_hash) of every item, null gate and reason if it passed.

    items(id, page_key, url, title, published, summary), pages(page_key, body_text, final_url, declared_url), one row a key;
    state(canonical_url, content_hash) of earlier runs. Gates in order: required fields (address, title, date), content (a
    page that could not be read, or has too little text, is made up for by the summary), not processed before (by either
    address, then by content), and no repeat of an item with a lower id that passed all gates. The first failing one gives
    the reason; a repeated item that failed blocks nothing. Null pages and summaries are absent ones; empty tables give
    no rows. Ids are unique; the last gate is settled in rounds over addresses and hashes of what passed the others.
    """
    asked = items.select("id", "page_key", "title", "published", X.stripped_markup(F.col("summary"), 1 << 30).alias("summary"), canonical("url").alias("asked"))
    asked = with_instant(asked, F.col("published"), "epoch_us")
    read = pages.select("page_key", "body_text", canonical("final_url").alias("final"), canonical("declared_url").alias("declared"), F.lit(True).alias("fetched"))
    met = asked.join(read, "page_key", "left").select(
        "id", "title", "published", "epoch_us", "asked", "fetched", chosen_body(F.col("body_text"), F.col("summary")).alias("body"),
        chosen_url(F.col("asked.url"), F.col("final.url"), F.col("declared.url")).alias("canonical_url"),
    ).withColumn("content_hash", X.content_hash(F.col("body.text")))
    rows = met.select(
        "id", X.is_blank(F.col("title")).alias("untitled"), X.is_blank(F.col("published")).alias("undated"), "epoch_us", "asked.problem", F.col("asked.url").alias("requested"), "canonical_url",
        F.coalesce("fetched", F.lit(False)).alias("fetched"), F.col("body.source").alias("body_source"), "content_hash",
    )
    urls = state.where("canonical_url is not null").select("canonical_url").distinct()
    hashes = state.where("content_hash is not null").select("content_hash").distinct().withColumn("hash_known", F.lit(True))
    rows = rows.join(urls.withColumn("url_known", F.lit(True)), "canonical_url", "left")
    rows = rows.join(urls.select(F.col("canonical_url").alias("requested"), F.lit(True).alias("asked_known")), "requested", "left").join(hashes, "content_hash", "left")
    chain = [
        ("required_fields", [
            ("missing_url", F.col("problem") == "missing"), ("invalid_url", F.col("problem") == "invalid"), ("missing_title", F.col("untitled")),
            ("missing_published_at", F.col("undated")), ("invalid_published_at", F.col("epoch_us").isNull()),
        ]),
        ("content_available", [("body_extraction_failed", F.col("body_source").isNull() & F.col("fetched")), ("body_fetch_failed", F.col("body_source").isNull())]),
        ("not_previously_processed", [("already_processed_url", F.coalesce("url_known", "asked_known")), ("already_processed_content_hash", F.col("hash_known"))]),
    ]
    staged = stored(gated(rows, chain).drop("results"))
    passed = staged.where("reason is null")
    keys = F.array(F.xxhash64(F.lit("url"), "canonical_url"), F.xxhash64(F.lit("url"), "requested"), F.xxhash64(F.lit("hash"), "content_hash"))
    repeats = resolve(passed.select(F.col("id").alias("ord"), F.explode(F.array_distinct(keys)).alias("key"))).where("first is not null").select(F.col("ord").alias("id"), F.lit(True).alias("repeat"))
    early = [(name, [(label, F.col("before") == label) for label, _ in checks]) for name, checks in chain]
    late = ("not_known_duplicate", [("duplicate_of_known_article", F.col("repeat"))])
    out = gated(staged.drop("gate").withColumnRenamed("reason", "before").join(repeats, "id", "left"), [*early, late])
    return out.select("id", "gate", "reason", "results", "canonical_url", "body_source", "content_hash")


def record_violations(rows: DataFrame, order: list[str]) -> DataFrame:
    """(id, violation) of gate records (id, results): gates out of `order`, a gate after a failed one, a failed gate without a
    reason or a passed one with it, no gates at all."""
    names = F.transform("results", lambda r: r["gate"])
    prefix = F.slice(F.array(*map(F.lit, order)), F.lit(1), F.greatest(F.size("results"), F.lit(0)))
    found = F.array_compact(F.array(
        F.when(F.coalesce(F.size("results"), F.lit(0)) <= 0, "no_gates"), F.when(~names.eqNullSafe(prefix) & (F.size("results") > 0), "order"),
        F.when(F.exists(F.slice("results", F.lit(1), F.greatest(F.size("results") - 1, F.lit(0))), lambda r: ~r["passed"]), "after_failure"),
        F.when(F.exists("results", lambda r: r["passed"] == r["reason"].isNotNull()), "reason"),
    ))
    return rows.select("id", F.explode(found).alias("violation"))

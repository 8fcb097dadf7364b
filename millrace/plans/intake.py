"""The gate chain over collected items, and the coherence of what was collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.operators.intake import outcomes
from millrace.operators.ranking import keep_first
from millrace.operators.rollups import counts_in_order
from millrace.plans.fragments import BLANK, INVISIBLE, SUMMARY, canonical_ctes
from millrace.sources.state import state_lines
from millrace.tables import table

DECISIONS = ["included", "deferred", "excluded"]


def item_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Every collected item through all gates; its page is the first article of its id, what earlier runs have put out is not taken again."""
    items = table(spark, d, "collected_item").select(F.col("item_no").alias("id"), F.col("article_id").alias("page_key"), "url", "title", F.col("published_at").alias("published"), F.col("feed_summary").alias("summary"))
    pages = keep_first(table(spark, d, "normalized_article").select(F.col("article_id").alias("page_key"), "article_no", "body_text", F.col("canonical_url").alias("declared_url")), ["page_key"], "article_no")
    state = table(spark, d, "processed").where("last_decision = 'included'").select("canonical_url", "content_hash")
    out = outcomes(items, pages.withColumn("final_url", F.lit(None).cast("string")), state)
    return out.select(F.col("id").alias("item_no"), "gate", "reason", F.size("results").alias("gates_run"), "body_source", "content_hash")


def source_violations(spark: SparkSession, d: str) -> DataFrame:
    """Kinds under which a source's items came that aren't its own, and sources without items."""
    seen = table(spark, d, "collected_item").groupBy("source_id", "source_kind").agg(F.count("*").alias("items"))
    sources = table(spark, d, "feed_source").select("source_id", F.col("source_kind").alias("own_kind"))
    both = seen.join(sources, "source_id", "full_outer")
    problem = F.when(F.col("own_kind").isNull(), "unknown_source").when(F.col("items").isNull(), "no_items").when(F.col("own_kind") != F.col("source_kind"), "other_kind")
    return both.select("source_id", "source_kind", F.coalesce("items", F.lit(0)).alias("items"), problem.alias("problem")).where("problem is not null")


def unmatched_ids(spark: SparkSession, d: str) -> DataFrame:
    """Articles no item has delivered, and how many items of each id have no article."""
    items = table(spark, d, "collected_item").groupBy("article_id").agg(F.count("*").alias("rows"))
    articles = table(spark, d, "normalized_article").groupBy("article_id").agg(F.count("*").alias("rows"))
    only = lambda a, b, side: a.join(b, "article_id", "left_anti").select(F.lit(side).alias("side"), "article_id", "rows")
    return only(articles, items, "article").union(only(items, articles, "item"))


def decisions_in_order(spark: SparkSession, d: str) -> DataFrame:
    return counts_in_order(table(spark, d, "processed"), "last_decision", DECISIONS)


def plain_fields(spark: SparkSession, d: str) -> DataFrame:
    """Raw fields without outer blanks, empty ones as nulls."""
    return table(spark, d, "collected_item").select("item_no", X.plain_field(F.col("title")).alias("title"), X.plain_field(F.col("published_at")).alias("published_at"), X.plain_field(F.col("url")).alias("url"))


def state_records(spark: SparkSession, d: str) -> DataFrame:
    """The lines of the state's files: the first delivery of each address and content."""
    rows = table(spark, d, "processed").where("content_hash is not null").select("record_no", "canonical_url", "content_hash", F.unix_micros("first_seen_at").cast("string").alias("first_seen_at"), "last_decision")
    return state_lines(keep_first(rows, ["canonical_url", "content_hash"], "record_no"))


QUERIES = {f.__name__: f for f in (item_outcomes, source_violations, unmatched_ids, decisions_in_order, plain_fields, state_records)}

_TIMES = ["%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d", "%a, %d %b %Y %H:%M:%S GMT", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%S.%fZ", "%Y-%m-%dT%H:%M:%S%z", "%B %d, %Y", "%d %b %Y"]
_PLAIN = lambda c: f"regexp_replace({c}, '^{BLANK}+|{BLANK}+$', '', 'g')"
ORACLES = {
    "item_outcomes": rf"""with recursive
        page as (select article_id, canonical_url, body_text from normalized_article qualify row_number() over (partition by article_id order by article_no) = 1),
        {canonical_ctes("select item_no as k, url as u from collected_item", "asked")}, {canonical_ctes("select article_id as k, canonical_url as u from page", "told")},
        i as (select item_no, title, published_at, trim(regexp_replace({SUMMARY}, '{BLANK}+', ' ', 'g')) as summary, a.url as requested, a.problem, p.body_text, p.article_id is not null as fetched,
            case when regexp_extract(t.url, '^[a-z]+://[^/?#]*') = regexp_extract(a.url, '^[a-z]+://[^/?#]*') then t.url else a.url end as canonical
            from collected_item c join asked a on a.k = c.item_no left join page p using (article_id) left join told t on t.k = p.article_id),
        b as (select *, case when length(body_text) >= 200 then 'extracted' when length(summary) >= 200 then 'feed_fallback' end as body_source, sha256(case body_source when 'extracted' then body_text when 'feed_fallback' then summary end) as content_hash from i),
        known as (select * from processed where last_decision = 'included'),
        s as (select *, case when problem = 'missing' then 'missing_url' when problem = 'invalid' then 'invalid_url' when regexp_replace(coalesce(title, ''), '{BLANK}|{INVISIBLE}', '', 'g') = '' then 'missing_title'
            when regexp_replace(coalesce(published_at, ''), '{BLANK}|{INVISIBLE}', '', 'g') = '' then 'missing_published_at' when try_strptime(trim(published_at), {_TIMES}) is null then 'invalid_published_at'
            when body_source is null and fetched then 'body_extraction_failed' when body_source is null then 'body_fetch_failed'
            when canonical in (select canonical_url from known) or requested in (select canonical_url from known) then 'already_processed_url'
            when content_hash in (select content_hash from known where content_hash is not null) then 'already_processed_content_hash' end as before from b),
        o as (select item_no, canonical, requested, content_hash, row_number() over (order by item_no) as n from s where before is null),
        r(n, item_no, dup, have) as (select 0::bigint, null::bigint, null::boolean, []::varchar[] union all
            select n, item_no, d, case when d then have else list_concat(have, [canonical, requested, content_hash]) end from (select o.*, r.have, list_has_any(r.have, [canonical, requested, content_hash]) as d from r join o on o.n = r.n + 1)),
        f as (select s.*, coalesce(before, case when r.dup then 'duplicate_of_known_article' end) as reason from s left join r using (item_no))
        select item_no, case when reason is null then null when reason like 'missing%' or reason like 'invalid%' then 'required_fields' when reason like 'body%' then 'content_available' when reason like 'already%' then 'not_previously_processed' else 'not_known_duplicate' end as gate,
            reason, cast(case when gate = 'required_fields' then 1 when gate = 'content_available' then 2 when gate = 'not_previously_processed' then 3 else 4 end as int) as gates_run, body_source, content_hash from f""",
    "source_violations": """select source_id, i.source_kind, coalesce(i.items, 0) as items, case when f.source_kind is null then 'unknown_source' when i.items is null then 'no_items' else 'other_kind' end as problem
        from (select source_id, source_kind, count(*) as items from collected_item group by all) i full join feed_source f using (source_id) where f.source_kind is null or i.items is null or i.source_kind <> f.source_kind""",
    "unmatched_ids": """select 'article' as side, article_id, count(*) as rows from normalized_article where article_id not in (select article_id from collected_item) group by all
        union all select 'item', article_id, count(*) from collected_item where article_id not in (select article_id from normalized_article) group by all""",
    "decisions_in_order": "select list_position(['included', 'deferred', 'excluded'], last_decision)::int as ord, last_decision as value, count(*) as rows from processed where last_decision in ('included', 'deferred', 'excluded') group by all",
    "plain_fields": f"select item_no, nullif({_PLAIN('title')}, '') as title, nullif({_PLAIN('published_at')}, '') as published_at, nullif({_PLAIN('url')}, '') as url from collected_item",
    "state_records": """select canonical_url, content_hash, cast(json_object('canonical_url', canonical_url, 'content_hash', content_hash, 'first_seen_at', epoch_us(first_seen_at)::varchar, 'last_decision', last_decision) as varchar) as line
        from (select * from processed where content_hash is not null qualify row_number() over (partition by canonical_url, content_hash order by record_no) = 1)""",
}

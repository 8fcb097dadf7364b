"""Selections, clusters, state and their constraints: set logic, integrity, ordered rendering and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import markdown_link
from millrace.operators.ranking import filled_forward, keep_first, retained
from millrace.operators.rollups import share, sum_or_null, upserted
from millrace.tables import table

BUCKETS = ["must_read", "worth_knowing", "excluded"]
#: Published articles of each bucket, days and number of runs that are kept, lines of the index.
CAPS, DAYS, RUNS, INDEX = {"must_read": 5, "worth_knowing": 8}, 35, 120, 30


def _decisions(spark: SparkSession, d: str) -> DataFrame:
    """(run_id, bucket_ord, bucket, pos, article_id) of every entry."""
    buckets = F.array(*[F.struct(F.lit(n).alias("bucket_ord"), F.lit(b).alias("bucket"), F.col(b).alias("ids")) for n, b in enumerate(BUCKETS)])
    rows = table(spark, d, "selector_output").select("run_id", F.explode(buckets).alias("b")).select("run_id", "b.*")
    return rows.select("run_id", "bucket_ord", "bucket", F.posexplode("ids").alias("pos", "article_id"))


def _groups(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "selector_output").select("run_id", F.posexplode("duplicate_groups").alias("group_no", "g"))
    return rows.select("run_id", "group_no", F.col("g.representative_id").alias("representative_id"), F.explode("g.duplicate_ids").alias("member_id"))


def selection_violations(spark: SparkSession, d: str) -> DataFrame:
    """Articles in several buckets of a run or twice in one, and duplicates that aren't excluded."""
    decisions = _decisions(spark, d)
    twice = decisions.groupBy("run_id", "article_id").agg(F.count("*").alias("n"), F.countDistinct("bucket").alias("buckets")).where("n > 1")
    twice = twice.select("run_id", "article_id", F.when(F.col("buckets") > 1, "several_buckets").otherwise("twice_in_bucket").alias("rule"))
    out = decisions.where("bucket = 'excluded'").select("run_id", F.col("article_id").alias("member_id"))
    loose = _groups(spark, d).join(out, ["run_id", "member_id"], "left_anti").select("run_id", F.col("member_id").alias("article_id"), F.lit("duplicate_not_excluded").alias("rule")).distinct()
    over = decisions.groupBy("run_id", "bucket").agg(F.count("*").alias("n"))
    cap = F.create_map(*[F.lit(x) for pair in CAPS.items() for x in pair])
    over = over.where(F.col("n") > F.try_element_at(cap, F.col("bucket"))).select("run_id", F.col("bucket").alias("article_id"), F.lit("over_cap").alias("rule"))
    return twice.unionByName(loose).unionByName(over)


def group_violations(spark: SparkSession, d: str) -> DataFrame:
    """Members that several groups of a run name."""
    shared = _groups(spark, d).groupBy("run_id", "member_id").agg(F.countDistinct("group_no").alias("groups"))
    return shared.where("groups > 1")


def cluster_violations(spark: SparkSession, d: str) -> DataFrame:
    """Clusters that support their own representative, or name a member twice."""
    rows = table(spark, d, "article_cluster").where("supporting is not null")
    return rows.select(
        "cluster_no", F.array_contains("supporting", F.col("representative")).alias("supports_itself"), (F.size("supporting") - F.size(F.array_distinct("supporting"))).alias("repeated"),
    ).where("supports_itself or repeated > 0")


def dangling_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids of clusters and duplicate groups that no article has."""
    clustered = table(spark, d, "article_cluster").select(F.explode(F.array_append(F.coalesce("supporting", F.array().cast("array<string>")), F.col("representative"))).alias("article_id"))
    grouped = _groups(spark, d).select(F.explode(F.array("representative_id", "member_id")).alias("article_id"))
    named = clustered.union(grouped).where("article_id is not null").distinct()
    return named.join(table(spark, d, "normalized_article").select("article_id"), "article_id", "left_anti")


def body_hash_violations(spark: SparkSession, d: str) -> DataFrame:
    """Articles whose hash isn't that of their body, and records whose hash isn't their article's."""
    articles = table(spark, d, "normalized_article")
    wrong = articles.where(F.sha2("body_text", 256) != F.col("content_hash")).select(F.lit("article").alias("what"), F.col("article_no").alias("no"))
    linked = table(spark, d, "processed").alias("p").join(articles.alias("a"), "article_no")
    return wrong.union(linked.where("p.content_hash <> a.content_hash").select(F.lit("record"), "record_no"))


def state_key_violations(spark: SparkSession, d: str) -> DataFrame:
    """Keys of the state that several records have."""
    keys = table(spark, d, "processed").groupBy("canonical_url", "content_hash").agg(F.count("*").alias("records"))
    return keys.where("records > 1")


def audit_targets(spark: SparkSession, d: str) -> DataFrame:
    """What a run's audit looks at: selected articles and representatives, each once, with all reasons in their order."""
    selected = _decisions(spark, d).where("bucket <> 'excluded'").select("run_id", "article_id", F.col("bucket_ord").alias("kind_ord"), F.col("bucket").alias("kind"))
    heads = _groups(spark, d).select("run_id", F.col("representative_id").alias("article_id"), F.lit(3).alias("kind_ord"), F.lit("representative").alias("kind"))
    kinds = selected.unionByName(heads).groupBy("run_id", "article_id").agg(F.array_sort(F.collect_set(F.struct("kind_ord", "kind"))).alias("k"))
    return kinds.select("run_id", "article_id", F.array_join(F.col("k.kind"), ",").alias("kinds"))


def running_order(spark: SparkSession, d: str) -> DataFrame:
    """The published order of every run: bucket, then place, numbered through."""
    from pyspark.sql import Window

    rows = keep_first(_decisions(spark, d).where("bucket <> 'excluded'"), ["run_id", "article_id"], "bucket_ord", "pos")
    number = F.row_number().over(Window.partitionBy("run_id").orderBy("bucket_ord", "pos"))
    return rows.select("run_id", number.alias("number"), "bucket", "article_id")


def digest_lines(spark: SparkSession, d: str) -> DataFrame:
    """A run's digest as one Markdown text: numbered links in running order."""
    articles = keep_first(table(spark, d, "normalized_article").select("article_id", "article_no", "title", "canonical_url"), ["article_id"], "article_no")
    rows = running_order(spark, d).join(articles, "article_id", "left")
    line = F.concat(F.col("number").cast("string"), F.lit(". "), markdown_link(F.coalesce("title", F.col("article_id")), F.coalesce("canonical_url", F.lit(""))))
    ordered = F.array_sort(F.collect_list(F.struct("number", line.alias("line"))))
    return rows.groupBy("run_id").agg(ordered.alias("l")).select("run_id", F.array_join(F.col("l.line"), "\n").alias("digest"))


def recent_days(spark: SparkSession, d: str) -> DataFrame:
    """The index of digests: the latest days that have one."""
    days = table(spark, d, "normalized_article").select(F.date_format("fetched_at", "yyyy-MM-dd").alias("day")).distinct()
    return days.orderBy(F.desc("day")).limit(INDEX)


def kept_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs that retention keeps, seen from the latest one."""
    runs = table(spark, d, "selector_output").select("run_id", F.try_to_timestamp(F.regexp_extract("run_id", r"run-(\d{8})T", 1), F.lit("yyyyMMdd")).alias("at"))
    latest = runs.agg(F.max("at").alias("latest"))
    dated = runs.join(latest, F.col("at") <= F.col("latest"))
    return retained(dated, "at", F.col("latest") - F.expr(f"interval {DAYS} days"), RUNS, "run_id").select("run_id")


def state_after(spark: SparkSession, d: str) -> DataFrame:
    """The state of the first half of the batches after the second half's decisions."""
    rows = table(spark, d, "processed").select("record_no", "batch_no", "canonical_url", F.coalesce("content_hash", F.lit("")).alias("content_hash"), F.unix_micros("first_seen_at").alias("seen_us"), "last_decision")
    keys = ["canonical_url", "content_hash"]
    state = keep_first(rows.where("batch_no <= 30"), keys, "batch_no", "record_no").select(*keys, "seen_us", "last_decision")
    changes = keep_first(rows.where("batch_no > 30"), keys, F.col("batch_no") * -1, F.col("record_no") * -1).select(*keys, "seen_us", "last_decision")
    return upserted(state, changes, keys, "seen_us", "last_decision")


def decisions_per_batch(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "processed").groupBy("batch_no")
    return rows.agg(
        F.count("*").alias("records"), F.count_if(F.col("last_decision") == "included").alias("included"), share(F.col("last_decision") == "included").alias("share_included"),
        F.count_if(F.col("content_hash").isNull()).alias("without_hash"),
    )


def source_health(spark: SparkSession, d: str) -> DataFrame:
    """Per source: what it delivered and what was unusable, with its trust."""
    items = table(spark, d, "collected_item").groupBy("source_id").agg(
        F.count("*").alias("items"), F.countDistinct("article_id").alias("articles"), F.count_if(F.col("url").isNull()).alias("without_url"),
        F.count_if(~F.coalesce("title", F.lit("")).rlike("[^ ]")).alias("without_title"), F.max(F.unix_micros("fetched_at")).alias("last_us"),
    )
    return table(spark, d, "feed_source").select("source_id", "connector", "trust_rank").join(items, "source_id", "left").fillna(0, ["items", "articles", "without_url", "without_title"])


def connector_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Per connector: sources in order, and a sum of points that one unknown value makes unknown."""
    sources = table(spark, d, "feed_source").groupBy("connector").agg(F.array_join(F.array_sort(F.collect_set("source_id")), ",").alias("sources"), sum_or_null(F.col("trust_rank")).alias("trust"))
    return sources


def points_by_mirror(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "hn_algolia").groupBy("mirror_id")
    return rows.agg(F.count("*").alias("hits"), sum_or_null(F.col("points")).alias("points"), F.sum(F.coalesce("points", F.lit(0))).alias("known_points"))


def releases_by_repo(spark: SparkSession, d: str) -> DataFrame:
    """Releases as titled items: repository and tag, the newest row of each, how many repeat it."""
    rows = table(spark, d, "gh_releases").select("row_no", "repo", "tag_name", F.substring(F.coalesce("body", F.lit("")), 1, 600).alias("summary"))
    first = rows.groupBy("repo", "tag_name").agg(F.min_by("summary", "row_no").alias("summary"), F.count("*").alias("deliveries"))
    return first.select(F.concat_ws(" ", "repo", "tag_name").alias("title"), "summary", "deliveries")


def last_known_titles(spark: SparkSession, d: str) -> DataFrame:
    """For every delivery of an article the latest title known by then."""
    rows = table(spark, d, "collected_item").select("item_no", "article_id", "title")
    return rows.select("item_no", filled_forward(rows, F.nullif(F.col("title"), F.lit("")), ["article_id"], "item_no").alias("known_title"))


def event_days(spark: SparkSession, d: str) -> DataFrame:
    """Events as run stamps: per day and kind, in UTC."""
    rows = table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", "value")
    return rows.groupBy("day", "event_type").agg(F.count("*").alias("events"), F.round(sum_or_null(F.col("value")), 4).alias("value"))


QUERIES = {
    f.__name__: f
    for f in (
        selection_violations, group_violations, cluster_violations, dangling_ids, body_hash_violations, state_key_violations, audit_targets, running_order, digest_lines, recent_days, kept_runs, state_after,
        decisions_per_batch, source_health, connector_rollup, points_by_mirror, releases_by_repo, last_known_titles, event_days,
    )
}

_DECISIONS = " union all ".join(
    f"select run_id, {n} as bucket_ord, '{b}' as bucket, unnest(range(len({b}))) as pos, unnest({b}) as article_id from selector_output" for n, b in enumerate(BUCKETS)
)
_GROUPS = "select run_id, group_no, g.representative_id as representative_id, unnest(g.duplicate_ids) as member_id from (select run_id, unnest(range(len(duplicate_groups))) as group_no, unnest(duplicate_groups) as g from selector_output)"
_ORDER = f"""select run_id, cast(row_number() over (partition by run_id order by bucket_ord, pos) as int) as number, bucket, article_id from (
    select * from ({_DECISIONS}) where bucket <> 'excluded' qualify row_number() over (partition by run_id, article_id order by bucket_ord, pos) = 1)"""

ORACLES = {
    "selection_violations": f"""
        select run_id, article_id, case when count(distinct bucket) > 1 then 'several_buckets' else 'twice_in_bucket' end as rule from ({_DECISIONS}) group by all having count(*) > 1
        union all select distinct run_id, member_id, 'duplicate_not_excluded' from ({_GROUPS}) g
            where not exists (select 1 from ({_DECISIONS}) d where d.bucket = 'excluded' and d.run_id = g.run_id and d.article_id = g.member_id)
        union all select run_id, bucket, 'over_cap' from ({_DECISIONS}) where bucket <> 'excluded' group by run_id, bucket having count(*) > case bucket when 'must_read' then 5 else 8 end""",
    "group_violations": f"select run_id, member_id, count(distinct group_no) as groups from ({_GROUPS}) group by run_id, member_id having count(distinct group_no) > 1",
    "cluster_violations": """select * from (select cluster_no, list_contains(supporting, representative) as supports_itself, cast(len(supporting) - len(list_distinct(supporting)) as int) as repeated
        from article_cluster where supporting is not null) where supports_itself or repeated > 0""",
    "dangling_ids": f"""select distinct article_id from (select representative as article_id from article_cluster union all select unnest(supporting) from article_cluster
        union all select representative_id from ({_GROUPS}) union all select member_id from ({_GROUPS})) where article_id is not null and article_id not in (select article_id from normalized_article)""",
    "body_hash_violations": """select 'article' as what, article_no as no from normalized_article where sha256(body_text) <> content_hash
        union all select 'record', record_no from processed p join normalized_article a using (article_no) where p.content_hash <> a.content_hash""",
    "state_key_violations": "select canonical_url, content_hash, count(*) as records from processed group by all having count(*) > 1",
    "audit_targets": f"""select run_id, article_id, string_agg(kind, ',' order by kind_ord) as kinds from (
        select distinct run_id, article_id, bucket_ord as kind_ord, bucket as kind from ({_DECISIONS}) where bucket <> 'excluded'
        union select distinct run_id, representative_id, 3, 'representative' from ({_GROUPS})) group by run_id, article_id""",
    "running_order": _ORDER,
    "digest_lines": rf"""select run_id, string_agg(number || '. [' || regexp_replace(trim(regexp_replace(coalesce(title, article_id), '\s+', ' ', 'g')), '([\\\[\]])', '\\\1', 'g') || '](' ||
        case when regexp_matches(coalesce(canonical_url, ''), '[()<> ]') then '<' || replace(replace(canonical_url, '<', '%3C'), '>', '%3E') || '>' else coalesce(canonical_url, '') end || ')', chr(10) order by number) as digest
        from ({_ORDER}) left join (select * from normalized_article qualify row_number() over (partition by article_id order by article_no) = 1) using (article_id) group by run_id""",
    "recent_days": "select distinct strftime(fetched_at at time zone 'UTC', '%Y-%m-%d') as day from normalized_article order by day desc limit 30",
    "kept_runs": """select run_id from (select run_id, strptime(substr(run_id, 5, 8), '%Y%m%d') as run_at, max(strptime(substr(run_id, 5, 8), '%Y%m%d')) over () as latest from selector_output)
        where run_at >= latest - interval 35 day order by run_at desc, run_id desc limit 120""",
    "state_after": """with r as (select record_no, batch_no, canonical_url, coalesce(content_hash, '') as content_hash, epoch_us(first_seen_at) as seen_us, last_decision from processed),
        s as (select * from r where batch_no <= 30 qualify row_number() over (partition by canonical_url, content_hash order by batch_no, record_no) = 1),
        c as (select * from r where batch_no > 30 qualify row_number() over (partition by canonical_url, content_hash order by batch_no desc, record_no desc) = 1)
        select canonical_url, content_hash, case when s.record_no is not null then s.seen_us else c.seen_us end as seen_us, coalesce(c.last_decision, s.last_decision) as last_decision from s full join c using (canonical_url, content_hash)""",
    "decisions_per_batch": """select batch_no, count(*) as records, count_if(coalesce(last_decision = 'included', false))::bigint as included,
        round(count_if(coalesce(last_decision = 'included', false)) / count(*), 6) as share_included, count_if(content_hash is null)::bigint as without_hash from processed group by batch_no""",
    "source_health": """select source_id, connector, trust_rank, coalesce(items, 0) as items, coalesce(articles, 0) as articles, coalesce(without_url, 0) as without_url, coalesce(without_title, 0) as without_title, last_us
        from feed_source left join (select source_id, count(*) as items, count(distinct article_id) as articles, count_if(url is null)::bigint as without_url,
        count_if(not regexp_matches(coalesce(title, ''), '[^ ]'))::bigint as without_title, max(epoch_us(fetched_at)) as last_us from collected_item group by source_id) using (source_id)""",
    "connector_rollup": """select connector, string_agg(distinct source_id, ',' order by source_id) as sources, case when count(trust_rank) = count(*) then sum(trust_rank)::bigint end as trust from feed_source group by connector""",
    "points_by_mirror": """select mirror_id, count(*) as hits, case when count(points) = count(*) then sum(points)::bigint end as points, sum(coalesce(points, 0))::bigint as known_points from hn_algolia group by mirror_id""",
    "releases_by_repo": "select concat_ws(' ', repo, tag_name) as title, arg_min(substr(coalesce(body, ''), 1, 600), row_no) as summary, count(*) as deliveries from gh_releases group by repo, tag_name",
    "last_known_titles": "select item_no, last_value(nullif(title, '') ignore nulls) over (partition by article_id order by item_no rows unbounded preceding) as known_title from collected_item",
    "event_days": "select strftime(ts, '%Y-%m-%d') as day, event_type, count(*) as events, round(case when count(value) = count(*) then sum(value) end, 4) as value from events group by all",
}

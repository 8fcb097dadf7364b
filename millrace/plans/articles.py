"""Scans, text functions, filters, ranking and deduplication over the article tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.functions.urls import canonical, resolved_links, site_of
from millrace.operators.gates import gated, greedy_budget
from millrace.operators.greedy import first_of_kind
from millrace.operators.leaks import PASSAGE, SHORT, shared_passages
from millrace.operators.ranking import capped, keep_first, top_per_group
from millrace.operators.stories import representatives, similar_classes, story_clusters, title_classes
from millrace.plans.fragments import BLANK, INVISIBLE, SUMMARY, canonical_ctes
from millrace.tables import stored, table

#: Items kept of each source, articles researched in a run, characters of a usable body and of a paragraph budget.
PER_SOURCE, RESEARCHED, USABLE, BUDGET = 12, 20, 200, 2000


def content_hashes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "normalized_article").select("article_no", X.content_hash(F.col("body_text")).alias("body_hash"))


def article_ids(spark: SparkSession, d: str) -> DataFrame:
    identity = F.coalesce("url", F.concat_ws("|", F.coalesce("title", F.lit("None")), F.coalesce("published_at", F.lit("None"))))
    return table(spark, d, "collected_item").select("item_no", X.article_id(F.col("source_id"), identity).alias("made_id"))


def summaries_plain(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "collected_item").select("item_no", X.stripped_markup(F.col("feed_summary")).alias("summary"))


def collapsed_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "collected_item").select("item_no", X.collapsed(F.col("title")).alias("title"), X.is_blank(F.col("title")).alias("blank"))


def canonical_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "processed").select("record_no", canonical("canonical_url").alias("c")).select("record_no", "c.*")


def records_per_site(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "processed").select("record_no", site_of(canonical("canonical_url")["url"]).alias("site"))
    return rows.groupBy("site").agg(F.count("*").alias("records"))


def exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """The first article of each body."""
    rows = table(spark, d, "normalized_article").select("article_no", "content_hash", "source_id")
    return keep_first(rows, ["content_hash"], "article_no")


def accepted_records(spark: SparkSession, d: str) -> DataFrame:
    """Records in their order; one is accepted if no accepted earlier one shares its address or its content."""
    rows = table(spark, d, "processed").select("record_no", "canonical_url", "content_hash")
    return first_of_kind(stored(rows), "record_no", ["canonical_url", "content_hash"]).select("record_no", "repeats")


def unknown_items(spark: SparkSession, d: str) -> DataFrame:
    """Items whose address isn't among the processed ones as it is spelt; an item without one is never known."""
    known = table(spark, d, "processed").select(F.col("canonical_url").alias("url")).distinct()
    return table(spark, d, "collected_item").select("item_no", "source_id", "url").join(known, "url", "left_anti").select("item_no", "source_id")


def fresh_articles(spark: SparkSession, d: str) -> DataFrame:
    """Articles of the seven days before they were fetched; undated ones are kept, as a feed's are."""
    since = F.col("fetched_at") - F.expr("interval 7 days")
    return table(spark, d, "normalized_article").where(F.col("published_at").isNull() | (F.col("published_at") >= since)).select("article_no", "source_id")


def fresh_two_sided(spark: SparkSession, d: str) -> DataFrame:
    """As a page index: only dated ones, and none from the future."""
    since = F.col("fetched_at") - F.expr("interval 7 days")
    return table(spark, d, "normalized_article").where(F.col("published_at").between(since, F.col("fetched_at"))).select("article_no", "source_id")


def newest_per_source(spark: SparkSession, d: str) -> DataFrame:
    """A source's newest items, as many as it may deliver."""
    rows = table(spark, d, "collected_item").select("item_no", "source_id", "fetched_at")
    return top_per_group(rows, ["source_id"], PER_SOURCE, F.col("fetched_at").desc(), "item_no").select("item_no", "source_id", "rank")


def research_order(spark: SparkSession, d: str) -> DataFrame:
    """Articles researched first: fixed sources, then the newest, ties by their order."""
    rows = table(spark, d, "normalized_article").select("article_no", "source_kind", "published_at")
    kept, _ = capped(rows, RESEARCHED, F.when(F.col("source_kind") == "fixed_watch", 0).otherwise(1), F.col("published_at").desc_nulls_last(), "article_no")
    return kept.select("article_no", "source_kind")


def keyword_hits(spark: SparkSession, d: str) -> DataFrame:
    """Search hits of several keywords, the first of each object, most points first within a mirror."""
    rows = table(spark, d, "hn_algolia").select("row_no", "mirror_id", "objectid", F.coalesce("points", F.lit(0)).alias("points"))
    first = keep_first(rows, ["objectid"], "row_no")
    return top_per_group(first, ["mirror_id"], PER_SOURCE, F.col("points").desc(), "row_no").select("row_no", "objectid", "points", "rank")


def items_of_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose kind is in a configured list, blanks and case aside."""
    wanted = [" Release", "ABSTRACT"]
    key = F.lower(F.trim(F.regexp_replace("doc_type", r"\s+", " ")))
    return table(spark, d, "documents").where(key.isin([" ".join(w.split()).casefold() for w in wanted])).select("doc_id", "doc_type")


def item_article_join(spark: SparkSession, d: str) -> DataFrame:
    """Items and the first article of their id, if any: what was collected and what came of it."""
    articles = keep_first(table(spark, d, "normalized_article").select("article_id", "article_no", "body_source"), ["article_id"], "article_no")
    items = table(spark, d, "collected_item").select("item_no", "article_id", "source_id")
    joined = items.join(articles, "article_id", "left")
    return joined.groupBy("source_id").agg(F.count("*").alias("items"), F.count("article_no").alias("normalized"), F.count_if(F.col("body_source") == "extracted").alias("extracted"))


def gate_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Articles through the gates: required fields, content, known before (a smaller article_no has the same body)."""
    rows = table(spark, d, "normalized_article").select("article_no", "title", "published_at", "body_text", "content_hash")
    first = rows.groupBy("content_hash").agg(F.min("article_no").alias("first_no"))
    chain = [
        ("required_fields", [("missing_title", ~F.coalesce("title", F.lit("")).rlike("[^ ]")), ("missing_published_at", F.col("published_at").isNull())]),
        ("content_available", [("content_unavailable", F.length("body_text") < USABLE)]),
        ("not_known_duplicate", [("duplicate_content", F.col("first_no") < F.col("article_no"))]),
    ]
    out = gated(rows.join(first, "content_hash"), chain)
    return out.select("article_no", "gate", "reason", F.size("results").alias("gates_run"), F.array_join(F.transform("results", lambda r: r["passed"].cast("string")), ",").alias("passed"))


def exclusion_reasons(spark: SparkSession, d: str) -> DataFrame:
    return gate_outcomes(spark, d).where("reason is not null").groupBy("reason").agg(F.count("*").alias("articles"))


def similar_titles(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of different sets of title words that name one topic; story_members has the articles."""
    return similar_classes(title_classes(table(spark, d, "normalized_article"), "article_no"))


def page_links(spark: SparkSession, d: str) -> DataFrame:
    """The canonical addresses that each article's text links to, its own aside."""
    rows = table(spark, d, "normalized_article").select("article_no", "canonical_url", F.regexp_extract_all("body_text", F.lit(r"(https?://[^\s<>()\[\]\"'`]+)"), F.lit(1)).alias("hrefs"))
    return rows.where(F.size("hrefs") > 0).select("article_no", F.explode(resolved_links("canonical_url", "hrefs")).alias("url"))


def story_members(spark: SparkSession, d: str) -> DataFrame:
    return story_clusters(table(spark, d, "normalized_article"), "article_no", links=page_links(spark, d))


def body_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Bodies with unified line ends, without blanks at line ends and blank lines at both ends: their lines."""
    rows = table(spark, d, "normalized_article").select("article_no", F.split(X.blocks(F.col("body_text")), "\n").alias("lines"))
    return rows.select("article_no", F.size("lines").alias("lines"), F.aggregate("lines", F.lit(0), lambda n, x: n + F.length(x)).alias("chars"))


def forbidden_traces(spark: SparkSession, d: str) -> DataFrame:
    """Traces of machine-written Japanese prose in documents: how often each rule matches, and where first."""
    found = table(spark, d, "documents").select("doc_id", F.explode(X.forbidden("text")).alias("f")).select("doc_id", "f.*")
    first = F.min(F.struct("start", "matched")).alias("first")
    return found.groupBy("doc_id", "rule").agg(F.count("*").alias("traces"), first).select("doc_id", "rule", "traces", "first.start", "first.matched")


def story_heads(spark: SparkSession, d: str) -> DataFrame:
    """Each story's representative: fixed sources first, then the earliest, then the smallest number."""
    articles = table(spark, d, "normalized_article").select("article_no", "source_kind", "published_at")
    rank = F.when(F.col("source_kind") == "fixed_watch", 1).otherwise(2)
    late = F.coalesce("published_at", F.lit("9999-01-01").cast("timestamp"))
    heads = representatives(articles.join(story_members(spark, d), "article_no"), "story", rank, late, "article_no")
    return heads.select("story", F.col("article_no").alias("representative"), "members")


def budgeted_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """How many lines of a document fit into the character budget, later smaller ones included."""
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(x) > 0)
    kept = greedy_budget(lines, F.length, BUDGET)
    docs = table(spark, d, "documents").where("text is not null")
    return docs.select("doc_id", F.size(lines).alias("n_lines"), F.size(kept).alias("n_kept"))


def titles_in_bodies(spark: SparkSession, d: str) -> DataFrame:
    """Articles whose body quotes their title word for word, blanks aside."""
    rows = table(spark, d, "normalized_article")
    return rows.where(X.verbatim_span(F.col("title"), F.col("body_text")).isNotNull()).select("article_no")


def redacted_documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.redacted(F.col("text")).alias("line"))


def markup_counts(spark: SparkSession, d: str) -> DataFrame:
    """Forbidden traces of machine-written text per document: emphasis, emoji, stray markup."""
    text = F.col("text")
    return table(spark, d, "documents").where("text is not null").select(
        "doc_id", F.regexp_count(text, F.lit(r"\*\*[^*\n]+\*\*")).alias("bold"), F.regexp_count(text, F.lit(r"[\x{1F300}-\x{1FAFF}]")).alias("emoji"),
        F.regexp_count(text, F.lit(r"(?i)\bas an ai\b")).alias("self_reference"), F.regexp_count(text, F.lit("</?[a-z][a-z0-9]*>")).alias("tags"),
    )


def leaked_passages(spark: SparkSession, d: str) -> DataFrame:
    """Documents that share 64 characters in a row with an item's summary, with the first such item."""
    return _leaked(spark, d, PASSAGE)


def leaked_texts(spark: SparkSession, d: str) -> DataFrame:
    """As `leaked_passages`, and documents that hold whole a summary of 16 to 63 characters."""
    return _leaked(spark, d, SHORT)


def _leaked(spark: SparkSession, d: str, shortest: int) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    summaries = table(spark, d, "collected_item").select(F.col("item_no").alias("id"), F.col("feed_summary").alias("text"))
    return shared_passages(docs, summaries, shortest).select(F.col("id").alias("doc_id"), F.col("secret_id").alias("item_no"), "secrets")


QUERIES = {
    f.__name__: f
    for f in (
        content_hashes, article_ids, summaries_plain, collapsed_titles, canonical_urls, records_per_site, exact_duplicates, accepted_records, unknown_items, fresh_articles, fresh_two_sided,
        newest_per_source, research_order, keyword_hits, items_of_kinds, item_article_join, gate_outcomes, exclusion_reasons, similar_titles, page_links, story_members, story_heads, body_blocks, forbidden_traces,
        budgeted_paragraphs, titles_in_bodies, leaked_passages, leaked_texts, redacted_documents, markup_counts,
    )
}

_GATES = """
    select article_no,
      case when not regexp_matches(coalesce(title, ''), '[^ ]') then 'missing_title' when published_at is null then 'missing_published_at'
           when length(body_text) < 200 then 'content_unavailable'
           when min(article_no) over (partition by content_hash) < article_no then 'duplicate_content' end as reason
    from normalized_article"""
_STOP = "['a', 'an', 'the', 'of', 'to', 'in', 'on', 'for', 'and', 'with', 'how', 'we', 'is', 'our', 'your']"
_WORDS = f"""
    words as (select article_no, list_sort(list_filter(list_distinct(regexp_extract_all(lower(title), '[0-9a-z]+|[぀-ヿ一-鿿]+')), lambda x: not list_contains({_STOP}, x))) as w
              from normalized_article where title is not null),
    sets as (select distinct w, md5(to_json(w)) as c from words where len(w) > 0),
    pairs as (select a.c as lc, b.c as rc, len(list_intersect(a.w, b.w)) as shared, len(a.w) + len(b.w) as total from sets a join sets b on a.c < b.c),
    alike as (select lc, rc, shared from pairs where shared >= 3 and shared * 5 >= (total - shared) * 3)"""
_STORIES = f"""{_WORDS},
    member as (select article_no, md5(to_json(w)) as c, len(w) as n from words where len(w) > 0),
    head as (select c, min(article_no) as h, min(n) as n from member group by c),
    edge as (select h.h as a, m.article_no as b from member m join head h using (c) where h.n >= 3
             union select l.h, r.h from alike join head l on l.c = lc join head r on r.c = rc),
    both_ways as (select a, b from edge union select b, a from edge),
    reach(a, b) as (select article_no, article_no from normalized_article union select r.a, e.b from reach r join both_ways e on r.b = e.a),
    story as (select a as article_no, min(b) as story from reach group by a)"""

_CANONICAL = canonical_ctes("select record_no as k, canonical_url as u from processed", "c")

_LINKS = canonical_ctes(r"select article_no as k, unnest(regexp_extract_all(body_text, 'https?://[^\s<>()\[\]\"''`]+')) as u from normalized_article", "c")

ORACLES = {
    "summaries_plain": f"select item_no, nullif(substr(trim(regexp_replace({SUMMARY}, '{BLANK}+', ' ', 'g')), 1, 400), '') as summary from collected_item",
    "collapsed_titles": f"""select item_no, trim(regexp_replace(regexp_replace(nfc_normalize(title), '{INVISIBLE}', '', 'g'), '{BLANK}+', ' ', 'g')) as title,
        regexp_replace(coalesce(title, ''), '{BLANK}|{INVISIBLE}', '', 'g') = '' as blank from collected_item""",
    "page_links": f"with {_LINKS} select distinct k as article_no, url from c join normalized_article on article_no = k where url is not null and url <> canonical_url",
    "canonical_urls": f"with {_CANONICAL} select k as record_no, url, problem from c",
    "records_per_site": f"with {_CANONICAL} select regexp_extract(url, '^[a-z]+://[^/?#]*') as site, count(*) as records from c group by all",
    "content_hashes": "select article_no, sha256(body_text) as body_hash from normalized_article",
    "article_ids": """select item_no, substr(sha256(source_id || chr(10) || coalesce(url, coalesce(title, 'None') || '|' || coalesce(published_at, 'None'))), 1, 32) as made_id from collected_item""",
    "exact_duplicates": "select content_hash, min(article_no) as article_no, arg_min(source_id, article_no) as source_id from normalized_article group by content_hash",
    "unknown_items": "select item_no, source_id from collected_item i where not exists (select 1 from processed p where p.canonical_url = i.url)",
    "fresh_articles": "select article_no, source_id from normalized_article where published_at is null or published_at >= fetched_at - interval 7 day",
    "fresh_two_sided": "select article_no, source_id from normalized_article where published_at between fetched_at - interval 7 day and fetched_at",
    "newest_per_source": "select item_no, source_id, rank from (select item_no, source_id, cast(row_number() over (partition by source_id order by fetched_at desc, item_no) as int) as rank from collected_item) where rank <= 12",
    "research_order": "select article_no, source_kind from normalized_article order by case when source_kind = 'fixed_watch' then 0 else 1 end, published_at desc nulls last, article_no limit 20",
    "keyword_hits": """select row_no, objectid, points, rank from (
        select *, cast(row_number() over (partition by mirror_id order by points desc, row_no) as int) as rank from (
            select row_no, mirror_id, objectid, coalesce(points, 0) as points from hn_algolia qualify row_number() over (partition by objectid order by row_no) = 1)) where rank <= 12""",
    "items_of_kinds": "select doc_id, doc_type from documents where lower(trim(doc_type)) in ('release', 'abstract')",
    "item_article_join": """select source_id, count(*) as items, count(article_no) as normalized, count_if(coalesce(body_source = 'extracted', false))::bigint as extracted
        from collected_item left join (select article_id, article_no, body_source from normalized_article qualify row_number() over (partition by article_id order by article_no) = 1) using (article_id) group by source_id""",
    "gate_outcomes": f"""select article_no,
        case when reason like 'missing%' then 'required_fields' when reason = 'content_unavailable' then 'content_available' when reason is not null then 'not_known_duplicate' end as gate, reason,
        cast(case when reason like 'missing%' then 1 when reason = 'content_unavailable' then 2 else 3 end as int) as gates_run,
        case when reason like 'missing%' then 'false' when reason = 'content_unavailable' then 'true,false' when reason is not null then 'true,true,false' else 'true,true,true' end as passed from ({_GATES})""",
    "exclusion_reasons": f"select reason, count(*) as articles from ({_GATES}) where reason is not null group by reason",
    "similar_titles": f"with {_WORDS} select lc as left_class, rc as right_class, cast(shared as int) as shared from alike",
    "story_members": f"with recursive {_STORIES} select article_no, story from story",
    "story_heads": f"""with recursive {_STORIES} select story, arg_min(article_no, struct_pack(r := case when source_kind = 'fixed_watch' then 1 else 2 end, p := coalesce(published_at, timestamptz '9999-01-01'), a := article_no)) as representative,
        count(*) as members from story join normalized_article using (article_no) group by story""",
    "titles_in_bodies": r"select article_no from normalized_article where trim(regexp_replace(title, '[ \t\n\r\f\v]+', ' ', 'g')) <> '' and contains(regexp_replace(body_text, '[ \t\n\r\f\v]+', ' ', 'g'), trim(regexp_replace(title, '[ \t\n\r\f\v]+', ' ', 'g')))",
    "leaked_passages": r"""with
        d as (select doc_id, trim(regexp_replace(text, '[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) as t from documents),
        s as (select item_no, trim(regexp_replace(feed_summary, '[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) as t from collected_item),
        dw as (select distinct doc_id, substr(t, k::int, 64) as w from (select doc_id, t, unnest(range(1, length(t) - 62)) as k from d where length(t) >= 64)),
        sw as (select distinct item_no, substr(t, k::int, 64) as w from (select item_no, t, unnest(range(1, length(t) - 62)) as k from s where length(t) >= 64))
        select doc_id, min(item_no) as item_no, count(distinct item_no)::bigint as secrets from dw join sw using (w) group by doc_id""",
    "leaked_texts": r"""with
        d as (select doc_id, trim(regexp_replace(text, '[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) as t from documents),
        s as (select item_no, trim(regexp_replace(feed_summary, '[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) as t from collected_item),
        dw as (select distinct doc_id, substr(t, k::int, 64) as w from (select doc_id, t, unnest(range(1, length(t) - 62)) as k from d where length(t) >= 64)),
        sw as (select distinct item_no, substr(t, k::int, 64) as w from (select item_no, t, unnest(range(1, length(t) - 62)) as k from s where length(t) >= 64)),
        pairs as (select doc_id, item_no from dw join sw using (w) union select doc_id, item_no from s join d on contains(d.t, s.t) where length(s.t) between 16 and 63)
        select doc_id, min(item_no) as item_no, count(distinct item_no)::bigint as secrets from pairs group by doc_id""",
    "forbidden_traces": "select * from (" + " union all ".join(
        f"""select doc_id, '{rule}' as rule, len(regexp_extract_all(text, '{pattern}')) as traces, cast(strpos(text, regexp_extract(text, '{pattern}')) - 1 as int) as start, substr(regexp_extract(text, '{pattern}'), 1, 40) as matched
        from documents where regexp_matches(text, '{pattern}')""" for rule, pattern in X.FORBIDDEN.items()) + ")",
    "body_blocks": r"""with b as (select article_no, regexp_replace(array_to_string(list_transform(string_split(regexp_replace(body_text, '\r\n?', chr(10), 'g'), chr(10)), lambda x: regexp_replace(x, '[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+$', '')), chr(10)), '^\n+|\n+$', '', 'g') as t from normalized_article)
        select article_no, cast(len(string_split(t, chr(10))) as int) as lines, cast(length(replace(t, chr(10), '')) as int) as chars from b""",
    "accepted_records": """with recursive o as (select record_no, 'u' || canonical_url as u, 'h' || content_hash as h, row_number() over (order by record_no) as n from processed),
        r(n, record_no, repeats, have) as (
            select 0::bigint, null::bigint, null::bigint, []::struct(k varchar, o bigint)[] union all
            select n, record_no, m, case when m is null then have || list_filter([{'k': u, 'o': record_no}, {'k': h, 'o': record_no}], lambda x: x.k is not null) else have end from (
                select o.n, o.record_no, o.u, o.h, r.have, list_min(list_transform(list_filter(r.have, lambda x: x.k = o.u or x.k = o.h), lambda x: x.o)) as m from r join o on o.n = r.n + 1))
        select record_no, repeats from r where n > 0""",
    "budgeted_paragraphs": """with l as (select doc_id, list_filter(string_split(text, chr(10)), lambda x: length(x) > 0) as lines from documents where text is not null)
        select doc_id, cast(len(lines) as int) as n_lines, cast(list_reduce(list_transform(lines, lambda x: {'used': length(x), 'kept': 1::bigint}),
            lambda a, x: case when a.used + x.used <= 2000 then {'used': a.used + x.used, 'kept': a.kept + 1} else a end, {'used': 0::bigint, 'kept': 0::bigint}).kept as int) as n_kept from l""",
    "redacted_documents": r"""select doc_id, substr(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
        'sk-[a-z]+-[A-Za-z0-9_-]{8,}', '<redacted>', 'g'), '\b(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{20,}', '<redacted>', 'g'), '\bgithub_pat_[A-Za-z0-9_]{20,}', '<redacted>', 'g'),
        '(?i)\bbearer\s+[A-Za-z0-9._~+/=-]{16,}', '<redacted>', 'g'), '\b[A-Z_]*OAUTH_TOKEN\s*=\s*\S+', '<redacted>', 'g'), 'https?://[^/\s@:]+:[^/\s]*@', '<redacted>', 'g'),
        '[ \t\n\r\f\v]+', ' ', 'g')), 1, 500) as line from documents""",
    "markup_counts": r"""select doc_id, cast(len(regexp_extract_all(text, '\*\*[^*\n]+\*\*')) as int) as bold, cast(len(regexp_extract_all(text, '[\x{1F300}-\x{1FAFF}]')) as int) as emoji,
        cast(len(regexp_extract_all(text, '(?i)\bas an ai\b')) as int) as self_reference, cast(len(regexp_extract_all(text, '</?[a-z][a-z0-9]*>')) as int) as tags from documents where text is not null""",
}

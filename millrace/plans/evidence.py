"""Quotes, claims and excerpts over the article tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.operators import evidence as E
from millrace.operators.ranking import keep_first
from millrace.plans.fragments import paragraph_ctes
from millrace.tables import stored, table

#: Characters of an excerpt.
EXCERPT = 4000


def _articles(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The first row of each article id."""
    return keep_first(table(spark, d, "normalized_article").select("article_id", "article_no", *columns), ["article_id"], "article_no")


def _members(spark: SparkSession, d: str) -> DataFrame:
    """(cluster_no, doc, member_no, member): a cluster's articles, the representative first; each is one map of drafts."""
    ids = F.concat(F.array("representative"), F.coalesce("supporting", F.array().cast("array<string>")))
    return table(spark, d, "article_cluster").select("cluster_no", F.col("representative").alias("doc"), F.posexplode(ids).alias("member_no", "member"))


def _drafts(spark: SparkSession, d: str, paragraphs: DataFrame) -> DataFrame:
    """The first sentence of each paragraph of a cluster's members, quoted from the same paragraph of the representative."""
    quote = F.regexp_extract("text", r"^([^.。\n]*[.。]?)", 1)
    kind = F.when(quote.contains("`"), "code").when(quote.rlike("(?i) than |比"), "comparison").when(quote.rlike(r"^([-*>]|\d+[.)]) "), "procedure").when(quote.rlike("(?i)fail|error|失敗"), "failure").otherwise("number")
    said = paragraphs.select(F.col("doc").alias("member"), "pos", quote.alias("quote"), kind.alias("kind"))
    return _members(spark, d).join(said, "member").select(
        "doc", "member", "cluster_no", "member_no", F.struct("cluster_no", "member_no").alias("map_no"), F.struct("cluster_no", "member_no", "pos").alias("at"), F.md5("quote").alias("local"), "pos", "quote", "kind",
    )


def _checked(spark: SparkSession, d: str) -> DataFrame:
    articles = _articles(spark, d, "body_text")
    paragraphs = stored(articles.select(F.col("article_id").alias("doc"), F.explode(X.paragraphs("body_text")).alias("p")).select("doc", "p.pos", "p.text"))
    return stored(E.checked_quotes(_drafts(spark, d, paragraphs), articles.select(F.col("article_id").alias("doc")), paragraphs))


def quote_problems(spark: SparkSession, d: str) -> DataFrame:
    """How many quotes of each map there are, and what is wrong with them; a map with any problem is rejected."""
    problems = ["duplicate_local_id", "unknown_document", "unknown_paragraph", "quote_not_in_paragraph"]
    counts = [F.count_if(F.col("problem").eqNullSafe(p)).alias(p) for p in problems]
    return _checked(spark, d).groupBy("cluster_no", "member_no").agg(F.count("*").alias("quotes"), *counts, (F.count("problem") == 0).alias("accepted"))


def evidence_ids(spark: SparkSession, d: str) -> DataFrame:
    """The evidence of the accepted maps with ids, checked kinds and the parts of the ids."""
    rows = E.numbered_quotes(E.accepted_quotes(_checked(spark, d))).select("evidence_id", "kind", F.md5("quote").alias("quote_hash"), E.evidence_place(F.col("evidence_id")).alias("p"))
    return rows.select("evidence_id", "kind", "quote_hash", "p.paragraph", "p.ordinal")


def research_status(spark: SparkSession, d: str) -> DataFrame:
    """How far the claims on each representative are covered. Each accepted member makes a claim on the quotes it shares with
    the representative, whose own claim says what happened; a later cluster's claim replaces an earlier one's."""
    accepted = stored(E.accepted_quotes(_checked(spark, d)))
    evidence = E.numbered_quotes(accepted).select("doc", "pos", "quote", F.col("kind").alias("settled"))
    cited = accepted.withColumn("quote", F.trim(F.regexp_replace("span", r"\s+", " "))).join(evidence, ["doc", "pos", "quote"])
    claims = cited.groupBy("doc", F.col("member").alias("claim_id"), F.col("map_no").alias("at")).agg(
        F.collect_set("settled").alias("kinds"), F.bool_or(F.col("settled").isin(E.NUMERIC)).alias("numeric"),
        F.count_if(F.col("settled") == "procedure").alias("conditions"), F.bool_or(F.col("quote").rlike("(?i)script|command|設定")).alias("reproducible"),
    )
    kind = F.when(F.col("claim_id") == F.col("doc"), "what_happened").otherwise("finding")
    latest = E.latest_claims(claims).withColumn("kind", kind)
    heads = table(spark, d, "article_cluster").select(F.col("representative").alias("article_id")).distinct()
    articles = _articles(spark, d, "author").join(heads, "article_id").select(F.col("article_id").alias("doc"), F.nullif(F.trim("author"), F.lit("")).alias("author"))
    return E.assessed(articles, latest).select(F.col("doc").alias("article_id"), "status", "unmet")


def excerpts(spark: SparkSession, d: str) -> DataFrame:
    """Which texts of a run's selected articles fit into an excerpt."""
    ids = F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in ("must_read", "worth_knowing", "excluded")])
    wanted = table(spark, d, "selector_output").select("run_id", F.posexplode(ids).alias("pos", "key"))
    sized = wanted.join(_articles(spark, d, "body_text").select(F.col("article_id").alias("key"), F.length("body_text").alias("chars")), "key", "left")
    lists = sized.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("pos", "key", "chars"))).alias("items"))
    states = lists.select("run_id", "items", E.excerpt_states(F.col("items"), EXCERPT).alias("states"))
    each = states.select("run_id", F.explode(F.arrays_zip("items", "states")).alias("z"))
    return each.select("run_id", F.col("z.items.pos").alias("pos"), F.col("z.items.key").alias("article_id"), F.col("z.states").alias("state"))


def supporting_stubs(spark: SparkSession, d: str) -> DataFrame:
    """A row for every article that only supports another: the one that stands for it, and no content of its own."""
    pairs = table(spark, d, "article_cluster").select("cluster_no", "representative", F.explode("supporting").alias("article_id")).where("article_id <> representative").distinct()
    known = _articles(spark, d).select("article_id")
    return pairs.join(known, "article_id", "left_semi").select("cluster_no", "article_id", "representative", F.lit("supporting").alias("role"), F.lit(0).alias("claims"))


def untrusted_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Articles as delimited blocks that their own text can't end; the blocks' hashes and lengths."""
    fields = {"article_id": F.col("article_id"), "canonical_url": F.col("canonical_url"), "body_source": F.col("body_source"), "title": F.col("title"), "author": F.col("author")}
    rows = table(spark, d, "normalized_article").select("article_no", X.untrusted_block(fields, F.col("body_text")).alias("block"))
    return rows.select("article_no", F.md5("block").alias("block_hash"), F.length("block").alias("chars"))


def document_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs with their place and the heading above them."""
    docs = table(spark, d, "documents").select("doc_id", F.explode(X.paragraphs("text")).alias("p"))
    return docs.select("doc_id", "p.pos", "p.section", F.length("p.text").alias("chars"))


QUERIES = {f.__name__: f for f in (quote_problems, evidence_ids, research_status, excerpts, supporting_stubs, untrusted_blocks, document_paragraphs)}

_FIRST = "select * from normalized_article qualify row_number() over (partition by article_id order by article_no) = 1"
_SPACE = r"[ \t\n\r\f\v]+"
_COLLAPSE = lambda c: rf"trim(regexp_replace({c}, '{_SPACE}', ' ', 'g'))"
_CHECKED = rf"""{paragraph_ctes(f"select article_id as k, body_text as t from ({_FIRST})", "par")},
    member as (select cluster_no, representative as doc, unnest(range(0, len(ids)))::int as member_no, unnest(ids) as member from (select cluster_no, representative, list_concat([representative], coalesce(supporting, [])) as ids from article_cluster)),
    said as (select k as member, pos, regexp_extract(text, '^[^.。\n]*[.。]?') as quote from par),
    draft as (select m.*, s.pos, s.quote, case when contains(quote, '`') then 'code' when regexp_matches(quote, '(?i) than |比') then 'comparison' when regexp_matches(quote, '^([-*>]|\d+[.)]) ') then 'procedure'
        when regexp_matches(quote, '(?i)fail|error|失敗') then 'failure' else 'number' end as kind, row_number() over (partition by cluster_no, member_no, quote order by pos) as copy from member m join said s using (member)),
    checked as (select d.*, p.text, case when copy > 1 then 'duplicate_local_id' when d.doc not in (select article_id from normalized_article) then 'unknown_document' when p.text is null then 'unknown_paragraph'
        when {_COLLAPSE('d.quote')} = '' or not contains(regexp_replace(p.text, '{_SPACE}', ' ', 'g'), {_COLLAPSE('d.quote')}) then 'quote_not_in_paragraph' end as problem,
        case when d.kind in ('number', 'comparison') and not regexp_matches(quote, '\p{{Nd}}') then 'statement'
             when d.kind = 'code' and not (starts_with(p.text, '```') or regexp_matches(quote, '^\s*`[^`]+`\s*$')) then 'statement' else d.kind end as checked_kind
        from draft d left join par p on p.k = d.doc and p.pos = d.pos),
    good as (select *, {_COLLAPSE('quote')} as q from checked where (cluster_no, member_no) not in (select (cluster_no, member_no) from checked where problem is not null)),
    seen as (select doc, pos, q, arg_min(checked_kind, (cluster_no, member_no)) as kind, min((cluster_no, member_no)) as first from good group by doc, pos, q),
    evidence as (select *, row_number() over (partition by doc, pos order by first, q) as ordinal from seen)"""

ORACLES = {
    "quote_problems": f"""with {_CHECKED} select cluster_no, member_no, count(*) as quotes, count(*) filter (where problem = 'duplicate_local_id') as duplicate_local_id, count(*) filter (where problem = 'unknown_document') as unknown_document,
        count(*) filter (where problem = 'unknown_paragraph') as unknown_paragraph, count(*) filter (where problem = 'quote_not_in_paragraph') as quote_not_in_paragraph, count(problem) = 0 as accepted from checked group by cluster_no, member_no""",
    "evidence_ids": f"with {_CHECKED} select doc || '#main/p' || pos || '#' || ordinal as evidence_id, kind, md5(q) as quote_hash, 'p' || pos as paragraph, ordinal::int as ordinal from evidence",
    "research_status": f"""with {_CHECKED},
        claim as (select g.doc, g.member, g.cluster_no, g.member_no, list(distinct e.kind) as kinds, bool_or(e.kind in ('number', 'comparison')) as numeric_, count_if(e.kind = 'procedure') as conditions,
            bool_or(regexp_matches(g.q, '(?i)script|command|設定')) as reproducible from good g join evidence e using (doc, pos, q) group by all),
        latest as (select *, min((cluster_no, member_no)) over (partition by doc, member) as first from claim qualify row_number() over (partition by doc, member order by cluster_no desc, member_no desc) = 1),
        lack as (select doc, first, member, list_filter([case when numeric_ and conditions = 0 then 'conditions:' || member end, case when reproducible and not list_has_any(kinds, ['code', 'config', 'procedure']) then 'reproduction:' || member end], lambda x: x is not null) as l from latest),
        own as (select doc, bool_or(member = doc) as told, bool_or(list_has_any(kinds, ['code', 'config', 'number', 'comparison', 'failure', 'procedure'])) as shown from latest group by doc),
        short as (select doc, string_agg(array_to_string(l, ','), ',' order by first, member) as l from lack where len(l) > 0 group by doc),
        a as (select article_id, nullif(trim(author), '') as author, coalesce(told, false) as told, coalesce(shown, false) as shown, s.l from ({_FIRST}) n left join own on own.doc = n.article_id left join short s on s.doc = n.article_id
            where article_id in (select representative from article_cluster))
        select article_id, case when not told or not shown then 'insufficient' when author is null or l is not null then 'partial' else 'complete' end as status,
            concat_ws(',', case when not told then 'what_happened' end, case when not shown then 'concrete_evidence' end, case when author is null then 'author' end, l) as unmet from a""",
    "excerpts": f"""with ids as (select run_id, list_concat(list_concat(coalesce(must_read, []), coalesce(worth_knowing, [])), coalesce(excluded, [])) as ids from selector_output),
        item as (select run_id, unnest(range(0, len(ids)))::int as pos, unnest(ids) as key from ids),
        sized as (select i.*, length(n.body_text) as chars, row_number() over (partition by run_id, key order by pos) as copy from item i left join ({_FIRST}) n on n.article_id = i.key),
        fold as (select run_id, list_reduce(list(dict order by pos), lambda a, x: case when a.used + x.chars <= {EXCERPT} then {{'pos': x.pos, 'chars': x.chars, 'used': a.used + x.chars, 'kept': list_append(a.kept, x.pos)}} else {{'pos': a.pos, 'chars': a.chars, 'used': a.used, 'kept': a.kept}} end,
            {{'pos': 0, 'chars': 0::bigint, 'used': 0::bigint, 'kept': cast([] as int[])}}).kept as kept from (select run_id, pos, {{'pos': pos, 'chars': chars::bigint, 'used': 0::bigint, 'kept': cast([] as int[])}} as dict from sized where copy = 1 and chars is not null) group by run_id)
        select run_id, pos, key as article_id, case when copy > 1 then 'repeated' when chars is null then 'missing' when list_contains(kept, pos) then 'shown' else 'omitted' end as state from sized left join fold using (run_id)""",
    "supporting_stubs": """select distinct cluster_no, article_id, representative, 'supporting' as role, 0 as claims from (select cluster_no, representative, unnest(supporting) as article_id from article_cluster)
        where article_id <> representative and article_id in (select article_id from normalized_article)""",
    "untrusted_blocks": """with f as (select article_no, chr(10) as nl, [replace(coalesce(x, '-'), 'UNTRUSTED_ARTICLE_BODY', 'UNTRUSTED-ARTICLE-BODY') for x in [article_id, canonical_url, body_source, title, author, body_text]] as v from normalized_article),
        b as (select article_no, '<<<UNTRUSTED_ARTICLE_BODY>>>' || nl || 'article_id: ' || v[1] || nl || 'canonical_url: ' || v[2] || nl || 'body_source: ' || v[3] || nl || 'title: ' || v[4] || nl || 'author: ' || v[5] || nl || 'body:' || nl || v[6] || nl || '<<<END_UNTRUSTED_ARTICLE_BODY>>>' as block from f)
        select article_no, md5(block) as block_hash, length(block)::int as chars from b""",
    "document_paragraphs": f"with {paragraph_ctes('select doc_id as k, text as t from documents', 'par')} select k as doc_id, pos, section, length(text)::int as chars from par",
}

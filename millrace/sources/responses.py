"""Recorded responses become rows: feeds, sitemaps, JSON searches and page heads.

The input is a table responses(source_id, url, status, body BINARY). A body that can't be read gives no rows here and one
row in `unreadable`, so one bad source never stops the others. Entries carry their place, on which every later order
rests. JSON stays in Spark (`from_json` with a fixed schema); XML and HTML are parsed per Arrow batch.
"""

from __future__ import annotations

import html
import json
import re
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import stripped_markup
from millrace.operators.instants import with_instant
from millrace.operators.ranking import keep_first, top_per_group

_ENTRY = T.ArrayType(T.StructType([
    T.StructField("pos", T.IntegerType()), T.StructField("title", T.StringType()), T.StructField("url", T.StringType()), T.StructField("published", T.StringType()),
    T.StructField("summary", T.StringType()), T.StructField("categories", T.ArrayType(T.StringType())),
]))


# Namespaces of the elements that are read, and the prefixes they have here.
NAMESPACES = {"": "", "http://www.w3.org/2005/Atom": "atom:", "http://purl.org/dc/elements/1.1/": "dc:", "http://www.sitemaps.org/schemas/sitemap/0.9": ""}


def xml_records(body: bytes, tags: set[str]) -> tuple[str, list[list[tuple[str, dict, str]]]]:
    """(root name, records): every element of `tags` as its direct children's (name, attributes, text).

    Names have the prefixes of NAMESPACES, names of other namespaces their whole address, so that none is taken for
    another. Entity declarations are refused; a document type without them isn't.
    """
    parser = expat.ParserCreate(namespace_separator=" ")
    stack: list[tuple[str, dict, list[str]]] = []
    records: list[list[tuple[str, dict, str]]] = []
    open_: list[list] = []
    root = ""

    def refuse(*_):
        raise ValueError("declarations are refused")

    def start(name, attributes):
        nonlocal root
        space, _, local = name.rpartition(" ")
        name = NAMESPACES.get(space, space + " ") + local
        root = root or name
        if name in tags and not open_:
            open_.append([])
        stack.append((name, attributes, []))

    def end(_name):
        name, attributes, text = stack.pop()
        if open_ and name in tags:
            records.append(open_.pop())
        elif open_:
            if stack and stack[-1][0] in tags:
                open_[-1].append((name, attributes, "".join(text).strip()))
            else:
                stack[-1][2].extend(text)

    parser.StartElementHandler, parser.EndElementHandler = start, end
    parser.CharacterDataHandler = lambda data: stack and stack[-1][2].append(data)
    parser.EntityDeclHandler = parser.ExternalEntityRefHandler = refuse
    parser.Parse(body, True)
    return root, records


def feed_entries(body: bytes) -> list[dict]:
    """RSS items, or Atom entries where there are none."""
    _, records = xml_records(body, {"item"})
    atom = not records
    if atom:
        _, records = xml_records(body, {"atom:entry"})
    out = []
    for n, fields in enumerate(records):
        first = lambda *names, f=fields: next((t for name in names for k, _, t in f if k == name and t), None)
        if atom:
            links = [a for k, a, _ in fields if k == "atom:link" and a.get("href")]
            url = next((a["href"] for a in links if a.get("rel", "alternate") == "alternate"), links[0]["href"] if links else None) or first("atom:id")
            entry = {"title": first("atom:title"), "url": url, "published": first("atom:published", "atom:updated"), "summary": first("atom:summary", "atom:content"), "categories": [a.get("term") for k, a, _ in fields if k == "atom:category"]}
        else:
            entry = {"title": first("title"), "url": first("link", "guid"), "published": first("pubDate", "dc:date"), "summary": first("description"), "categories": [t for k, _, t in fields if k == "category"]}
        out.append({"pos": n, **entry})
    return out


def sitemap_entries(body: bytes) -> list[dict]:
    """Addresses of a sitemap; an index of sitemaps is an error."""
    root, records = xml_records(body, {"url"})
    if root == "sitemapindex":
        raise ValueError("an index, not a sitemap")
    get = lambda f, name: next((t for k, _, t in f if k == name and t), None)
    return [{"pos": n, "title": None, "url": get(f, "loc"), "published": get(f, "lastmod"), "summary": None, "categories": []} for n, f in enumerate(records)]


_HEAD_END = re.compile(rb"</head\s*>", re.I)
_META = re.compile(r"<meta\s+([^>]*)>", re.I)
_ATTRIBUTE = re.compile(r"""([\w:-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_TITLE = re.compile(r"<title[^>]*>(.*?)</title>", re.I | re.S)
_LINKED_DATA = re.compile(r"""<script[^>]*\stype\s*=\s*["']application/ld\+json["'][^>]*>(.*?)</script>""", re.I | re.S)
# Types of linked data that are articles.
ARTICLES = ["blogposting", "article", "newsarticle", "techarticle", "report"]
# Names of meta elements, best first.
HEAD_TITLES = ["og:title", "twitter:title"]
HEAD_DATES = ["article:published_time", "og:article:published_time", "date", "datepublished", "dc.date", "publish_date"]
HEAD_DESCRIPTIONS = ["og:description", "description", "twitter:description"]


def _things(data) -> list[dict]:
    """Objects of linked data: each before those of its graph, of several side by side the last first."""
    if isinstance(data, list):
        return [thing for one in reversed(data) for thing in _things(one)]
    if not isinstance(data, dict):
        return []
    graph = data.get("@graph")
    return [data, *(_things(graph) if isinstance(graph, list) else [])]


def _linked_data(head: str) -> dict[str, str]:
    """The first texts that the head's articles give for their properties."""
    out: dict[str, str] = {}
    for block in _LINKED_DATA.findall(head):
        try:
            things = _things(json.loads(block))
        except ValueError:
            continue
        for thing in things:
            types = thing.get("@type")
            if any(isinstance(t, str) and t.lower() in ARTICLES for t in (types if isinstance(types, list) else [types])):
                for name, value in thing.items():
                    if isinstance(value, str) and value.strip():
                        out.setdefault(name, " ".join(html.unescape(value).split()))
    return out


def page_head(body: bytes) -> dict:
    """Title, time and description that a page declares in its head: in linked data, else in meta elements."""
    head = _HEAD_END.split(body, maxsplit=1)[0].decode("utf-8", "replace")
    told = _linked_data(head)
    meta: dict[str, str] = {}
    for tag in _META.findall(head):
        a = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(tag)}
        name = (a.get("property") or a.get("name") or a.get("itemprop") or "").lower()
        if a.get("content", "").strip():
            meta.setdefault(name, a["content"].strip())
    title = _TITLE.search(head)
    pick = lambda names: next((meta[n] for n in names if n in meta), None)
    named = told.get("headline") or pick(HEAD_TITLES) or (title[1].strip() if title else None)
    return {"title": (named or "")[:500] or None, "published": told.get("datePublished") or pick(HEAD_DATES), "description": told.get("description") or pick(HEAD_DESCRIPTIONS)}


def _safely(parse):
    def one(body):
        try:
            return parse(bytes(body)) if body is not None else None
        except (expat.ExpatError, ValueError, KeyError):
            return None

    return lambda bodies: bodies.map(one)


@F.pandas_udf(_ENTRY)
def feed_column(bodies: pd.Series) -> pd.Series:
    return _safely(feed_entries)(bodies)


@F.pandas_udf(_ENTRY)
def sitemap_column(bodies: pd.Series) -> pd.Series:
    return _safely(sitemap_entries)(bodies)


@F.pandas_udf(T.StructType([T.StructField(n, T.StringType()) for n in ("title", "published", "description")]))
def head_column(bodies: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([page_head(bytes(b)) if b is not None else {} for b in bodies], columns=["title", "published", "description"], dtype=object)


# The fields of the JSON interfaces that are read.
SEARCH = "hits array<struct<objectID:string,created_at:string,points:double,title:string,url:string,story_text:string>>"
RELEASES = "array<struct<tag_name:string,name:string,html_url:string,published_at:string,created_at:string,body:string>>"
PAPERS = "array<struct<title:string,publishedAt:string,summary:string,id:string,paper:struct<id:string,title:string,publishedAt:string,summary:string,upvotes:int>>>"


def _json(responses: DataFrame, schema: str, path: str | None) -> DataFrame:
    text = F.decode("body", "utf-8")
    parsed = F.from_json(text, schema if path is None else f"struct<{schema}>")
    return responses.select("source_id", "url", F.posexplode(parsed if path is None else parsed[path]).alias("pos", "e"))


def search_items(responses: DataFrame, most: int) -> DataFrame:
    """Hits of all keywords of a source: the first of each object, most points first; no points count as 0."""
    rows = _json(responses, SEARCH, "hits").select(
        "source_id", F.col("url").alias("query"), "pos", F.col("e.objectID").alias("object_id"), F.col("e.title").alias("title"),
        F.coalesce("e.url", F.concat(F.lit("https://news.ycombinator.com/item?id="), "e.objectID")).alias("url"), F.coalesce(F.col("e.points").cast("int"), F.lit(0)).alias("points"), F.col("e.created_at").alias("published"),
        stripped_markup(F.col("e.story_text")).alias("summary"),
    )
    first = keep_first(rows.where("object_id is not null"), ["source_id", "object_id"], "query", "pos")
    return top_per_group(first, ["source_id"], most, F.col("points").desc(), "query", "pos")


def release_items(responses: DataFrame, repo: Column) -> DataFrame:
    rows = _json(responses, RELEASES, None)
    return rows.select("source_id", "pos", F.concat_ws(" ", repo, F.coalesce("e.tag_name", "e.name")).alias("title"), F.col("e.html_url").alias("url"),
                       F.coalesce("e.published_at", "e.created_at").alias("published"), stripped_markup(F.col("e.body"), 600).alias("summary"))


def paper_items(responses: DataFrame, most: int) -> DataFrame:
    rows = _json(responses, PAPERS, None).where(F.col("pos") < most)
    pick = lambda name: F.coalesce(f"e.paper.{name}", f"e.{name}")
    return rows.select("source_id", "pos", pick("id").alias("paper_id"), pick("title").alias("title"), pick("publishedAt").alias("published"), pick("summary").alias("summary"), F.coalesce("e.paper.upvotes", F.lit(0)).alias("upvotes"))


def feed_items(responses: DataFrame, known: DataFrame, settings: DataFrame, entries: Column, now: str, undated: bool = True) -> DataFrame:
    """Entries of feeds (`feed_column`) or sitemaps (`sitemap_column`) that a source may deliver, in their order.

    known(url) are addresses as spelt before; settings(source_id, max_items, window_days, categories ARRAY or null). Known
    ones, other categories (blanks and case aside) and entries before the window go, undated ones stay if `undated`; only
    what is kept counts towards max_items.
    """
    rows = responses.select("source_id", "url", F.explode(entries).alias("e")).select("source_id", F.col("url").alias("response"), "e.*")
    rows = rows.withColumnRenamed("categories", "entry_categories").join(settings.withColumnRenamed("categories", "settings_categories"), "source_id")
    dated = with_instant(rows.join(known.select("url").distinct(), "url", "left_anti"), F.col("published"), "epoch_us")
    since = F.unix_micros(F.lit(now).cast("timestamp")) - F.col("window_days").cast("long") * 86_400_000_000
    plain = lambda c: F.transform(c, lambda x: F.replace(F.lower(F.trim(F.regexp_replace(x, r"\s+", " "))), F.lit("ß"), F.lit("ss")))
    wanted = F.col("settings_categories").isNull() | F.arrays_overlap(plain(F.col("entry_categories")), plain(F.col("settings_categories")))
    renamed = dated.where(F.coalesce(F.col("epoch_us") >= since, F.lit(undated))).where(F.coalesce(wanted, F.lit(False)))
    most = settings.agg(F.max("max_items")).first()[0] or 0  # one number; it lets Spark cut each source before its shuffle
    kept = top_per_group(renamed, ["source_id"], most, "response", "pos").where(F.col("rank") <= F.col("max_items"))
    return kept.select("source_id", "rank", "title", "url", "published", "epoch_us", stripped_markup(F.col("summary")).alias("summary"))


def unreadable(responses: DataFrame, entries: Column) -> DataFrame:
    """(source_id, url, reason) of responses without readable entries: refused status, or a body that can't be parsed."""
    status = F.when(F.col("status") == 429, "rate_limit").when(F.col("status").isin(401, 403), "auth").when(F.col("status") >= 400, "http")
    reason = F.coalesce(status, F.when(entries.isNull(), F.lit("parse")))
    return responses.select("source_id", "url", reason.alias("reason")).where("reason is not null")

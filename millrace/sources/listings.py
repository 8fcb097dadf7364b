"""Listing pages and dated lists: which entries a source may deliver, as plans over the anchors that its pages hold.

Pages are parsed once per Arrow batch into anchors; choosing, dating, ordering and capping them is left to Spark.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.urls import joined_links
from millrace.operators.instants import with_instant
from millrace.operators.ranking import keep_first, top_per_group

# Beginnings of the class names of story cards, their titles and their authors with dates.
CARD, CARD_TITLE, CARD_AUTHOR = "tile_", "headline_", "author_"
# Elements without an end tag.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

_ANCHORS = T.ArrayType(T.StructType([
    T.StructField("pos", T.IntegerType()), T.StructField("href", T.StringType()), T.StructField("classes", T.ArrayType(T.StringType())),
    T.StructField("parts", T.ArrayType(T.StructType([T.StructField("class", T.StringType()), T.StructField("text", T.StringType())]))),
]))


class _Anchors(HTMLParser):
    """Links with their classes, and the text below every class within them."""

    def __init__(self):
        super().__init__()
        self.found: list[dict] = []
        self.inside: list[tuple[str, list[int]]] | None = None

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        classes = (given.get("class") or "").split()
        if tag == "a":
            self.found.append({"pos": len(self.found), "href": given.get("href") or "", "classes": classes, "parts": []})
            self.inside = []
        elif self.inside is not None and tag not in _VOID:
            parts = self.found[-1]["parts"]
            self.inside.append((tag, list(range(len(parts), len(parts) + len(classes)))))
            parts.extend({"class": c, "text": ""} for c in classes)

    def handle_endtag(self, tag):
        if tag == "a":
            self.inside = None
        elif self.inside:
            at = max((n for n, (name, _) in enumerate(self.inside) if name == tag), default=len(self.inside))
            del self.inside[at:]

    def handle_data(self, data):
        for _, numbers in self.inside or []:
            for n in numbers:
                self.found[-1]["parts"][n]["text"] += data


def anchors(body: bytes | None) -> list[dict]:
    parser = _Anchors()
    parser.feed((body or b"").decode("utf-8", "replace"))
    parser.close()
    return parser.found


@F.pandas_udf(_ANCHORS)
def anchor_column(bodies: pd.Series) -> pd.Series:
    return bodies.map(lambda b: anchors(bytes(b) if b is not None else None))


def _anchors_of(pages: DataFrame) -> DataFrame:
    rows = pages.select("source_id", "url", F.explode(anchor_column("body")).alias("a")).select("source_id", F.col("url").alias("page"), "a.*")
    return rows.withColumn("url", joined_links("page", "href"))


def _newest(rows: DataFrame, settings: DataFrame, known: DataFrame, now: str, two_sided: bool) -> DataFrame:
    """Dated rows(source_id, url, page, pos, published, …) of unknown addresses within the window, newest first, ties by their place; of an address's rows
    the newest."""
    at = F.unix_micros(F.lit(now).cast("timestamp"))
    dated = with_instant(rows.join(known.select("url").distinct(), "url", "left_anti"), F.col("published"), "epoch_us").join(settings, "source_id")
    within = (F.col("epoch_us") >= at - F.col("window_days").cast("long") * 86_400_000_000) & (F.col("epoch_us") <= at if two_sided else F.lit(True))
    once = keep_first(dated.where(within), ["source_id", "url"], -F.col("epoch_us"), "page", "pos")
    most = settings.agg(F.max("max_items")).first()[0] or 0  # one number; it lets Spark cut each source before its shuffle
    return top_per_group(once, ["source_id"], most, F.col("epoch_us").desc(), "page", "pos").where(F.col("rank") <= F.col("max_items"))


def index_links(pages: DataFrame, settings: DataFrame, known: DataFrame) -> DataFrame:
    """(source_id, url, page, pos, rank): links of an index page with the source's class and prefix, each once, those to read
    first. settings(source_id, link_class, url_prefix, max_probes). Known ones go before the cap."""
    rows = _anchors_of(pages).join(settings, "source_id").where(F.array_contains("classes", F.col("link_class")) & F.startswith("url", "url_prefix"))
    fresh = keep_first(rows.select("source_id", "url", "page", "pos", "max_probes"), ["source_id", "url"], "page", "pos").join(known.select("url").distinct(), "url", "left_anti")
    most = settings.agg(F.max("max_probes")).first()[0] or 0
    return top_per_group(fresh, ["source_id"], most, "page", "pos").where(F.col("rank") <= F.col("max_probes")).select("source_id", "url", "page", "pos", "rank")


def index_items(links: DataFrame, heads: DataFrame, settings: DataFrame, known: DataFrame, now: str) -> DataFrame:
    """Links (of `index_links`) with what their pages say, heads(url, answered, title, published, description): only dated ones
    of the window, newest first. A page that answered from outside the source's prefix says nothing."""
    prefix = settings.select("source_id", "url_prefix")
    read = links.drop("rank").join(heads, "url").join(prefix, "source_id").where(F.startswith("answered", "url_prefix"))
    kept = _newest(read.select("source_id", "url", "page", "pos", "title", "published", "description"), settings.select("source_id", "window_days", "max_items"), known, now, True)
    return kept.select("source_id", "rank", "title", "url", "published", F.col("description").alias("summary"))


def card_items(pages: DataFrame, settings: DataFrame, known: DataFrame, now: str) -> DataFrame:
    """Story cards of the window, newest first, an address once: its title and the date beside its author. Only web addresses
    without credentials count. settings(source_id, window_days, max_items)."""
    text = lambda start: F.array_join(F.transform(F.filter("parts", lambda p: p["class"].startswith(start)), lambda p: p["text"]), "")
    cards = _anchors_of(pages).where(F.exists("classes", lambda c: c.startswith(CARD))).select(
        "source_id", F.trim("href").alias("url"), "page", "pos", F.nullif(F.trim(text(CARD_TITLE)), F.lit("")).alias("title"), F.regexp_extract(text(CARD_AUTHOR), r"\b(\d{4}-\d{2}-\d{2})\b", 1).alias("published"),
    )
    web = cards.where(F.col("url").rlike(r"^https?://[^/?#@]+([/?#]|$)"))
    return _newest(web, settings, known, now, True).select("source_id", "rank", "title", "url", "published")


def sitemap_items(entries: DataFrame, settings: DataFrame, known: DataFrame, now: str) -> DataFrame:
    """entries(source_id, page, pos, url, published) of sitemaps below the source's prefix, dated within the window, newest
    first; undated ones are left out. settings(source_id, url_prefix, window_days, max_items)."""
    rows = entries.join(settings.select("source_id", "url_prefix"), "source_id").where(F.startswith("url", "url_prefix"))
    kept = _newest(rows.drop("url_prefix"), settings.select("source_id", "window_days", "max_items"), known, now, False)
    return kept.select("source_id", "rank", "url", "published")


def latest_list(responses: DataFrame, day: str, filled: Column) -> DataFrame:
    """Of a source's responses for several days the latest that is `filled`: a day's list stands in for one not yet out."""
    latest = responses.where(filled).groupBy("source_id").agg(F.max(day).alias(day))
    return responses.join(latest, ["source_id", day], "left_semi")

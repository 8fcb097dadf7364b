"""Quotes with addresses: which of them hold, the ids they get, and how far the claims that rest on them are covered.

A document is cut into paragraphs(doc, pos, text). drafts(doc, map_no, at, local, pos, quote, kind) name a paragraph and quote
it; drafts of one `map_no` stand or fall together, `at` is their order, `local` their name within the map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.functions.text import verbatim_span

# Kinds of evidence that show something, those that allow a repetition, and those that need a digit or code.
CONCRETE = ["code", "config", "number", "comparison", "failure", "procedure"]
REPRODUCIBLE = ["code", "config", "procedure"]
NUMERIC = ["number", "comparison"]
CODE = ["code", "config"]

# Fixed value: the form of an evidence id.
EVIDENCE_ID = r"^([A-Za-z0-9][A-Za-z0-9_.-]{0,63})#(main|ref[1-9])/(p[1-9][0-9]{0,4})#([1-9][0-9]{0,2})$"


def evidence_id(doc: Column, pos: Column, ordinal: Column) -> Column:
    """The id of a main document's quote."""
    return F.concat(doc, F.lit("#main/p"), pos.cast("string"), F.lit("#"), ordinal.cast("string"))


def evidence_place(value: Column) -> Column:
    """An id as the struct (article, doc, paragraph, ordinal); null for any other text."""
    part = lambda n: F.regexp_extract(value, EVIDENCE_ID, n)
    return F.when(value.rlike(EVIDENCE_ID), F.struct(part(1).alias("article"), part(2).alias("doc"), part(3).alias("paragraph"), part(4).try_cast("int").alias("ordinal")))


def checked_kind(kind: Column, quote: Column, paragraph: Column) -> Column:
    """`kind`, or 'statement' where numbers have no digit, or code is neither a fenced paragraph nor one span of code."""
    bare = kind.isin(NUMERIC) & ~quote.rlike(r"\p{Nd}")
    prose = kind.isin(CODE) & ~(paragraph.startswith("```") | quote.rlike(r"^\s*`[^`]+`\s*$"))
    return F.when(bare | prose, "statement").otherwise(kind)


def checked_quotes(drafts: DataFrame, documents: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """`drafts` with `problem` (null: the quote holds), `kind` as checked, and `span`, the paragraph's own spelling.

    documents(doc): those that exist. Problems, the first that applies: duplicate_local_id, unknown_document,
    unknown_paragraph, quote_not_in_paragraph. A null or blank quote is in no paragraph. Equal quotes of one paragraph are
    looked up once, so a paragraph may be quoted by any number of drafts.
    """
    first = drafts.groupBy("map_no", "local").agg(F.min("at").alias("first"))
    known = documents.select("doc").distinct().withColumn("known", F.lit(True))
    asked = drafts.select("doc", "pos", "quote").distinct()
    looked = asked.join(known, "doc", "left").join(paragraphs.select("doc", "pos", F.col("text")), ["doc", "pos"], "left")
    looked = looked.withColumn("span", verbatim_span(F.col("quote"), F.col("text")))
    keys = ["doc", "pos", "quote"]
    joined = drafts.alias("d").join(looked.alias("l"), [F.col(f"d.{k}").eqNullSafe(F.col(f"l.{k}")) for k in keys], "left").select("d.*", "l.known", "l.text", "l.span")
    joined = joined.alias("d").join(first.alias("f"), [F.col(f"d.{k}").eqNullSafe(F.col(f"f.{k}")) for k in ("map_no", "local")]).select("d.*", "f.first")
    problem = (
        F.when(F.col("at") > F.col("first"), "duplicate_local_id").when(F.col("known").isNull(), "unknown_document")
        .when(F.col("text").isNull(), "unknown_paragraph").when(F.col("span").isNull(), "quote_not_in_paragraph")
    )
    return joined.select(*[c for c in drafts.columns if c != "kind"], checked_kind(F.col("kind"), F.col("quote"), F.col("text")).alias("kind"), "span", problem.alias("problem"))


def accepted_quotes(checked: DataFrame) -> DataFrame:
    """The drafts of the maps without a problem."""
    return checked.join(checked.where("problem is not null").select("map_no").distinct(), "map_no", "left_anti")


def numbered_quotes(accepted: DataFrame) -> DataFrame:
    """(doc, pos, quote, first, ordinal, evidence_id, kind, span): each different quote of a paragraph, numbered by its first
    draft, whose kind and spelling it has; blanks make no difference.

    Drafts of one quote collapse before the numbering; what is numbered is bounded by a paragraph's different quotes.
    """
    quote = F.trim(F.regexp_replace("span", r"\s+", " "))
    each = accepted.groupBy("doc", "pos", quote.alias("quote")).agg(F.min("at").alias("first"), F.min_by(F.struct("kind", "span"), "at").alias("row"))
    ordinal = F.row_number().over(Window.partitionBy("doc", "pos").orderBy("first", "quote"))
    numbered = each.withColumn("ordinal", ordinal)
    return numbered.select("doc", "pos", "quote", "first", "ordinal", evidence_id(F.col("doc"), F.col("pos"), F.col("ordinal")).alias("evidence_id"), "row.*")


def latest_claims(claims: DataFrame) -> DataFrame:
    """claims(doc, claim_id, at, …): of several with one id the latest in `at`; `first` is the place the claim keeps."""
    rest = [c for c in claims.columns if c not in ("doc", "claim_id")]
    return claims.groupBy("doc", "claim_id").agg(F.max_by(F.struct(*rest), "at").alias("row"), F.min("at").alias("first")).select("doc", "claim_id", "row.*", "first")


def assessed(articles: DataFrame, claims: DataFrame) -> DataFrame:
    """(doc, status, unmet) of articles(doc, author) by their claims(doc, claim_id, first, kind, kinds, numeric, conditions,
    reproducible): `kinds` are those of the cited evidence, `conditions` the number of quotes that state conditions.

    insufficient: no claim says what happened, or no concrete evidence is cited; partial: an unknown author, a number
    without conditions, or a repeatable result without code or procedure; else complete. `unmet` lists these in order, claims
    by their places. An article without claims is insufficient.
    """
    lacks = F.array_compact(F.array(
        F.when(F.col("numeric") & (F.col("conditions") == 0), F.concat(F.lit("conditions:"), "claim_id")),
        F.when(F.col("reproducible") & ~F.arrays_overlap("kinds", F.array(*map(F.lit, REPRODUCIBLE))), F.concat(F.lit("reproduction:"), "claim_id")),
    ))
    each = claims.select("doc", "first", "claim_id", lacks.alias("lacks"), (F.col("kind") == "what_happened").alias("told"), F.arrays_overlap("kinds", F.array(*map(F.lit, CONCRETE))).alias("shown"))
    # Claims of an article that lack nothing aren't gathered.
    short = F.array_sort(F.collect_list(F.when(F.size("lacks") > 0, F.struct("first", "claim_id", "lacks"))))
    by_doc = each.groupBy("doc").agg(F.bool_or("told").alias("told"), F.bool_or("shown").alias("shown"), short.alias("short"))
    core = F.array_compact(F.array(F.when(~F.coalesce("told", F.lit(False)), "what_happened"), F.when(~F.coalesce("shown", F.lit(False)), "concrete_evidence")))
    own = F.array_compact(F.array(F.when(F.col("author").isNull(), "author")))
    claimed = F.coalesce(F.flatten(F.transform("short", lambda s: s["lacks"])), F.array().cast("array<string>"))
    out = articles.join(by_doc, "doc", "left").select("doc", core.alias("core"), F.concat(own, claimed).alias("other"))
    status = F.when(F.size("core") > 0, "insufficient").when(F.size("other") > 0, "partial").otherwise("complete")
    return out.select("doc", status.alias("status"), F.array_join(F.concat("core", "other"), ",").alias("unmet"))


def excerpt_states(items: Column, most: int) -> Column:
    """For an array of (key, chars), in order: shown, repeated, missing (null chars) or omitted where `most` characters would
    be exceeded; later smaller ones may still be shown. A key is looked at once."""
    start = F.struct(F.lit(0).cast("long").alias("used"), F.array().cast("array<string>").alias("seen"), F.array().cast("array<string>").alias("states"))

    def step(state, item):
        used = state["used"] + item["chars"].cast("long")
        repeated = F.array_contains(state["seen"], item["key"])
        verdict = F.when(repeated, "repeated").when(item["chars"].isNull(), "missing").when(used > most, "omitted").otherwise("shown")
        return F.struct(
            F.when(verdict == "shown", used).otherwise(state["used"]).alias("used"), F.array_append(state["seen"], item["key"]).alias("seen"), F.array_append(state["states"], verdict).alias("states")
        )

    return F.aggregate(items, start, step, lambda s: s["states"])

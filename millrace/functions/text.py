"""Text as columns; what Spark has no function for runs in Arrow batches."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.urls import INVISIBLE

SPACES = r"[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def visible(value: Column) -> Column:
    """`value` without zero-width characters, byte-order marks and soft hyphens."""
    return F.translate(value, INVISIBLE, "")


def is_blank(value: Column) -> Column:
    """Null, empty, or nothing but blanks and invisible characters."""
    return F.coalesce(~visible(value).rlike(rf"[^{SPACES[1:]}"), F.lit(True))


@F.pandas_udf(T.StringType())
def composed(values: pd.Series) -> pd.Series:
    """Unicode composition (NFC)."""
    return values.map(lambda v: v if v is None or v.isascii() else unicodedata.normalize("NFC", v))


def collapsed(value: Column) -> Column:
    """Composed, without invisible characters, every run of blanks one space, trimmed."""
    return F.trim(F.regexp_replace(visible(composed(value)), rf"{SPACES}+", " "))


def blocks(value: Column) -> Column:
    """Line ends unified, lines trimmed at their right, blank lines at both ends dropped."""
    lines = F.transform(F.split(F.regexp_replace(value, r"\r\n?", "\n"), "\n"), lambda x: F.regexp_replace(x, rf"{SPACES}+$", ""))
    return F.regexp_replace(F.array_join(lines, "\n"), r"^\n+|\n+$", "")


@F.pandas_udf(T.StringType())
def unescaped(values: pd.Series) -> pd.Series:
    """HTML entities as characters."""
    return values.map(lambda v: html.unescape(v) if v and "&" in v else v)


def stripped_markup(value: Column, most: int = 400) -> Column:
    """Tags become blanks, entities characters, blanks one space; at most `most` characters; empty becomes null."""
    plain = F.trim(F.regexp_replace(unescaped(F.regexp_replace(value, "<[^>]+>", " ")), rf"{SPACES}+", " "))
    return F.nullif(F.substring(plain, 1, most), F.lit(""))


def content_hash(value: Column) -> Column:
    """SHA-256 of the text, in hex."""
    return F.sha2(value, 256)


def article_id(source: Column, identity: Column) -> Column:
    """32 hex digits of the SHA-256 of source and identity on two lines."""
    return F.substring(F.sha2(F.concat_ws("\n", source, identity), 256), 1, 32)


def plain_field(value: Column) -> Column:
    """A raw field without outer blanks; empty becomes null."""
    return F.nullif(F.regexp_replace(value, rf"^{SPACES}+|{SPACES}+$", ""), F.lit(""))


# What begins and ends an untrusted text, and how its own text may not be spelt.
UNTRUSTED, NEUTRAL = "UNTRUSTED_ARTICLE_BODY", "UNTRUSTED-ARTICLE-BODY"


def untrusted_block(fields: dict[str, Column], body: Column) -> Column:
    """Named fields on lines ("-" for null) and the body between delimiters that neither can contain."""
    safe = lambda c: F.replace(F.coalesce(c, F.lit("-")), F.lit(UNTRUSTED), F.lit(NEUTRAL))
    lines = [F.concat(F.lit(f"{name}: "), safe(c)) for name, c in fields.items()]
    return F.concat_ws("\n", F.lit(f"<<<{UNTRUSTED}>>>"), *lines, F.lit("body:"), safe(body), F.lit(f"<<<END_{UNTRUSTED}>>>"))


# Words that say nothing about a story.
STOP_WORDS = ["a", "an", "the", "of", "to", "in", "on", "for", "and", "with", "how", "we", "is", "our", "your"]


@F.pandas_udf(T.StringType())
def compatible(values: pd.Series) -> pd.Series:
    """Unicode compatibility composition (NFKC)."""
    return values.map(lambda v: v if v is None or v.isascii() else unicodedata.normalize("NFKC", v))


def title_words(title: Column) -> Column:
    """The distinct words of a title in compatible form and lower case: ASCII letters and digits, or runs of kana and kanji;
    no stop words."""
    words = F.regexp_extract_all(F.lower(compatible(title)), F.lit("([0-9a-z]+|[\\x{3040}-\\x{30FF}\\x{4E00}-\\x{9FFF}]+)"), F.lit(1))
    return F.array_except(F.array_distinct(words), F.array(*map(F.lit, STOP_WORDS)))


# Shapes of secrets, each replaced as a whole. Keys and token settings of any vendor count, not of one alone.
SECRETS = [
    r"sk-[a-z]+-[A-Za-z0-9_-]{8,}", r"\b(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{20,}", r"\bgithub_pat_[A-Za-z0-9_]{20,}", r"(?i)\bbearer\s+[A-Za-z0-9._~+/=-]{16,}",
    r"\b[A-Z_]*OAUTH_TOKEN\s*=\s*\S+", r"https?://[^/\s@:]+:[^/\s]*@",
]


def redacted(value: Column, most: int = 500) -> Column:
    """Secrets replaced, on one line, at most `most` characters."""
    for shape in SECRETS:
        value = F.regexp_replace(value, shape, "<redacted>")
    return F.substring(F.trim(F.regexp_replace(value, r"\s+", " ")), 1, most)


def markdown_inline(value: Column) -> Column:
    """Text on one line, so that it can't change the document's structure."""
    return F.trim(F.regexp_replace(value, r"\s+", " "))


def markdown_link(label: Column, url: Column) -> Column:
    """A link; brackets and backslashes of the label are escaped, a target with brackets or blanks is enclosed."""
    target = F.when(url.rlike("[()<> ]"), F.concat(F.lit("<"), F.replace(F.replace(url, F.lit("<"), F.lit("%3C")), F.lit(">"), F.lit("%3E")), F.lit(">"))).otherwise(url)
    return F.concat(F.lit("["), F.regexp_replace(markdown_inline(label), r"([\\\[\]])", r"\\$1"), F.lit("]("), target, F.lit(")"))


def verbatim_span(quote: Column, paragraph: Column, longest: int = 300) -> Column:
    """The part of `paragraph` that is `quote` up to blanks; the collapsed quote where that part is longer than `longest`;
    null where there is none."""
    words = F.filter(F.split(F.trim(quote), r"\s+"), lambda w: w != "")
    pattern = F.concat(F.lit("("), F.array_join(F.transform(words, lambda w: F.concat(F.lit("\\Q"), F.replace(w, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))), "\\s+"), F.lit(")"))
    span = F.nullif(F.call_function("regexp_extract", paragraph, pattern, F.lit(1)), F.lit(""))
    return F.when(F.size(words) > 0, F.when(F.length(span) > longest, F.array_join(words, " ")).otherwise(span))


#: Blocks between blank lines. A fence that begins a block reaches to the next block end with a fence, or to the end.
_BLOCK = re.compile(r"(?:\n\n)?(```(?:`{1,2}|.*?```)\s*?(?=\n\n|\Z)|```.*|.*?(?=\n\n|\Z))", re.S)
_HEADING = re.compile(r"#{1,6} (?=.*\S).*")


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("section", T.StringType()), T.StructField("text", T.StringType())])))
def paragraphs(values: pd.Series) -> pd.Series:
    """Blocks between blank lines in order, fenced code in one piece; `section` is the latest heading, its own included."""

    def cut(text):
        out, section = [], None
        for block in map(str.strip, _BLOCK.findall(text or "")):
            if _HEADING.fullmatch(block):
                section = block.lstrip("#").strip() or section
            if block:
                out.append({"pos": len(out) + 1, "section": section, "text": block})
        return out

    return values.map(cut)


# Rules for traces of machine-written prose: dashes, decorative emoji, statements without a speaker, empty
# praise, hype, and contrasts made by rote.
FORBIDDEN = {
    "fullwidth_dash": "[–—―⸺⸻︱︲﹘－]+",
    "decorative_emoji": "[‼⁉☀-✒✕✖✙-➿⬀-⯿〰〽\ufe0f\U0001f000-\U0001f02f\U0001f0a0-\U0001f0ff\U0001f100-\U0001f1ff\U0001f300-\U0001faff]+",
    "absent_subject": "と(?:言われて|いわれて|されて|考えられて|見られて|みられて)(?:いる|いた|います)|(?:注目|期待)されて(?:いる|います)|(?:話題|議論)(?:を呼んで|になって)(?:いる|います)",
    "abstract_praise": "画期的|革新的|圧倒的|驚異的|素晴らし|目覚ましい|注目に値する|他ならな|まさに|極めて重要",
    "hype": "必見|見逃せな|衝撃|激変|一変させ|驚くべき|革命的|ゲームチェンジャー|[Gg]ame[ -][Cc]hanger",
    "mechanical_contrast": "ではなく[、,].{0,30}?(?:である|だ)[。.]|単なる.{0,20}?ではな",
}
_FORBIDDEN = {rule: re.compile(pattern) for rule, pattern in FORBIDDEN.items()}
_ANY_FORBIDDEN = re.compile("|".join(FORBIDDEN.values()))


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("rule", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("matched", T.StringType())])))
def forbidden(values: pd.Series) -> pd.Series:
    """Every match of a rule, by place and rule; `start` counts characters from 0, at most 40 are shown. Null: none."""

    def traces(text):
        if not text or text.isascii() and "ame" not in text or not _ANY_FORBIDDEN.search(text):
            return []
        found = sorted((m.start(), rule, m[0][:40]) for rule, pattern in _FORBIDDEN.items() for m in pattern.finditer(text))
        return [{"rule": rule, "start": at, "matched": shown} for at, rule, shown in found]

    return values.map(traces)

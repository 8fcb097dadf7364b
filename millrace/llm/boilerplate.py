"""Problem 5: lines of web pages outside their main body.

Pages are paired with their nearest neighbours by URL path within each host. The pairs' lines are aligned by longest
common subsequence, digits and other changing parts (a breadcrumb's end, a teaser's headline, tags) masked; lines that
differing pages share are the site's. A line must be shared by several pages, and lines that most hosts have (common
headings, lone braces) are no site's own. What is found on one host holds on every page, as copies of a page carry its
chrome to other addresses. Headlines of other articles are never shared: they are deleted where they directly follow
a line that on its host is mostly followed by such headlines ("Read next").

Texts are read once; after that only line hashes move. Pages are sorted by range over (host, path), so a large host is
spread over many tasks. Lines met again in a task (a site's chrome) are not masked again.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.urls import canonical_url
from millrace.llm.words import WORD, SmallHashes
from millrace.tables import stored

#: Neighbours on each side that a page is compared with.
NEIGHBOURS = 4
#: A pair that shares more of the longer page's lines than this are copies and tell nothing.
COPY = 0.55
#: Pages of a host that must share a line, at least and as a share of the host's pages.
PAGES, PAGE_SHARE = 3, 0.002
#: A line spread evenly over more than this part of the hosts (and more than HOSTS of them) belongs to no site.
HOST_SHARE, HOSTS = 0.36, 6
#: A host counts fully if it has more pages than this part of a typical page's host, and hardly if it has fewer.
SMALL_HOST = 0.1

#: Lines a worker remembers; beyond that it starts anew, which bounds its memory.
MEMO = 50_000
#: Words that a sentence needs to be a unit of its own (see `page_lines`).
UNIT = 4

_ADDRESS = re.compile(r"\s*[a-z][a-z0-9+.-]*://([^/?#\s]*)(.*)", re.S)
_DIGITS = re.compile(r"\d+")
#: Characters that only spell a line differently.
_SPELLING = str.maketrans({**dict.fromkeys("​‌‍⁠﻿­"), "’": "'", "‘": "'", "“": '"', "”": '"'})
_SPELT = re.compile("[" + "".join(map(chr, _SPELLING)) + "]")
# Weekdays, which change in a site's lines as numbers do.
_WEEKDAYS = re.compile(
    r"\b(?:(?:Mon|Tues|Wednes|Thurs|Fri|Satur|Sun)day|Montag|Dienstag|Mittwoch|Donnerstag|Freitag|Samstag|Sonntag|lundi|mardi|mercredi|jeudi|vendredi|samedi|dimanche"
    r"|lunes|martes|miércoles|jueves|viernes|sábado|domingo)\b|[月火水木金土日]曜日?"
)
#: Masks of lines that are nothing but changing parts; any number of hosts may have them.
TAGS, MINUTES, DATED = "#", "* 0 min", "0.0.0 *"
_CRUMB = re.compile(r"^(.*(?:›|»|→|::)\s*)[^›»→]*$")
_MINUTES = re.compile(r"^.{3,}[·|—–-]\s*0\s?(?:min|minutes?|Min\.?|分)\b.{0,12}$")
_DATED = re.compile(r"^(?:[-*•]\s+)?(?:0\.0\.0|0/0/0|0-0-0|0年0月0日)\s+\S.{2,}[^.!?。！？]$")
_TAGS = re.compile(r"^#[^\W_]\w*(?:\s+#[^\W_]\w*)*$")
#: The first sentence, and the first two, of a line that goes on: sites join their notices in one line.
_FIRST = re.compile(r"^((.{6,}?[.!?。！？])(?:\s+.{6,}?[.!?。！？])?)\s+\S")
_SENTENCE_END = re.compile(r"[.!?]\s+|[。！？]")
_WORD_OR_END, _ASCII_WORD_OR_END = re.compile(f"{WORD.pattern}|\0"), re.compile("[a-z0-9]+|\0")
_LEAD = re.compile(r"^(?:[-*•]\s+)?(?:\d{1,2}[./]\d{1,2}[./]\d{4}\s+)?")
_CODE = re.compile(r"[={}<>\[\]]|\(\)|^[>$#|\"'`/]|^\s|^(?:def|return|import|class|for|if)\b|: ok\b")
_NO_HEADLINE_END = frozenset(".!?。！？,;:{}()[]\"`|")


def masked(line: str) -> str:
    """`line` without what changes from page to page."""
    if not line.isascii() and _SPELT.search(line):
        line = line.translate(_SPELLING)
    text = _DIGITS.sub("0", " ".join(line.split()))
    if text[:1] == "#" and _TAGS.match(text):
        return TAGS
    if "0" in text:
        if ("min" in text or "Min" in text or "分" in text) and _MINUTES.match(text):
            return MINUTES
        if _DATED.match(text):
            return DATED
    # Parts that every line with a weekday has one of: looking for these is cheaper.
    if "day" in text or "tag" in text or "woch" in text or "曜" in text or "edi" in text or "undi" in text or "ardi" in text or "eudi" in text or "manche" in text or "lunes" in text \
            or "martes" in text or "coles" in text or "jueves" in text or "viernes" in text or "bado" in text or "mingo" in text:
        text = _WEEKDAYS.sub("0", text)
    if any(c in text for c in ("›", "»", "→", "::")) and (crumb := _CRUMB.match(text)):
        return crumb[1] + "*"
    return text


def headline(line: str) -> bool:
    """Whether `line` could be the headline of another article."""
    text = line.strip()
    if text[-1:] in _NO_HEADLINE_END:
        return False
    text = _LEAD.sub("", text)
    return len(text) > 4 and not _CODE.search(text)


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def host_and_path(url: str | None) -> tuple[str, str]:
    """Of the canonical URL, so that spellings of a host are one; of `url` itself where it has none."""
    address = _ADDRESS.match((canonical_url(url)[0] or url or "").lower())
    return (address[1], address[2]) if address else ("", "")


class _Lines(dict):
    """What is known of a line: masked hashes, whether it could be a headline, and (`words`) its words and sentences."""

    def __init__(self, words: bool):
        super().__init__()
        self.words, self.hashes = words, SmallHashes()

    def __missing__(self, line: str) -> tuple:
        text = masked(line)
        first = _FIRST.match(text)
        value = (_hash(text), _hash(first[2]) if first else 0, _hash(first[1]) if first else 0, headline(line))
        if self.words:
            value += self._sentences(line.lower())
        self[line] = value
        return value

    def _sentences(self, line: str) -> tuple:
        """(words as bytes, their number, unit hashes, words of each unit)"""
        # A zero, which is no word's hash, stands where a sentence ends.
        words = (_ASCII_WORD_OR_END if line.isascii() else _WORD_OR_END).findall(_SENTENCE_END.sub("\0", line) + "\0")
        sentences = array("i", map(self.hashes.__getitem__, words))
        hashes, units, weights, at = b"", [], [], 0
        while at < len(sentences):
            end = sentences.index(0, at)
            words = sentences[at:end].tobytes()
            hashes += words
            if end - at >= UNIT:
                units.append(xxhash.xxh3_64_intdigest(words) - (1 << 63))
                weights.append(end - at)
            at = end + 1
        return hashes, len(hashes) // 4, units, weights

    def trim(self) -> None:
        self.hashes.trim()
        if len(self) > MEMO:
            self.clear()


def _page_lines(words: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = _Lines(words)
        for batch in batches:
            numbers, found, hashes, offsets, packed = [], [], [], [0], []
            places = [host_and_path(u) for u in batch.column(1).to_pylist()]
            for body in batch.column(2).to_pylist():
                own = len(found)
                for no, line in enumerate((body or "").split("\n"), 1):
                    if line and not line.isspace():
                        numbers.append(no)
                        found.append(lines[line])
                offsets.append(len(numbers))
                hashes.append(_hash(body or ""))
                if words:
                    packed.append(_packed(found[own:]))
                lines.trim()
            offsets = pa.array(offsets, pa.int32())
            kinds = (numbers, pa.int32()), ([f[0] for f in found], pa.int64()), ([f[1] for f in found], pa.int64()), ([f[2] for f in found], pa.int64()), ([f[3] for f in found], pa.bool_())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, t)) for v, t in kinds]
            host, path = (pa.array([p[k] for p in places], pa.string()) for k in range(2))
            extra = [pa.array([p[k] for p in packed], pa.binary()) for k in range(len(_PACKED))] if words else []
            yield pa.RecordBatch.from_arrays([batch.column(0), host, path, pa.array(hashes, pa.int64()), *lists, *extra],
                                             names=["page", "host", "path", "body_hash", "line_nos", "keys", "firsts", "seconds", "headlines", *(_PACKED if words else [])])

    return read


#: Columns of `page_lines` that only Python reads: numbers as bytes, which Spark neither decodes nor copies one by one.
_PACKED = ["line_words", "words", "unit_lines", "units", "weights"]


def _packed(lines: list[tuple]) -> tuple:
    """The numbers of words of a page's lines (int32), their words (int32), and each unit's line (int32, from 0), hash
    (int64) and number of words (int32)."""
    counts = np.array([f[5] for f in lines], np.int32)
    owners = np.repeat(np.arange(len(lines), dtype=np.int32), [len(f[6]) for f in lines])
    units, weights = np.array([u for f in lines for u in f[6]], np.int64), np.array([w for f in lines for w in f[7]], np.int32)
    return counts.tobytes(), b"".join([f[4] for f in lines]), owners.tobytes(), units.tobytes(), weights.tobytes()


def page_lines(pages: DataFrame, page: str = "article_no", url: str = "canonical_url", body: str = "body_text", words: bool = False) -> DataFrame:
    """(page, host, path, body_hash, line_nos, keys, firsts, seconds, headlines): the non-blank lines of every page as hashes.

    Lines are split at line feeds and numbered from 1. A page without a readable host has the host ''. With `words` the
    columns of _PACKED follow: the words of all lines, and their sentences of at least UNIT words.
    """
    rows = pages.select(F.col(page).alias("page"), F.col(url).cast("string").alias("url"), F.col(body).cast("string").alias("body"))
    kind = rows.schema["page"].dataType.simpleString()
    schema = f"page {kind}, host string, path string, body_hash bigint, line_nos array<int>, keys array<bigint>, firsts array<bigint>, seconds array<bigint>, headlines array<boolean>"
    return rows.mapInArrow(_page_lines(words), schema + "".join(f", {c} binary" for c in _PACKED) if words else schema)


def common_lines(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """A longest common subsequence of two lists as pairs of places.

    Common ends are set aside. What is left is chained from its matches where they are few; pages of often repeated
    lines have too many of them and are halved by the lengths of bit-parallel rows instead.
    """
    low, n, m = 0, len(a), len(b)
    while low < min(n, m) and a[low] == b[low]:
        low += 1
    while n > low and m > low and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    head, tail = [(i, i) for i in range(low)], [(n + k, m + k) for k in range(len(a) - n)]
    in_a, in_b = Counter(a[low:n]), Counter(b[low:m])
    matches = sum(c * in_b[key] for key, c in in_a.items() if key in in_b)
    middle = _chained if matches <= 64 * (n + m) else _halved
    return head + [(i + low, j + low) for i, j in middle(a[low:n], b[low:m])] + tail


def _chained(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """The longest increasing chain of the matches of `a` and `b`."""
    places: dict[int, list[int]] = {}
    for j, key in enumerate(b):
        places.setdefault(key, []).append(j)
    tails, chain = [], []  # the last place in b of the best chain of each length, and its link
    for i, key in enumerate(a):
        for j in reversed(places.get(key, ())):
            k = bisect_left(tails, j)
            link = (i, j, chain[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                chain.append(link)
            else:
                tails[k], chain[k] = j, link
    out, link = [], chain[-1] if chain else None
    while link:
        out.append(link[:2])
        link = link[2]
    return out[::-1]


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """The length of the longest common subsequence of `a` with each beginning of `b`: a row of the table kept as the bits
    of one number, a set bit where the length doesn't grow."""
    masks: dict[int, int] = {}
    for j, key in enumerate(b):
        masks[key] = masks.get(key, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for key in a:
        both = row & masks.get(key, 0)
        row = (row + both | row - both) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def _halved(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """A longest common subsequence by halving `a` and cutting `b` where the halves' lengths are greatest together."""
    if not a or not b:
        return []
    if len(a) == 1:
        return [(0, b.index(a[0]))] if a[0] in b else []
    half = len(a) // 2
    cut = int((_lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]).argmax())
    return _halved(a[:half], b[:cut]) + [(i + half, j + cut) for i, j in _halved(a[half:], b[cut:])]


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (host, path). For each (host, key): pages that share it, and those where a headline follows."""
    votes, follows, pages = Counter(), Counter(), Counter()
    window: list[tuple] = []

    def leave(page: tuple) -> None:
        host, numbers, keys, heads, shared = page
        for key in {keys[i] for i in shared}:
            votes[host, key] += 1
        counted = set()
        for i in shared:
            if i + 1 < len(keys) and i + 1 not in shared and numbers[i + 1] == numbers[i] + 1 and heads[i + 1] and keys[i] not in counted:
                counted.add(keys[i])
                follows[host, keys[i]] += 1

    for batch in batches:
        for host, numbers, keys, heads in zip(*(batch.column(k).to_pylist() for k in range(4))):
            pages[host] += 1
            page = (host, numbers, keys, heads, set())
            for other in window:
                if other[0] == host:
                    both = common_lines(other[2], keys)
                    if len(both) <= COPY * max(len(keys), len(other[2])):
                        other[4].update(i for i, _ in both)
                        page[4].update(j for _, j in both)
            window.append(page)
            if len(window) > NEIGHBOURS:
                leave(window.pop(0))
    for page in window:
        leave(page)
    keys = [*votes, *((h, 0) for h in pages)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([h for h, _ in keys], pa.string()), pa.array([k or None for _, k in keys], pa.int64()), pa.array([votes[k] if k[1] else pages[k[0]] for k in keys], pa.int64()),
         pa.array([follows[k] for k in keys], pa.int64())],
        names=["host", "key", "votes", "follows"],
    )


def site_lines(lines: DataFrame) -> DataFrame:
    """(key, header): masked lines that some site has as chrome; `header`: mostly followed by headlines of other articles."""
    distinct = lines.groupBy("host", "body_hash").agg(F.min(F.struct("path", "line_nos", "keys", "headlines")).alias("p")).select("host", "p.*")
    ordered = distinct.repartitionByRange("host", "path").sortWithinPartitions("host", "path").select("host", "line_nos", "keys", "headlines")
    votes = ordered.mapInArrow(_votes, "host string, key bigint, votes bigint, follows bigint")
    votes = stored(votes.groupBy("host", "key").agg(F.sum("votes").alias("votes"), F.sum("follows").alias("follows")))
    pages = votes.where("key is null").select("host", F.col("votes").alias("pages"))
    enough = F.col("votes") >= F.greatest(F.lit(PAGES), F.col("pages") * PAGE_SHARE)
    shared = votes.where("key is not null").join(pages, "host").groupBy("key").agg(F.max(enough).alias("enough"), F.sum("votes").alias("votes"), F.sum("follows").alias("follows"))
    shared = stored(shared.where("enough"))
    # How evenly the hosts have the line, counted over all pages: the effective number of hosts behind its rates, beside
    # that of a line on every page. Hosts weigh less the fewer pages they have; with fewer than PAGES they have no lines
    # of their own and no weight.
    found = lines.select("host", F.explode(F.array_distinct("keys")).alias("key")).join(shared.select("key"), "key", "left_semi").groupBy("host", "key").agg(F.count("*").alias("n"))
    sizes = stored(lines.groupBy("host").agg(F.count("*").alias("all")).where(F.col("all") >= PAGES))
    typical = sizes.agg((F.sum(F.col("all") * F.col("all")) / F.sum("all") * SMALL_HOST).alias("small")).withColumn("one", F.lit(1))
    weights = sizes.withColumn("one", F.lit(1)).join(typical, "one").select("host", "all", (1 / (1 + (F.col("small") / F.col("all")) ** 2)).alias("weight"))
    effective = lambda rate: F.sum(rate) ** 2 / F.sum(rate**2)
    hosts = weights.agg(effective(F.col("weight")).alias("hosts")).withColumn("one", F.lit(1))
    spread = found.join(weights, "host").groupBy("key").agg(effective(F.col("n") / F.col("all") * F.col("weight")).alias("spread"))
    own = shared.join(spread, "key").withColumn("one", F.lit(1)).join(hosts, "one")
    own = own.where((F.col("spread") <= F.greatest(F.lit(HOSTS), F.col("hosts") * HOST_SHARE)) | F.col("key").isin([_hash(m) for m in (TAGS, MINUTES, DATED)]))
    return own.select("key", (F.col("follows") * 2 > F.col("votes")).alias("header"))


def chrome_lines(pages: DataFrame, page: str = "article_no", url: str = "canonical_url", body: str = "body_text") -> DataFrame:
    """(page, line_no) of every non-blank line outside the main body.

    Null, empty and blank bodies have no lines; repeated rows of one page number give its lines once; a page whose URL
    has no host is compared with the others of that kind; texts are read whole; an empty table gives no rows; other
    columns are ignored. Where two chains of shared lines are equally long, the one found first counts; a host with fewer
    than PAGES pages has no lines of its own.
    """
    lines = stored(page_lines(pages, page, url, body))
    return chrome_of(lines, stored(site_lines(lines))).select(F.col("page").alias(page), F.explode("chrome").alias("line_no"))


def chrome_of(lines: DataFrame, site: DataFrame) -> DataFrame:
    """(page, chrome): the numbers of the lines of a page (of `page_lines`) that the stored `site` lines make chrome."""
    each = lines.select("page", F.explode(F.arrays_zip("line_nos", "keys", "firsts", "seconds", "headlines")).alias("l")).select("page", "l.*")
    first, second = (site.select(F.col("key").alias(c), F.lit(True).alias(f"{c}_own")) for c in ("firsts", "seconds"))
    judged = each.join(site.withColumn("own", F.lit(True)), each["keys"] == site["key"], "left").join(first, "firsts", "left").join(second, "seconds", "left")
    judged = judged.select("page", F.col("line_nos").alias("line_no"), F.coalesce("own", "firsts_own", "seconds_own", F.lit(False)).alias("own"), F.coalesce("header", F.lit(False)).alias("header"), "headlines")
    judged = judged.where(F.col("own") | F.col("headlines"))
    # Headlines in a row (blank lines break it) are chrome if a header stands right before them.
    by_page = judged.groupBy("page").agg(F.collect_set(F.when(F.col("own"), F.col("line_no"))).alias("own"), F.collect_set(F.when(F.col("header"), F.col("line_no"))).alias("headers"),
                                         F.array_sort(F.collect_set(F.when(~F.col("own"), F.col("line_no")))).alias("heads"))
    run = F.aggregate("heads", F.struct(F.col("headers").alias("after"), F.array().cast("array<int>").alias("found")), lambda s, n: F.when(
        F.array_contains(s["after"], n - 1), F.struct(F.array_append(s["after"], n).alias("after"), F.array_append(s["found"], n).alias("found"))).otherwise(s))
    return by_page.select("page", F.array_union("own", run["found"]).alias("chrome"))

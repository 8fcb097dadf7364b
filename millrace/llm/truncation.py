"""Problem 1: values that were cut off on their way from the source.

Three kinds of evidence, all over whole tables:

1. Copies. A cut leaves a value's beginning as it is, so min-hash bands are taken over the five-word shingles of its
   opening windows (5, 20, 80, ... words), two bound to the window's first words and one to its last. A value is looked
   for under its own greatest window and found under all of them: near-copies meet however much of one is lost. It meets
   all texts of its buckets. In crowded ones it is sought by so many of its last shingles that a near-copy has one of
   them, which leaves out no pair. A verified pair (SIMILARITY of the shorter value's shingles are in the longer one's
   beginning) is aligned word by word, edits allowed, and where the alignment ends with the shorter value although the
   longer one goes on, the shorter is cut. Values too short for a window are sought as whole beginnings of others, all
   words but the last, of which only the different next words are kept.
2. Signs in the value itself: a broken character, tag or entity at its end, "Read more", "[...]".
3. Terminality of the closing word, for values without such evidence. Corpus counts tell how often a word stands inside
   a text and how often it closes one; their ratio, times the odds of a cut in the value's own class (source, field,
   ellipsis or not, length at a limit of the source), decides. A limit is a greatest length at which values pile up.

Text fields never leave the executors; shuffles carry hashes, lengths and closing words.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.llm.boilerplate import common_lines
from millrace.llm.words import SHINGLE, WORD, LowerHashes, WordHashes, band_keys, mixed
from millrace.tables import by_sorting, stored

#: Words of the smallest window, the factor between windows, bands of the others, and texts of a bucket that isn't crowded.
OPENING, WIDER, BANDS, PARTNERS, SIMILARITY = 5, 4, 3, 4, 0.8
#: A length is a limit of a source if at least this many values have it, and this many times as many as the lengths below.
PILE, PILE_RATIO = 8, 1.5
#: Lengths below a limit that a cut at a blank or word can leave.
MARGIN = 24

#: Share of cuts that a class without values is taken to have, and the values that this counts for.
SHARE, SHARE_WEIGHT = 0.2, 2.5

_TAG = re.compile(r"<[^<>]*>")
_BROKEN = re.compile(r"(?:�|<[^<>]*|&#?\w*)\s*$")
_MORE = re.compile(r"\s*(?:\[(?:…|\.{2,})\]|(?:…|\.{2,})?\s*(?:\(more\)|read more|continue reading|weiterlesen|lire la suite|leer más|続きを読む|阅读全文)\W*)\s*$", re.I)
_MORE_ENDS = ("more", "reading", "weiterlesen", "suite", "más", "続きを読む", "全文")
_ELLIPSIS = re.compile(r"\s*(?:…+|\.{2,})\s*$")
_STOPS = frozenset(".!?。！？؟।")
_TERMINAL = re.compile(r"[.!?。！？؟।][\"'»”’)\]）」』]*$")
#: Things that sources append to a finished text: reading time, tags, byline, link, emoji, code, list, name in brackets.
_APPENDIX = re.compile(
    r"(?:\s*\(\d+ ?(?:min|分|хв|мин)[^()]*\)|\s+(?:#\w+\s*)+|\s+[—–-]\s+\w[\w.'’-]*(?: \w[\w.'’-]*){0,3}|\s+https?://\S+|\s*[\U0001F000-\U0001FAFF☀-➿️‍]+"
    r"|\s*`[^`]+`)$"
)
#: What every match of _APPENDIX has in it: looking for these is cheaper.
_APPENDED = re.compile(r"[(#`\U0001F000-\U0001FAFF☀-➿️‍]|\s[—–-]\s|https?://")
_ITEM = re.compile(r"\s*(?:[-*•]|\d+[.)]) .+")
_WIDE = re.compile(r"[^\S\n]{2,}")
#: What begins an addition to a whole value rather than its lost rest: end of sentence, dash before a site's name, bracket.
_ADDED = re.compile(r"[.!?。！？|·(\[#–—-]")
_WORDS, _WORDS_PLAIN = re.compile(r"[^\W_]+(?:[.'’-][^\W_]+)*"), re.compile(r"\w+(?:[.'’-]\w+)*")
#: Ends of sentences, and what may stand before them.
_END, _CLOSERS = re.compile(r"[.!?。！？](?:(?<=[。！？])|(?![\w.]))"), ")]\"»”’"
_BLANKLESS = re.compile(r"[぀-ヿ㐀-䶿一-鿿豈-﫿]")


def plain(value: str) -> str:
    """Without markup, entities and outer blanks."""
    text = _TAG.sub(" ", value) if "<" in value else value
    text = html.unescape(text) if "&" in text else text
    return text.strip("​‌‍⁠﻿­ \t\r\n　\xa0")


def closing_key(word: str) -> str:
    """What stands for a closing word in counts: its last two characters in scripts without blanks, else itself."""
    return word[-2:] if _BLANKLESS.search(word[-1]) else word


def words_of(text: str) -> list[str]:
    """As _WORDS finds them; a text without underscores is read faster."""
    return _WORDS.findall(text) if "_" in text else _WORDS_PLAIN.findall(text)


def without_appendix(text: str) -> str:
    """`text` without what a source has appended to it: the lines of a list at its end, or one thing of _APPENDIX."""
    head, line_feed, last = text.rpartition("\n")
    if line_feed and _ITEM.match(last):
        while line_feed and (not last.strip() or _ITEM.match(last)):
            text = head
            head, line_feed, last = text.rpartition("\n")
        return text
    return _APPENDIX.sub("", text) if _APPENDED.search(text) else text


def dissect(value: str) -> tuple[str, str, str]:
    """(text without its sign, sign, closing word); signs: broken, more, ellipsis, terminal, none."""
    at = max(value.rfind("�"), value.rfind("<"), value.rfind("&"))
    if at >= 0 and (sign := _BROKEN.match(value, at)):
        return plain(value[: sign.start()]), "broken", ""
    text = plain(value)
    if "  " in text:
        text = _WIDE.sub(" ", text)
    # Endings that every text with such a sign has: looking for these is cheaper.
    if text[-1:] == "]" or ((text[-1:].isalnum() or text[-1:] in ")）") and text.rstrip(")）]").lower().endswith(_MORE_ENDS)):
        if _MORE.search(text):
            return _MORE.sub("", text), "more", ""
    sign = "none"
    if text.endswith(("…", "..")):
        text, sign = _ELLIPSIS.sub("", text), "ellipsis"
    elif text[-1:] in _STOPS or _TERMINAL.search(text, max(0, len(text) - 8)) or (_END.search(text) and _TERMINAL.search(without_appendix(text))):
        return text, "terminal", ""
    rest, words = text, []
    while rest and not words:
        *before, chunk = rest.rsplit(None, 1) or [""]
        words, rest = _WORDS.findall(chunk), before[0] if before else ""
    return text, sign, closing_key(words[-1]) if words else ""


def _values(items: DataFrame) -> DataFrame:
    """(item_no, source_id, field_name, value) of every value that isn't null or blank."""
    both = F.array(*[F.struct(F.lit(n).alias("field_name"), F.col(c).cast("string").alias("value")) for n, c in (("title", "title"), ("feed_summary", "feed_summary"))])
    rows = items.where("item_no is not null").select("item_no", "source_id", F.explode(both).alias("v")).select("item_no", "source_id", "v.*")
    return rows.where(r"value rlike '[^\\s\\p{Z}\\x{200B}-\\x{200D}\\x{2060}\\x{FEFF}\\x{AD}]'")


_FEATURES = "item_no {kind}, source_id string, field_name string, length int, sign string, word string, n_words int, text_hash bigint, keys array<bigint>, own int, begins array<struct<key: bigint, next: string, goes: boolean>>, finished boolean, n_inner bigint, n_closing bigint"
_BEGINS = pa.list_(pa.struct([("key", pa.int64()), ("next", pa.string()), ("goes", pa.bool_())]))


def _dissected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two kinds of rows from one reading: a value's features, and a batch's counts of closing keys (item_no null): times
    inside a text, and before the end of a sentence."""
    memo, lowered = WordHashes(), LowerHashes()
    for batch in batches:
        item, source, field, values = (batch.column(i) for i in range(4))
        names = ["item_no", "source_id", "field_name", "length", "sign", "word", "n_words", "text_hash", "keys", "own", "begins", "finished", "n_inner", "n_closing"]
        values = values.to_pylist()
        # All words of the texts with blanks; of those without, their words, pairs and which texts these are.
        spaced, characters, pairs, blankless, closing, final = [], [], [], [], [], Counter()
        signs, lasts, hashes, counts = [], [], [], []
        begun, next_, goes, ends_at, finished = [], [], [], [0], []
        for value in values:
            text, sign, word = dissect(value)
            words = words_of(text)
            parts = [part.rstrip(_CLOSERS) for part in _END.split(text)[:-1]]
            ends = [part.rsplit(None, 1)[-1].lstrip("([\"'«“‘—–-") for part in parts if part and not part.isspace()]
            if not text.isascii() and _BLANKLESS.search(text):
                # A run without blanks counts by pairs of characters, its end by the last pair.
                for w in words:
                    if _BLANKLESS.search(w):
                        pairs += [w[k : k + 2] for k in range(max(1, len(w) - 1))]
                    else:
                        pairs.append(w)
                ends = [closing_key(e) for e in ends if e]
                found = WORD.findall(text.lower())
                characters += found
                counts.append(len(found))
                blankless.append(True)
                first, most = WORD, 4 * OPENING
            else:
                spaced += words
                counts.append(len(words))
                blankless.append(False)
                first, most = _WORDS if "_" in text else _WORDS_PLAIN, OPENING
            _beginnings(text, first, most, counts[-1], begun, next_, goes)
            ends_at.append(len(begun))
            # A greatest window that leaves out the last word is what longer values are sought by.
            short = 1 < counts[-1] <= most
            finished.append(bool(_TERMINAL.search(text) or _TERMINAL.search(without_appendix(text))) if short else None)
            closing += ends
            if sign != "terminal" and words:
                final[word or closing_key(words[-1])] += 1
            signs.append(sign)
            lasts.append(word)
            hashes.append(xxhash.xxh3_64_intdigest(text.encode()))
        hashed = _hashed(counts, blankless, spaced, lowered, characters, memo)
        memo.trim()
        lowered.trim()
        total, closing = Counter(spaced), Counter(closing)
        total.update(pairs)
        n = len(values)
        # Scripts without blanks: four characters in a row are about a word.
        wide = [k for k, v in enumerate(values) if not v.isascii() and _BLANKLESS.search(v)]
        units = list(hashed)
        for k, four in zip(wide, _all_fours([hashed[k] for k in wide])):
            units[k] = four
        keys, own = _windows(units)
        none = pa.nulls(n, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                item, source, field, pa.array([len(v) for v in values], pa.int32()), pa.array(signs, pa.string()), pa.array(lasts, pa.string()),
                pa.array(counts, pa.int32()), pa.array(np.array(hashes, np.uint64).view(np.int64)),
                keys, own, pa.ListArray.from_arrays(pa.array(ends_at, pa.int32()), pa.StructArray.from_arrays([pa.array(begun, pa.int64()), pa.array(next_, pa.string()), pa.array(goes, pa.bool_())], fields=list(_BEGINS.value_type))),
                pa.array(finished, pa.bool_()), none, none,
            ], names=names)
        counted = list(total)
        m = len(counted)
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(m, item.type), pa.nulls(m, source.type), pa.nulls(m, field.type), pa.nulls(m, pa.int32()), pa.nulls(m, pa.string()), pa.array(counted, pa.string()), pa.nulls(m, pa.int32()),
                pa.nulls(m, pa.int64()), pa.nulls(m, pa.list_(pa.int64())), pa.nulls(m, pa.int32()), pa.nulls(m, _BEGINS), pa.nulls(m, pa.bool_()), pa.array([max(0, total[k] - closing[k] - final[k]) for k in counted], pa.int64()), pa.array([closing[k] for k in counted], pa.int64()),
            ], names=names)


def _beginnings(text: str, first: re.Pattern, most: int, count: int, keys: list[int], next_: list[str], goes: list[bool]) -> None:
    """Adds, for each of the first words (`first` finds them, `count` in all) but the first one, `most` at most: the hash of
    the words before it, the word, and whether the text goes on after it with more than an addition."""
    lower, before = text.lower(), ""
    for n, word in enumerate(islice(first.finditer(lower), most)):
        if n:
            keys.append(xxhash.xxh3_64_intdigest(before.encode()) - (1 << 63))
            next_.append(word.group())
            goes.append(n + 1 < count and not _ADDED.match(lower[word.end() : word.end() + 40].lstrip()))
        before += word.group() + " "


def _fours(characters: np.ndarray) -> np.ndarray:
    """One hash of every four characters, the last ones of which may be fewer."""
    padded = np.zeros(-(-len(characters) // 4) * 4, np.uint64)
    padded[: len(characters)] = characters
    total = padded[0::4]
    for k in range(1, 4):
        total = mixed(total) + padded[k::4]
    return mixed(total)


def _all_fours(texts: list[np.ndarray]) -> list[np.ndarray]:
    """`_fours` of each text, computed at once."""
    ends = np.cumsum([-(-len(t) // 4) for t in texts], dtype=np.int64)
    padded = np.zeros(4 * int(ends[-1]) if texts else 0, np.uint64)
    for t, end in zip(texts, ends):
        at = 4 * (end + -len(t) // 4)
        padded[at : at + len(t)] = t
    return np.split(_fours(padded), ends[:-1]) if texts else []


def _hashed(counts: list[int], blankless: list[bool], spaced: list[str], lowered: LowerHashes, characters: list[str], memo: WordHashes) -> list[np.ndarray]:
    """Each text's word hashes, `counts` of them, from the words of all texts with and without blanks."""
    sources = [np.fromiter(map(known.__getitem__, words), np.uint64, len(words)) for known, words in ((lowered, spaced), (memo, characters))]
    found, at = [], [0, 0]
    for count, kind in zip(counts, blankless):
        found.append(sources[kind][at[kind] : at[kind] + count])
        at[kind] += count
    return found


def _windows(texts: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """The band keys of each text's windows, smaller ones first, and the place (from 1) where those of the greatest window
    begin that leaves out the last word, which a cut may have broken; 0 if there is no such window."""
    sizes = np.array([len(t) for t in texts], np.int64)
    owners, keys, own, size, place = [], [], np.zeros(len(texts), np.int32), OPENING, 1
    while (inside := np.flatnonzero(sizes >= size)).size:
        found = band_keys([texts[k][:size] for k in inside], 1 if size == OPENING else BANDS, 1) ^ size
        if size > OPENING:
            # Shingles are often shared by texts that differ; with the words at one end of the window they hardly are.
            first, last = (np.array([texts[k][at : at + OPENING].sum() for k in inside], np.uint64).view(np.int64) for at in (0, size - OPENING))
            found ^= np.column_stack([*[first] * (BANDS - 1), last])
        owners.append(np.repeat(inside, found.shape[1]))
        keys.append(found.ravel())
        # A text of exactly this many words is found under the window, but looks under the one before.
        own[inside[sizes[inside] > size]] = place
        place += found.shape[1]
        size *= WIDER
    if not keys:
        return pa.ListArray.from_arrays(np.zeros(len(texts) + 1, np.int32), pa.array([], pa.int64())), pa.array(own)
    owners, keys = np.concatenate(owners), np.concatenate(keys)
    order = np.argsort(owners, kind="stable")
    ends = np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=len(texts))))).astype(np.int32)
    return pa.ListArray.from_arrays(ends, keys[order]), pa.array(own)


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_no, source_id, field_name, cut) of the pairs that are near-copies."""
    for batch in batches:
        cut = pa.array([ends_early(short, long) for short, long in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())], pa.bool_())
        mask = cut.is_valid()
        yield pa.RecordBatch.from_arrays([*(batch.column(k).filter(mask) for k in range(3)), cut.filter(mask)], names=["item_no", "source_id", "field_name", "cut"])


@lru_cache(2048)
def _plain_words(value: str) -> list[str]:
    """Kept for the next pairs, which often have the same texts."""
    return WORD.findall(plain(value).lower())


def _near(head: list[str], y: list[str]) -> bool:
    """Whether SIMILARITY of the five-word shingles of `head` are in the beginning of `y`, which may be longer by as many
    words as such edits can add."""
    if y[: len(head)] == head:
        return True
    size = min(SHINGLE, len(head))
    own, other = ({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} for w in (head, y[: len(head) + len(head) // 4]))
    return len(own & other) >= SIMILARITY * len(own)


def ends_early(short: str, long: str, memo: WordHashes | None = None) -> bool | None:
    """Whether the alignment of two near-copies (see `_near`; the last word of `short` aside) ends with `short` while `long`
    goes on; null if they are none."""
    x, y = _plain_words(short), _plain_words(long)
    # Most pairs are told apart by their plain words. Words that are a sign of a cut are found as such.
    if len(x) < 2 or not _near(x[:-1], y):
        return None
    a, b = dissect(short)[0], dissect(long)[0].lower()
    x, places = WORD.findall(a.lower()), [(m.group(), m.end()) for m in WORD.finditer(b)]
    head, y = x[:-1], [w for w, _ in places]
    if not head or len(x) > len(y) or not _near(head, y):
        return None
    at = len(head)
    if y[:at] != head:
        pairs = common_lines(head, y[: at + at // 4])
        if pairs[-1][0] != at - 1:
            return False  # its end is worded differently: nothing tells that it was cut
        at = pairs[-1][1] + 1
    if at >= len(y):
        return False
    if x[-1] != y[at]:
        return y[at].startswith(x[-1])
    if _TERMINAL.search(a) or _TERMINAL.search(without_appendix(a)):
        return False  # a finished text; the other has an addition
    return at + 1 < len(y) and not _ADDED.match(b[places[at][1] :].lstrip())


_SOUGHT = "item_no {kind}, title boolean, n_words int, text_hash bigint, key bigint, most int, at bigint, bits bigint, lacks int"


def _sought(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each value and each of its keys the last shingles (see `_near`), one more than a near-copy can lack, a bit for each
    shingle, how many a near-copy can lack, and the greatest number of words that may hold them."""

    def shingles_of(words: list[str], _: int) -> tuple[list[str], int, int, int]:
        head = words[:-1]
        distinct = list(dict.fromkeys(reversed(_joined(head))))
        lacks = len(distinct) - math.ceil(SIMILARITY * len(distinct))
        # Shingles of fewer words are none of the longer text's.
        return distinct, lacks + 1, lacks if len(head) >= SHINGLE else 64, len(head) + len(head) // 4

    return _by_shingle(batches, shingles_of)


def _holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each value and each of its keys all shingles of its first words, `most` of them, and a bit for each."""

    def shingles_of(words: list[str], most: int) -> tuple[list[str], int, int, int]:
        distinct = list(dict.fromkeys(_joined(words[:most])))
        return distinct, len(distinct), 0, most

    return _by_shingle(batches, shingles_of)


def _joined(words: list[str]) -> list[str]:
    size = min(SHINGLE, len(words))
    return [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] if words else []


def _by_shingle(batches: Iterator[pa.RecordBatch], shingles_of) -> Iterator[pa.RecordBatch]:
    """(item_no, title, n_words, text_hash, keys of {key, most}, value) to rows of _SOUGHT. shingles_of(words, most): the
    shingles, how many of them make rows, what to put as `lacks` and as `most`; all of them have their bit."""
    for batch in batches:
        rows, found = [], ([], [], [], [], [])
        for n, (keys, value) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())):
            words, memo = WORD.findall(dissect(value)[0].lower()), {}
            for k in keys:
                if k["most"] not in memo:
                    texts, few, lacks, most = shingles_of(words, k["most"])
                    hashes = [xxhash.xxh3_64_intdigest(t.encode()) - (1 << 63) for t in texts]
                    bits = 0
                    for h in hashes:
                        bits |= 1 << (h & 63)
                    memo[k["most"]] = hashes[:few], bits - (1 << 64) if bits >> 63 else bits, lacks, most
                hashes, bits, lacks, most = memo[k["most"]]
                rows += [n] * len(hashes)
                for column, items in zip(found, ([k["key"]] * len(hashes), [most] * len(hashes), [h ^ k["key"] for h in hashes], [bits] * len(hashes), [lacks] * len(hashes))):
                    column += items
        rows = pa.array(rows, pa.int32())
        made = [pa.array(x, t) for x, t in zip(found, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()))]
        yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in batch.columns[:4]), *made], names=["item_no", "title", "n_words", "text_hash", "key", "most", "at", "bits", "lacks"])


def limits(features: DataFrame) -> DataFrame:
    """(source_id, field_name, limit, excess): lengths at which a source cuts, and the odds that a value there is cut."""
    by_length = features.groupBy("source_id", "field_name", "length").agg(F.count("*").alias("n"))
    # Lengths are few, however many values there are. Of those where values pile up the greatest pile counts; a few longer
    # values (an ellipsis added to whole ones, another feed of the source) may lie above it.
    along = Window.partitionBy("source_id", "field_name").orderBy("length")
    shape = by_length.select("source_id", "field_name", F.col("length").alias("limit"), "n", F.sum("n").over(along.rangeBetween(-22, -3)).alias("below"),
                             F.coalesce(F.sum("n").over(along.rangeBetween(1, Window.unboundedFollowing)), F.lit(0)).alias("above"))
    natural = F.greatest(F.coalesce(F.col("below"), F.lit(0)) / 20, F.lit(0.5))
    piled = shape.where((F.col("n") >= PILE) & (F.col("n") > PILE_RATIO * natural) & (F.col("above") <= 0.1 * F.col("n")))
    return piled.groupBy("source_id", "field_name").agg(F.max_by("limit", "n").alias("limit"), F.max_by(F.col("n") / natural, "n").alias("excess"))


def _by_beginnings(features: DataFrame) -> DataFrame:
    """(item_no, source_id, field_name) of values too short for a window that are a longer one's beginning, as `ends_early`
    has it: the last word is the beginning of the next one there, or is followed by others and doesn't finish the text."""
    begins = features.select(F.explode("begins").alias("b")).select("b.*")
    short = features.where("finished is not null and size(begins) > 0").select("item_no", "source_id", "field_name", "finished", F.element_at("begins", -1).alias("b"))
    short = stored(short.select("item_no", "source_id", "field_name", "finished", F.col("b.key").alias("key"), F.col("b.next").alias("last")))
    # Of all texts with one beginning only the different next words are needed.
    met = begins.join(short.select("key").distinct().hint("shuffle_hash"), "key", "left_semi").groupBy("key", "next").agg(F.max("goes").alias("goes"))
    after = F.expr("substring(next, length(last) + 1, 1)")
    longer = F.expr("startswith(next, last) and next <> last") & ~after.isin(".", "-")
    whole = (F.col("next") == F.col("last")) & F.col("goes")
    shown = (longer & ~after.isin("'", "’")) | (((longer & after.isin("'", "’")) | whole) & ~F.col("finished"))
    initial = lambda c: F.substring(c, 1, 1).alias("initial")
    return short.select("*", initial("last")).join(by_sorting(met.select("*", initial("next"))), ["key", "initial"]).where(shown).select("item_no", "source_id", "field_name").distinct()


def _by_copies(features: DataFrame, values: DataFrame) -> DataFrame:
    """(item_no, source_id, field_name) of values that a longer near-copy shows to be cut."""
    value = F.struct("n_words", "text_hash", "item_no", (F.col("field_name") == "title").alias("title"))
    keyed = features.where("n_words >= 5").select("own", value.alias("value"), F.posexplode("keys").alias("at", "key"))
    looks = (F.col("own") > 0) & F.col("at").between(F.col("own") - 1, F.col("own") - 2 + F.when(F.col("own") == 1, 1).otherwise(BANDS))
    keyed = keyed.select("key", "value", looks.alias("looks"))
    # Most buckets hold one text only; of the others, equal texts collapse before the shuffle, and a bucket with two texts
    # in one part is crowded.
    several = keyed.groupBy("key").agg(F.min("value.text_hash").alias("low"), F.max("value.text_hash").alias("high")).where("low <> high").select("key")
    # What is alone in its bucket is left out once, for all that follows.
    keyed = stored(keyed.join(stored(several), "key", "left_semi"))
    parts = keyed.groupBy("key", F.pmod("value.text_hash", F.lit(PARTNERS)).alias("part"))
    parts = parts.agg(F.max("value").alias("best"), F.min("value.text_hash").alias("low"), F.max("value.text_hash").alias("high"))
    buckets = stored(parts.groupBy("key").agg(F.collect_list("best").alias("partners"), F.max(F.col("low") != F.col("high")).alias("crowded")))
    looking = keyed.where("looks").drop("looks").join(buckets, "key")
    looking = stored(looking.withColumn("partners", F.when(~F.col("crowded"), F.col("partners"))))
    met = looking.where("not crowded").select("value", F.explode("partners").alias("other")).where("other.n_words >= value.n_words and other.text_hash <> value.text_hash")
    pairs = met.select("value.item_no", "value.title", F.col("other.item_no").alias("other_no"), F.col("other.title").alias("other_title"))
    # Only texts that share a bucket with others are needed: they are picked out once.
    sharing = keyed.select("value.item_no", "value.title").distinct()
    texts = stored(values.select("item_no", "source_id", "field_name", (F.col("field_name") == "title").alias("title"), "value").join(sharing, ["item_no", "title"], "left_semi"))
    kind = values.schema["item_no"].dataType.simpleString()

    def by_shingle(keys: DataFrame, read) -> DataFrame:
        """keys(value, key, most): the values' shingles by key; a value is read once for all of its keys."""
        each = keys.groupBy("value.item_no", "value.title").agg(F.min("value.n_words").alias("n_words"), F.min("value.text_hash").alias("text_hash"), F.collect_list(F.struct("key", "most")).alias("keys"))
        return texts.join(each, ["item_no", "title"]).select("item_no", "title", "n_words", "text_hash", "keys", "value").mapInArrow(read, _SOUGHT.format(kind=kind))

    crowded = looking.where("crowded").select("value", "key", F.lit(0).alias("most"))
    if not crowded.isEmpty():
        sought = stored(by_shingle(crowded, _sought))
        # Equal texts are one. How far a text is read is told by the longest value that is sought in its bucket.
        most = sought.groupBy("key").agg(F.max("most").alias("most"))
        holding = by_shingle(keyed.join(most, "key").groupBy("key", "most", "value.text_hash").agg(F.min("value").alias("value")), _holding)
        a, b = sought.alias("a"), holding.alias("b")
        # A bit that `b` lacks is a shingle that it lacks, so most texts that are no near-copies make no pair.
        both = a.join(b, F.expr("a.at = b.at and b.n_words >= a.n_words and b.text_hash <> a.text_hash and bit_count(a.bits & ~b.bits) <= a.lacks"))
        pairs = pairs.union(both.select("a.item_no", "a.title", "b.item_no", "b.title"))
    # Texts are fetched for the pairs only.
    pairs = stored(pairs.distinct())
    long = texts.select(F.col("item_no").alias("other_no"), F.col("title").alias("other_title"), F.col("value").alias("long"))
    judged = texts.join(pairs, ["item_no", "title"]).join(long, ["other_no", "other_title"]).select("item_no", "source_id", "field_name", "value", "long")
    return judged.mapInArrow(_aligned, f"item_no {kind}, source_id string, field_name string, cut boolean").where("cut").select("item_no", "source_id", "field_name").union(_by_beginnings(features)).distinct()


def _log_ratio(a: Column, b: Column) -> Column:
    return F.log(a) - F.log(b)


def _cut_share(bins: Column, before: Column) -> Column:
    """The likeliest share of cuts among values with these (evidence, n), `before` counting for SHARE_WEIGHT of them."""
    total = lambda f: F.aggregate(bins, F.lit(0.0), lambda s, b: s + b["n"] * f(F.exp(b["evidence"])))
    step = lambda p, _: (total(lambda x: p * x / (p * x + 1 - p)) + before * SHARE_WEIGHT) / (total(lambda x: F.lit(1.0)) + SHARE_WEIGHT)
    return F.aggregate(F.sequence(F.lit(1), F.lit(40)), F.lit(0.5), step)


def _summary_odds(scored: DataFrame) -> DataFrame:
    """(of_source_id, of_place, learnt): log odds of a cut among a source's summaries without a sign, from the evidence of
    all of their closing words; a source with few such values takes after all sources. A cut at a limit that falls on a
    blank leaves a value next to it, so both places are one class, 'at'."""
    bins = scored.where("field_name = 'feed_summary' and sign = 'none'").groupBy("source_id", F.when(F.col("place") == "next", "at").otherwise(F.col("place")).alias("place"), (F.round(F.col("evidence") * 4) / 4).alias("evidence")).agg(F.count("*").alias("n"))
    both = lambda df, *keys: df.groupBy(*keys).agg(F.collect_list(F.struct("evidence", "n")).alias("bins"))
    pooled = both(bins.groupBy("place", "evidence").agg(F.sum("n").alias("n")), "place").select("place", _cut_share(F.col("bins"), F.lit(SHARE)).alias("before"))
    share = both(bins, "source_id", "place").join(pooled, "place").select("source_id", "place", _cut_share(F.col("bins"), F.col("before")).alias("share"))
    return share.select(F.col("source_id").alias("of_source_id"), F.col("place").alias("of_place"), F.greatest(F.lit(-5.0), F.least(F.lit(5.0), F.log(F.col("share") / (1 - F.col("share"))))).alias("learnt"))


def truncated_values(items: DataFrame) -> DataFrame:
    """(item_no, source_id, field_name, evidence): every cut `title` and `feed_summary`; evidence: copy, sign or word.

    items(item_no, source_id, title, feed_summary); other columns are ignored. Null and blank values (invisible
    characters included) are no cases; repeated rows with the same item_no count once per value, as item_no is unique; an
    empty table gives no rows; values are read whole at any length. Values without any word are judged by signs alone.
    """
    values = _values(items)
    kind = items.schema["item_no"].dataType.simpleString()
    rows = stored(values.select("item_no", "source_id", "field_name", "value").mapInArrow(_dissected, _FEATURES.format(kind=kind)))
    features = rows.where("item_no is not null").drop("n_inner", "n_closing")
    cap = stored(limits(features))
    counts = rows.where("item_no is null").select("word", "n_inner", "n_closing")
    # Closing words of titles; where a source cuts at a limit, titles of that length teach nothing.
    titles = features.where("field_name = 'title' and sign = 'none' and word <> ''").join(cap, ["source_id", "field_name"], "left")
    titles = titles.where("limit is null or length < limit - 1").groupBy("word").agg(F.count("*").alias("n_last"))
    zero = F.lit(0).cast("long")
    counts = counts.withColumn("n_last", zero).unionByName(titles.select("word", zero.alias("n_inner"), zero.alias("n_closing"), "n_last"))
    counts = stored(counts.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n_inner", "n_closing", "n_last")]))
    known = (F.col("n_inner") + F.col("n_closing")) >= 3
    # Beginnings of frequent words: an unknown closing word among them is most likely a fragment.
    frequent = counts.where((F.col("n_inner") + F.col("n_closing") >= 20) & (F.length("word") >= 4))
    heads = frequent.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda k: F.substring("word", F.lit(1), k))).alias("word")).distinct()
    totals = counts.agg(*[F.greatest(F.sum(c), F.lit(1)).alias(f"all_{c}") for c in ("n_inner", "n_closing", "n_last")],
                        *[F.sum(F.when(~known & F.col("word").rlike(r"^\p{Lu}"), F.col(c))).alias(f"name_{c}") for c in ("n_inner", "n_closing", "n_last")])

    # A finished text is only in question at a limit.
    open_ = features.select("item_no", "source_id", "field_name", "length", "sign", "word").join(cap, ["source_id", "field_name"], "left")
    open_ = open_.where("sign in ('none', 'ellipsis') or (sign = 'terminal' and length = limit)")
    words = stored(counts.join(heads.withColumn("head", F.lit(True)), "word", "left"))
    judged = open_.join(words, "word", "left")
    judged = judged.withColumn("one", F.lit(1)).join(totals.withColumn("one", F.lit(1)), "one")
    title = F.col("field_name") == "title"
    rare = F.coalesce(F.col("n_inner") + F.col("n_closing"), F.lit(0)) < 3
    name = rare & F.col("word").rlike(r"^\p{Lu}")
    closer, all_closer = F.when(title, F.col("n_last")).otherwise(F.col("n_closing")), F.when(title, F.col("all_n_last")).otherwise(F.col("all_n_closing"))
    name_closer = F.when(title, F.col("name_n_last")).otherwise(F.col("name_n_closing"))
    by_word = _log_ratio((F.coalesce(F.col("n_inner"), F.lit(0)) + 0.5) / F.col("all_n_inner"), (F.coalesce(closer, F.lit(0)) + 0.5) / all_closer)
    by_name = _log_ratio((F.coalesce(F.col("name_n_inner"), F.lit(0)) + 5) / F.col("all_n_inner"), (F.coalesce(name_closer, F.lit(0)) + 5) / all_closer)
    digits = F.col("word").rlike(r"\p{Nd}")
    evidence = (
        F.when(F.col("sign") == "terminal", F.lit(-3.5))
        .when((F.col("word") == "") | digits, F.lit(-2.0))
        .when(name, by_name + F.when(F.col("head"), 2.5).otherwise(0.0))
        .when(rare & F.col("head"), F.lit(7.0))
        .when(rare & (F.coalesce(closer, F.lit(0)) < 4), F.lit(0.5))
        .otherwise(F.greatest(F.lit(-6.0), F.least(F.lit(6.0), by_word)))
    )
    at = F.when(F.col("length") == F.col("limit"), "at").when(F.col("length").between(F.col("limit") - 1, F.col("limit")), "next").when(
        (F.col("sign") == "ellipsis") & F.col("length").between(F.col("limit") - MARGIN, F.col("limit")), "near").otherwise("free")
    scored = judged.select("item_no", "source_id", "field_name", "sign", at.alias("place"), evidence.alias("evidence"), "excess")
    scored = stored(scored)
    plainly = scored.groupBy("source_id", "field_name", "sign", "place").agg(
        F.count_if(F.col("evidence") > 2).alias("cut"), F.count_if(F.col("evidence") < -0.5).alias("whole"), F.max("excess").alias("excess"))
    # At a limit the values beyond what the lengths below let expect are cut; elsewhere plain cases tell. Summaries
    # without a sign are enough for the share of cuts among them to be learnt from all of their closing words.
    told = F.greatest(F.lit(-5.0), F.least(F.lit(5.0), F.log((F.col("cut") + 0.5) / (F.col("whole") + 2))))
    beyond = F.log(F.greatest(F.col("excess") - 1, F.lit(0.05)))
    odds = F.when((F.col("place") == "at") & (F.col("sign") == "ellipsis"), F.greatest(told, beyond + 3)).when(F.col("place") == "at", beyond).otherwise(told)
    classes = ["source_id", "field_name", "sign", "place"]
    unsigned = (F.col("field_name") == "feed_summary") & (F.col("sign") == "none") & F.col("source_id").eqNullSafe(F.col("of_source_id")) & (F.when(F.col("place") == "next", "at").otherwise(F.col("place")) == F.col("of_place"))
    prior = plainly.withColumn("odds", odds).join(stored(_summary_odds(scored)), unsigned, "left").withColumn("odds", F.coalesce(F.when(F.col("place") == "at", F.greatest("learnt", "odds")).otherwise(F.col("learnt")), "odds"))
    prior = stored(prior.drop("of_source_id", "of_place").select(*[F.col(c).alias(f"of_{c}") for c in classes], "odds"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in classes])
    by_word_found = scored.join(prior, same).where(F.col("evidence") + F.col("odds") > 0).select("item_no", "source_id", "field_name", F.lit("word").alias("evidence"))
    by_sign = features.where("sign in ('broken', 'more')").select("item_no", "source_id", "field_name", F.lit("sign").alias("evidence"))
    by_copy = _by_copies(features, values).withColumn("evidence", F.lit("copy"))
    found = by_copy.unionByName(by_sign).unionByName(by_word_found)
    return found.groupBy("item_no", "source_id", "field_name").agg(F.min("evidence").alias("evidence"))


def truncation_rates(items: DataFrame) -> DataFrame:
    """(source_id, field_name, n_values, n_cut, share) of every source and field; null sources form a group of their own."""
    cut = truncated_values(items).groupBy("source_id", "field_name").agg(F.count("*").alias("n_cut"))
    all_ = _values(items).groupBy("source_id", "field_name").agg(F.count("*").alias("n_values"))
    joined = all_.alias("a").join(cut.alias("c"), F.col("a.source_id").eqNullSafe(F.col("c.source_id")) & (F.col("a.field_name") == F.col("c.field_name")), "left")
    n_cut = F.coalesce(F.col("c.n_cut"), F.lit(0))
    return joined.select("a.source_id", "a.field_name", "a.n_values", n_cut.alias("n_cut"), F.round(n_cut / F.col("a.n_values"), 6).alias("share"))

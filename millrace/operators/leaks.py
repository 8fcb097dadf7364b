"""Texts that share a long passage with texts that must not get out."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import SPACES
from millrace.tables import stored

#: Characters of a passage, and of the grams whose hashes select its fingerprints.
PASSAGE, GRAM = 64, 32
#: Characters of the shortest secret, and of the grams of one shorter than twice that. A power of two.
SHORT = 16
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Characters that are worked on at once, and bytes of a filter that tasks' filters are put together by.
PIECE, PART = 1 << 15, 1 << 14


def _doubled(grams: np.ndarray, step: int) -> np.ndarray:
    """The hashes of grams of twice `step` characters from those of `step`."""
    made = grams[:-step] * _FACTOR
    made += grams[step:]
    made ^= made >> np.uint64(29)
    made *= _MIX
    return made


def _along(grams: np.ndarray, least: Callable) -> np.ndarray:
    """The least (or greatest) of every PASSAGE - GRAM + 1 in a row."""
    step = 1
    while step < PASSAGE - GRAM:
        grams, step = least(grams[:-step], grams[step:]), step * 2
    return least(grams[:-1], grams[1:])


def _inside(lengths: np.ndarray, size: int) -> np.ndarray:
    """Places in texts set one after the other from where `size` characters are of one text."""
    begin, fits = np.cumsum(lengths) - lengths, lengths >= size
    steps = np.zeros(int(lengths.sum()) + 1, np.int32)
    steps[begin[fits]] += 1
    steps[(begin + lengths)[fits] - size + 1] -= 1
    return np.flatnonzero(np.cumsum(steps))


def _read(texts: list[str], sizes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """(places, passages, prints, grams) of texts set one after the other: the hash and the fingerprint of every PASSAGE
    characters, and places and hashes of the grams of `sizes`, by which these are told apart but not yet known to be equal. A
    fingerprint is that of the least and the greatest hash of the GRAM characters in a passage, so equal passages have the
    same, and neighbours mostly too."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    hashes = (np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)) * _FACTOR
    step, grams, ends = 1, {}, ()
    while step < PASSAGE:
        hashes, step = _doubled(hashes, step), step * 2
        if step in sizes:
            at = _inside(lengths, step)
            grams[step] = at, hashes[at]
        if step == GRAM:
            ends = _along(hashes, np.minimum), _along(hashes, np.maximum)
    places = _inside(lengths, PASSAGE)
    prints = ends[0][places] * _FACTOR
    prints ^= ends[1][places]
    prints ^= prints >> np.uint64(29)
    prints *= _MIX
    return places, hashes[places], prints, grams


def fingerprints(text: str) -> np.ndarray:
    """Hashes such that texts that share PASSAGE characters share one. A text shorter than that has none."""
    return np.unique(_read([text])[2])


def _sure(text: str) -> bytes:
    """What stands for these characters where they are compared."""
    return md5(text.encode(), usedforsecurity=False).digest()


def share_passage(a: str, b: str) -> bool:
    a, b = sorted((a, b), key=len)
    known = {a[k : k + PASSAGE] for k in range(len(a) - PASSAGE + 1)}
    return any(b[k : k + PASSAGE] in known for k in range(len(b) - PASSAGE + 1))


def _pieces(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Texts of about PIECE characters together, which stay in a processor's cache, and the place of the first."""
    first, total = 0, 0
    texts = [t or "" for t in texts]
    for n, text in enumerate(texts):
        total += len(text)
        if total >= PIECE:
            yield first, texts[first : n + 1]
            first, total = n + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def _may_be(known: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Whether each print has its bit in `known`, chosen by its upper bits."""
    at = prints >> np.uint64(64 - (len(known) * 8).bit_length() + 1)
    return (known[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def _runs(prints: np.ndarray) -> np.ndarray:
    """Where a print differs from the one before."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(prints)), bool), prints[1:] != prints[:-1])))


def _known(rows: DataFrame, prints: Callable[[pa.RecordBatch], Iterator[np.ndarray]], size: int) -> np.ndarray:
    """A filter of `size` bytes, in which the bit of each print of `rows` is set. Every task fills one of its own; parts of
    these that hold a bit are put together by their place."""

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(size, np.uint8)
        for batch in batches:
            for found in prints(batch):
                at = found >> np.uint64(64 - (size * 8).bit_length() + 1)
                np.bitwise_or.at(known, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        parts = known.reshape(-1, PART)
        some = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([parts[k].tobytes() for k in some], pa.binary())], names=["part", "bits"])

    def together(group: pa.Table) -> pa.Table:
        bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in group["bits"].to_pylist()])
        return pa.table({"part": group["part"].slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary())})

    schema = "part int, bits binary"
    known = np.zeros((size // PART, PART), np.uint8)
    for part, bits in rows.mapInArrow(filled, schema).groupBy("part").applyInArrow(together, schema).toLocalIterator():
        known[part] = np.frombuffer(bits, np.uint8)
    return known.ravel()


def _prints(among: np.ndarray | None = None, passages: bool = False) -> Callable[[pa.RecordBatch], Iterator[np.ndarray]]:
    """The fingerprints of the texts in column 1, or those of them that may be in `among`, or the hashes of their passages."""

    def prints(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, texts in _pieces(batch.column(1).to_pylist()):
            _, hashes, prints, _ = _read(texts)
            runs = _runs(prints)
            found = prints[runs]
            keep = np.ones(len(found), bool) if among is None else _may_be(among, found)
            yield hashes[np.repeat(keep, np.diff(np.append(runs, len(prints))))] if passages else found[keep]

    return prints


def _column(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The hashes in column 0."""
    yield batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)


#: Rows of `_selected` and `_tiled`: characters from a place of a text.
_FOUND = "copy binary, short boolean, place int, print bigint, sure binary"


def _found(copies: pa.Array, owners: list[int], short: list[bool], places: list[int], prints: list[np.ndarray], sure: list[bytes]) -> pa.RecordBatch:
    prints = np.concatenate(prints).view(np.int64) if prints else np.empty(0, np.int64)
    columns = [copies.take(pa.array(owners, pa.int32())), pa.array(short, pa.bool_()), pa.array(places, pa.int32()), pa.array(prints), pa.array(sure, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["copy", "short", "place", "print", "sure"])


def _selected(among: np.ndarray, known: np.ndarray, tiles: np.ndarray | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The passages whose fingerprint may be in `among` and which may be `known` themselves, and the SHORT and GRAM characters
    in a row that may be in `tiles`."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [], [], [], [], []
            for first, texts in _pieces(batch.column(1).to_pylist()):
                ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
                at, hashes, prints, grams = _read(texts, () if tiles is None else (SHORT, GRAM))
                runs = _runs(prints)
                keep = np.repeat(_may_be(among, prints[runs]), np.diff(np.append(runs, len(prints))))
                for size, at, hashes in ((PASSAGE, at[keep], hashes[keep]), *((size, *g) for size, g in grams.items())):
                    keep = _may_be(known if size == PASSAGE else tiles, hashes)
                    at, hashes = at[keep], hashes[keep]
                    owners = np.searchsorted(ends, at, "right")
                    places = [int(p - ends[n] + len(texts[n])) for n, p in zip(owners, at)]
                    sure = [_sure(texts[n][p : p + size]) for n, p in zip(owners, places)]
                    for into, new in zip(rows, ((first + owners).tolist(), [size < PASSAGE] * len(at), places, [hashes], sure)):
                        into.extend(new)
            yield _found(batch.column(0), *rows)

    return select


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last GRAM characters of a text shorter than a passage, or SHORT where it is shorter than that:
    together they cover it."""
    for batch in batches:
        rows = [], [], [], [], []
        for n, text in enumerate(batch.column(1).to_pylist()):
            size = GRAM if len(text) >= GRAM else SHORT
            places = [0, len(text) - size]
            for into, new in zip(rows, ([n] * 2, [True] * 2, places, [_read([text], (size,))[3][size][1][places]], [_sure(text[p : p + size]) for p in places])):
                into.extend(new)
        yield _found(batch.column(0), *rows)


def shared_passages(texts: DataFrame, secrets: DataFrame, shortest: int = PASSAGE) -> DataFrame:
    """(id, secret_id, secrets): every text that shares PASSAGE characters, blanks collapsed, with a secret one, or holds
    whole one that is shorter but has `shortest` characters (SHORT at least); the smallest such secret and their number.
    texts(id, text), secrets(id, text), ids whole numbers.

    Equal secrets and equal texts are compared once. Shorter and null texts share nothing; no rows, no rows. Texts are read
    again and again but never shuffled: passages that are left after filters over fingerprints and over passages are, and
    the parts of short secrets that texts hold. Characters are equal if their MD5 is.
    """
    plain = lambda df: df.select(F.col("id").cast("long").alias("id"), F.trim(F.regexp_replace("text", rf"{SPACES}+", " ")).alias("text")).where(F.length("text") >= shortest)
    texts, secrets = (stored(plain(df).withColumn("copy", F.unhex(F.md5("text")))) for df in (texts, secrets))
    own, secret = texts.select("copy", "text"), secrets.select("copy", "text")
    # About eight bits for each fingerprint, in filters of 128 KB to 32 MB; a filter that is too full lets more through.
    chars = secret.agg(F.sum(F.length("text"))).first()[0] or 0
    size = 1 << min(25, max(17, (chars // 8).bit_length()))
    of_secrets = _known(secret, _prints(), size)
    of_both = _known(own, _prints(of_secrets), size)
    theirs = _known(secret, _prints(of_both, passages=True), size)
    tiles, known_tiles = None, None
    if shortest < PASSAGE:
        tiles = stored(secret.where(F.length("text") < PASSAGE).mapInArrow(_tiled, _FOUND))
        known_tiles = _known(tiles.select("print"), _column, size)
    found = stored(own.mapInArrow(_selected(of_secrets, theirs, known_tiles), _FOUND))
    passages = found.where("not short")  # one shuffle by `sure` serves to find repeats and to join
    met = secret.mapInArrow(_selected(of_both, _known(passages.select("print"), _column, size)), _FOUND).select(F.col("copy").alias("secret"), "sure").repartition("sure").distinct()
    met = passages.select("copy", "sure").repartition("sure").distinct().join(met, "sure").select("copy", "secret")
    if tiles is not None:
        held = found.where("short").select("copy", "place", "sure").repartition("sure").distinct()
        # A secret is sought by that of its two parts which fewest places have; it is where the other is, too.
        ends = tiles.groupBy(F.col("copy").alias("secret")).agg(F.min(F.struct("place", "sure")).alias("a"), F.max(F.struct("place", "sure")).alias("b"))
        counts = held.groupBy("sure").agg(F.count("*").alias("n"))
        for end in "ab":
            ends = ends.join(counts.select(F.col("sure").alias(f"{end}_sure"), F.col("n").alias(f"{end}_n")), F.col(f"{end}.sure") == F.col(f"{end}_sure"))
        one, other = (F.when(F.col("a_n") <= F.col("b_n"), F.col(x)).otherwise(F.col(y)) for x, y in ("ab", "ba"))
        ends = ends.select("secret", one.alias("one"), other.alias("other")).select("secret", F.col("one.sure").alias("sure"), F.col("other.sure").alias("next"), (F.col("other.place") - F.col("one.place")).alias("step"))
        some = held.join(ends, "sure").select("copy", "secret", F.col("next").alias("sure"), (F.col("place") + F.col("step")).alias("place"))
        whole = some.join(held, ["copy", "place", "sure"])
        met = met.union(whole.select("copy", "secret"))
    copies = secrets.groupBy(F.col("copy").alias("secret")).agg(F.min("id").alias("secret_id"), F.count("*").alias("copies"))
    by_text = met.distinct().join(copies, "secret").groupBy("copy").agg(F.min("secret_id").alias("secret_id"), F.sum("copies").alias("secrets"))
    return texts.select("id", "copy").join(by_text, "copy").select("id", "secret_id", "secrets")

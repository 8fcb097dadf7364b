"""Problem 6: encoding texts with a public byte-level BPE vocabulary.

A text is split by the vocabulary's pattern into pre-tokens. Tier one: a minimal perfect hash over all vocabulary
entries answers pre-tokens that are entries themselves. Tier two: the others are merged byte by byte, the next merge
taken from a heap over a linked list of the bytes. Before that a pre-token is cut where no vocabulary entry holds the
two bytes side by side: no merge can ever cross such a place, so the parts are independent, short and often repeated,
which matters for scripts without blanks.

The work is a map over Arrow batches without any shuffle; the tables (about 1 MB, fixed by the vocabulary) are
broadcast. Results are remembered per Python worker, and the memory is emptied at MEMO entries, which bounds it.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
MEMO = 200_000
#: Bytes up to which a pre-token is merged in one piece, as cutting it would cost more.
SHORT = 20

# Fixed value: the pattern that splits text before the merges, as the vocabulary's makers publish it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary entries and their ids from a rank file: a base64 entry and its id on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(entry): int(rank) for entry, rank in map(bytes.split, f)}


class PerfectHash:
    """A minimal perfect hash from byte strings to ids: every key has a slot of its own and no slot is empty.

    Hash and displace: keys fall into buckets by the low part of their hash; the largest buckets first, each seeks a
    displacement that sends all of its keys to free slots; buckets of one key name the slot itself (negative).
    """

    def __init__(self, ids: dict[bytes, int]):
        keys = list(ids)
        self.size = n = len(keys)
        self.buckets = max(1, n // 3)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, n)
        if len(np.unique(hashes)) < n:
            raise ValueError("two entries share a 64-bit hash")
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        start, step = (hashes >> np.uint64(32)).astype(np.int64), (hashes >> np.uint64(12)).astype(np.int64) & 0xFFFFF | 1
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(sizes)
        self.displacement = [0] * self.buckets
        slots = np.full(n, -1, np.int64)
        for b in np.argsort(-sizes, kind="stable"):
            members = order[ends[b] - sizes[b] : ends[b]]
            if len(members) < 2:
                break
            d = 0
            while True:
                at = (start[members] + d * step[members]) % n
                if (slots[at] < 0).all() and len(set(at.tolist())) == len(at):
                    break
                d += 1
            slots[at] = members
            self.displacement[b] = d
        free = iter(np.flatnonzero(slots < 0).tolist())
        for b in np.flatnonzero(sizes == 1):
            at = next(free)
            slots[at] = order[ends[b] - 1]
            self.displacement[b] = -at - 1
        self.keys = [keys[i] for i in slots]
        self.ids = [ids[k] for k in self.keys]

    def get(self, key: bytes) -> int:
        """The id of `key`, or -1."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.displacement[h % self.buckets]
        at = -d - 1 if d < 0 else ((h >> 32) + d * (h >> 12 & 0xFFFFF | 1)) % self.size
        return self.ids[at] if self.keys[at] == key else -1


class Memo(dict):
    """Pre-token to ids, filled on first use."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, key):
        value = self[key] = self.encode(key)
        return value


class Encoder:
    """Encodes pre-tokens; picklable but for the memories, which each worker makes anew."""

    def __init__(self, ids: dict[bytes, int], pattern: str = PATTERN):
        if any(bytes([b]) not in ids for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.entries, self.pattern = PerfectHash(ids), pattern
        self.joined = np.zeros(65536, bool)
        for key in ids:
            b = np.frombuffer(key, np.uint8).astype(np.int64)
            self.joined[b[:-1] * 256 + b[1:]] = True
        self.pairs = [self.entries.get(bytes([a, b])) for a in range(256) for b in range(256)]
        self._ready()

    def _ready(self) -> None:
        self.findall = regex.compile(self.pattern).findall
        self.spans, self.memo, self.lengths = Memo(self._merge), Memo(self._pretoken), Memo(lambda t: len(self._pretoken(t)))

    def __getstate__(self):
        return {"entries": self.entries, "pattern": self.pattern, "joined": self.joined, "pairs": self.pairs}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def _pretoken(self, text: str) -> list[int]:
        raw = text.encode()
        whole = self.entries.get(raw)
        if whole >= 0:
            return [whole]
        if len(raw) <= SHORT:
            return self.spans[raw]
        b = np.frombuffer(raw, np.uint8).astype(np.int64)
        cuts = np.flatnonzero(~self.joined[b[:-1] * 256 + b[1:]]) + 1
        if not len(cuts):
            return self.spans[raw]
        edges = [0, *cuts.tolist(), len(raw)]
        return [i for s, e in zip(edges, edges[1:]) for i in self.spans[raw[s:e]]]

    def _merge(self, raw: bytes) -> list[int]:
        """Byte pair merges, lowest id first and leftmost among equals, by a heap over linked bytes."""
        get, n = self.entries.get, len(raw)
        end, before = list(range(1, n + 1)), list(range(-1, n))  # of the part that starts here; end 0: merged away
        pairs = self.pairs
        heap = [(r, i, i + 2) for i, (a, b) in enumerate(zip(raw, raw[1:])) if (r := pairs[a << 8 | b]) >= 0]
        heapify(heap)
        while heap:
            _, i, e = heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != e:
                continue  # one of the two parts has changed since
            end[i], end[j] = e, 0
            before[e] = i
            if e < n and (r := get(raw[i : end[e]])) >= 0:
                heappush(heap, (r, i, end[e]))
            if (p := before[i]) >= 0 and (r := get(raw[p:e])) >= 0:
                heappush(heap, (r, p, e))
        ids, i = [], 0
        while i < n:
            ids.append(get(raw[i : end[i]]))
            i = end[i]
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        self._trim()
        return np.fromiter(chain.from_iterable(map(self.memo.__getitem__, self.findall(text))), np.int32)

    def _trim(self) -> None:
        if len(self.memo) > MEMO or len(self.spans) > MEMO or len(self.lengths) > MEMO:
            for memo in (self.memo, self.spans, self.lengths):
                memo.clear()

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        self._trim()
        return sum(map(self.lengths.__getitem__, self.findall(text)))


@lru_cache(maxsize=4)
def encoder(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> Encoder:
    return Encoder(read_ranks(os.path.join(folder, vocabulary)))


def encode_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids): the ids of every text without special tokens, a text like a special token being ordinary text.

    Null and empty texts give an empty list; a null key stays null; repeated rows stay; other columns are ignored,
    clashing names included; an empty table gives no rows. Texts are encoded whole at any length. Lone surrogates
    can't occur, as Spark's strings are UTF-8.
    """
    tables = docs.sparkSession.sparkContext.broadcast(encoder(folder, vocabulary))
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tables.value.encode
        for batch in batches:
            ids = [encode(t) for t in batch.column(1).to_pylist()]
            offsets = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(x) for x in ids], out=offsets[1:])
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, flat)], names=[key, "ids"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(work, f"`{key}` {kind}, ids array<int>")


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, n_tokens) of every text, 0 for null and empty ones; otherwise as `encode_texts`."""
    tables = docs.sparkSession.sparkContext.broadcast(encoder(folder, vocabulary))
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tables.value.count
        for batch in batches:
            n = pa.array([count(t) for t in batch.column(1).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), n], names=[key, "n_tokens"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(work, f"`{key}` {kind}, n_tokens int")

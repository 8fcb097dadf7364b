"""Words and word shingles as 64-bit numbers, computed per Arrow batch with numpy."""

from __future__ import annotations

import re

import numpy as np
import xxhash

#: A word is a run of letters, digits and marks; scripts without blanks give one word per character.
WORD = re.compile(r"[぀-ヿ㐀-䶿一-鿿豈-﫿]|[^\W_぀-ヿ㐀-䶿一-鿿豈-﫿]+")
SHINGLE = 5


class WordHashes(dict):
    """Word to 64-bit hash, remembered; emptied by `trim` when it has grown."""

    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode())
        return value

    def trim(self, most: int = 300_000) -> None:
        if len(self) > most:
            self.clear()


class LowerHashes(WordHashes):
    """Of words in lower case, whatever their own."""

    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word.lower().encode())
        return value


class SmallHashes(WordHashes):
    """Of 31 bits, which a signed 32-bit number holds; 0 for a zero byte, at least 1 for every word."""

    def __missing__(self, word: str) -> int:
        value = self[word] = max(1, xxhash.xxh3_64_intdigest(word.encode()) & 0x7FFFFFFF) if word != "\0" else 0
        return value


def word_hashes(text: str, memo: WordHashes) -> np.ndarray:
    return np.array(list(map(memo.__getitem__, WORD.findall(text.lower()))), np.uint64)


_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: close inputs, unrelated outputs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of every `size` words in a row; a shorter text is one shingle, an empty one none."""
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    total = np.zeros(n, np.uint64)
    for k in range(min(size, len(words))):
        total = mixed(total * _ODD + words[k : k + n])
    return np.unique(total)


def seeds(count: int) -> np.ndarray:
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * _ODD) | np.uint64(1)


def all_shingles(texts: list[np.ndarray], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The shingles (repeats included) of many texts, joined, and the place where each text's begin.

    As `shingles`, but for a whole batch at once. Each text gets at least one place; that of an empty text holds 0.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    gaps = np.maximum(size, lengths)  # short texts are padded with zeros, which no word hash is
    places = np.concatenate(([0], np.cumsum(gaps)))
    words = np.zeros(places[-1], np.uint64)
    for t, at in zip(texts, places):
        words[at : at + len(t)] = t
    if not len(words):
        return words, places[:0]
    total = np.zeros(len(words), np.uint64)
    for k in range(size):
        total[: len(words) - k] = mixed(total[: len(words) - k] * _ODD + words[k:])
    owner = np.repeat(np.arange(len(texts)), gaps)
    inside = np.arange(len(words)) - places[owner] <= (gaps - size)[owner]
    counts = gaps - size + 1
    return total[inside], np.concatenate(([0], np.cumsum(counts)[:-1]))


def band_keys(texts: list[np.ndarray], bands: int, rows: int, size: int = SHINGLE) -> np.ndarray:
    """A signed key for each text (row) and each band of `rows` min-hashes (column) over the texts' word shingles."""
    if not texts:
        return np.empty((0, bands), np.int64)
    values, starts = all_shingles(texts, size)
    keys = np.empty((len(texts), bands), np.uint64)
    for b, seed in enumerate(seeds(bands * rows).reshape(bands, rows)):
        key = np.full(len(texts), b + 1, np.uint64)
        for s in seed:
            key = mixed(key * _ODD + np.minimum.reduceat(values * s, starts))  # the values are mixed already
        keys[:, b] = key
    return keys.view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two arrays of distinct values."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)

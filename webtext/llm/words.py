"""Words of many texts as numbers, with what is known about a word kept per worker."""

from __future__ import annotations

import re

import numpy as np
import xxhash

#: Runs of letters and digits.
WORD = re.compile(r"[^\W_]+")


class Numbered:
    """Gives each distinct word a number; forgets all when more than ``limit`` are known."""

    def __init__(self, limit: int = 150_000):
        self.limit = limit
        self.known: dict[str | bytes, int] = {}

    def number(self, words: list) -> tuple[np.ndarray, list, bool]:
        """Numbers of ``words``, the words that are new (numbered in this order from the end), and whether all was forgotten."""
        at = list(map(self.known.get, words))
        new: list[str] = []
        forgot = False
        if None in at:
            new = list(dict.fromkeys(word for word, place in zip(words, at) if place is None))
            if len(self.known) + len(new) > self.limit:
                self.known.clear()
                forgot = True
                new = list(dict.fromkeys(words))
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            at = list(map(self.known.__getitem__, words))
        return np.array(at, np.int64), new, forgot


class Hashed:
    """64-bit hashes of words (texts or bytes)."""

    def __init__(self):
        self.numbered = Numbered()
        self.hashes = np.zeros(0, np.uint64)

    def hash(self, words: list) -> np.ndarray:
        at, new, forgot = self.numbered.number(words)
        if forgot:
            self.hashes = np.zeros(0, np.uint64)
        if new:
            found = np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))
            self.hashes = np.concatenate((self.hashes, found))
        return self.hashes[at]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (fixed values: the splitmix64 finaliser)."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# An odd factor of the words' polynomial, and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes that are hashed at once; longer words are hashed one by one.
_CHUNK, _LONG_WORD = 1 << 18, 64
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
# Capital ASCII letters have the values of small ones.
_VALUES = mix(np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint64) + np.uint64(1 << 40))
_PLACES = np.arange(_CHUNK)
_POWERS = np.cumprod(np.where(_PLACES > 0, np.uint64(_BASE), np.uint64(1)), dtype=np.uint64)
_INVERSES = np.cumprod(np.where(_PLACES > 0, np.uint64(_INVERSE), np.uint64(1)), dtype=np.uint64)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``(place of the first byte, 64-bit hash)`` of the words of UTF-8 text, A-Z taken as a-z.

    Words are what the six ASCII white spaces part. All words of a chunk are hashed together: sums of byte values times
    powers, taken between a word's ends and divided by the power at its begin. A long word is hashed on its own.
    """
    codes = np.frombuffer(data, np.uint8)
    blank = _BLANK[codes]
    edges = np.flatnonzero(np.diff(blank.astype(np.int8), prepend=1, append=1))
    begins, ends = edges[0::2], edges[1::2]
    hashes = np.zeros(len(begins), np.uint64)
    long = np.flatnonzero(ends - begins > _LONG_WORD)
    for i in long.tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(data[begins[i] : ends[i]].lower())
    short = np.flatnonzero(ends - begins <= _LONG_WORD)
    first = 0
    while first < len(short):
        start = int(begins[short[first]])
        last = int(np.searchsorted(begins[short], start + _CHUNK - _LONG_WORD))
        at = short[first:last]
        b, e = begins[at] - start, ends[at] - start
        size = int(e[-1])
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_VALUES[codes[start : start + size]] * _POWERS[:size], out=sums[1:])
        hashes[at] = mix((sums[e] - sums[b]) * _INVERSES[b] + (e - b).astype(np.uint64))
        first = last
    return begins, hashes

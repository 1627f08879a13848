"""Words of a text as numbers, and hashes of runs of words, in numpy."""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash

from tagloom.llm.common import WORD

WORDS = re.compile(WORD)
UPPERS = re.compile("[A-Z]+")
BASE = 0x9E3779B97F4A7C15  # odd, so that powers of it keep all bits
CACHED = 300_000
BLOCK = 1 << 18  # bytes hashed at once
SHORT = 64  # bytes of a word that is hashed with its block; longer ones are hashed one by one


def fold(text: str) -> str:
    """A-Z lower-cased, everything else as it is."""
    return text.lower() if text.isascii() else UPPERS.sub(lambda m: m[0].lower(), text)


class Hashes(dict):
    """64-bit hashes of words; a word not seen yet is hashed when it is asked for."""

    def __missing__(self, word: str) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


class WordHasher:
    """64-bit hash of each word; hashes of words seen are kept in a bounded cache."""

    def __init__(self, fold: bool):
        self.fold = fold
        self.cache = Hashes()

    def words(self, text: str) -> list[str]:
        return WORDS.findall(fold(text) if self.fold else text)

    def hashes(self, words: list[str]) -> np.ndarray:
        if len(self.cache) > CACHED:
            self.cache.clear()
        return np.fromiter(map(self.cache.__getitem__, words), dtype=np.uint64, count=len(words))

    def of(self, text: str) -> np.ndarray:
        return self.hashes(self.words(text))


def power(n: int) -> np.uint64:
    return np.uint64(pow(BASE, n, 1 << 64))


def rolling(words: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash, modulo 2**64, of every run of ``n`` words; built from runs of doubled length."""
    if len(words) < n:
        return words[:0]
    done, size, part, width = None, 0, words, 1
    with np.errstate(over="ignore"):
        while True:
            if n & width:
                if done is None:
                    done = part
                else:
                    count = len(words) - (size + width) + 1
                    done = done[:count] * power(width) + part[size : size + count]
                size += width
            if size == n:
                return mix(done)
            count = len(part) - width
            part = part[:count] * power(width) + part[width : width + count]
            width *= 2


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(steps)


def prefix_sums(values: np.ndarray, up: np.ndarray) -> np.ndarray:
    """Polynomials of all prefixes; that of a run is a difference times an inverse power."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(values * up, out=out[1:])
    return out


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whether a byte lies in a word, a random number of each byte, powers of the base and of its inverse."""
    inside = np.ones(256, dtype=bool)
    inside[[0x20, *range(0x09, 0x0E)]] = False
    random = np.random.default_rng(7).integers(0, 1 << 64, 256, dtype=np.uint64)
    return inside, random, powers(BASE, BLOCK + SHORT), powers(pow(BASE, -1, 1 << 64), BLOCK)


class TextWords:
    """Words of all texts of an Arrow array, without nulls, one after another.

    ``raw`` holds the bytes, ``start`` and ``end`` say where each word lies in
    them; ``bounds`` and ``first`` say by text, and for the end, how many bytes
    and how many words come before it.
    """

    def __init__(self, texts: pa.Array):
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        _, ends, data = texts.buffers()
        bounds = np.frombuffer(ends, kind)[texts.offset :][: len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        self.raw = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]
        self.bounds = bounds - bounds[0]
        inside = tables()[0][self.raw]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cut = self.bounds[(self.bounds > 0) & (self.bounds < len(self.raw))]
        first[cut], last[cut - 1] = inside[cut], inside[cut - 1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, self.bounds)

    def text_of(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word: the polynomial of its bytes, or xxHash if it is long."""
        _, random, up, down = tables()
        size = self.end - self.start
        out = np.empty(len(size), dtype=np.uint64)
        short = np.flatnonzero(size <= SHORT)
        start, end = self.start[short], self.end[short]
        at = 0
        while at < len(short):
            stop = np.searchsorted(start, start[at] + BLOCK)
            a, b, base = start[at:stop] - start[at], end[at:stop] - start[at], start[at]
            values = random[self.raw[base : base + b[-1]]]
            sums = prefix_sums(values, up[: len(values)])
            with np.errstate(over="ignore"):
                out[short[at:stop]] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
            at = stop
        for i in np.flatnonzero(size > SHORT).tolist():
            out[i] = xxhash.xxh3_64_intdigest(self.raw[self.start[i] : self.end[i]])
        return out

    def joined(self, kept: np.ndarray) -> pa.Array:
        """Each text of its kept words alone, joined by one space."""
        word = np.flatnonzero(kept)
        text = self.text_of()[word]
        # A kept word takes the blank after it along, unless it is the last one of its text.
        more = np.concatenate([text[1:] == text[:-1], [False]])[: len(word)]
        step = np.zeros(len(self.raw) + 1, dtype=np.int8)
        step[self.start[word]] = 1
        step[self.end[word] + more] -= 1
        taken = np.cumsum(step[:-1], dtype=np.int8).view(bool)
        data = np.where(tables()[0][self.raw], self.raw, np.uint8(0x20))[taken]
        size = np.bincount(text, weights=self.end[word] - self.start[word] + more, minlength=len(self.bounds) - 1)
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(data))


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``n`` words; a shorter text is one run, an empty one none."""
    if not len(words):
        return words
    return np.unique(rolling(words, min(n, len(words))) ^ np.uint64(0 if len(words) >= n else len(words)))

"""BPE encoding and decoding with a public vocabulary file.

Every distinct word is merged with a segment tree over the ranks of its
adjacent pairs. A leaf holds ``rank * width + position``, so the root is the
leftmost pair of lowest rank; a merge rewrites three leaves and their
ancestors. The trees of many words lie side by side in one array and advance
together. Results per word are kept in a bounded cache of the worker.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from tagloom.llm.common import id_and_text

CACHED_WORDS = 150_000
CELLS = 1 << 20  # cells of one block of trees
CHUNK_CHARS = 1 << 20  # text handled at once
NONE = np.iinfo(np.int64).max

# White space, and what the tokenizer library's tables have that Python's lack: letters, numbers and lower case of
# newer scripts. Marks it treats as letters of their own when it puts marks in order. Fixed values.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTERS = (
    "1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d4a-10d65 10d6f-10d85 10ec2-10ec4 11380-11389 1138b 1138e 11390-113b5 "
    "113b7 113d1 113d3 11bc0-11be0 13460-143fa 16100-1611d 16d40-16d6c 18cff 1e5d0-1e5ed 1e5f0"
)
NUMBERS = "10d40-10d49 116d0-116e3 11bf0-11bf9 16130-16139 16d70-16d79 1ccf0-1ccf9 1e5f1-1e5fa"
LOWER = "1c89:1c8a a7cb:0264 a7cc:a7cd a7ce:a7cf a7d2:a7d3 a7d4:a7d5 a7da:a7db a7dc:019b 10d50-10d65:10d70 16ea0-16eb8:16ebb"
MARKS = (
    "07fd 0898-089f 08ca-08d3 09fe 0c3c 0d3b-0d3c 0eba 1715 1abf-1ace 1df6-1dfa a82c 10d24-10d27 10eab-10eac 10efd-10eff "
    "10f46-10f50 10f82-10f85 11070 1133b 1145e 11839-1183a 1193d-1193e 11943 119e0 11a34 11a47 11a99 11d42 11d44-11d45 "
    "11d97 11f41-11f42 16ff0-16ff1 1e08f 1e130-1e136 1e2ae 1e2ec-1e2ef 1e4ec-1e4ef"
)


def places(spans: str) -> list[int]:
    """Code points of spans written in hexadecimal."""
    ends = [[int(x, 16) for x in span.split("-")] for span in spans.split()]
    return [i for e in ends for i in range(e[0], e[-1] + 1)]


def members(code_points: Iterable[int]) -> str:
    """Code points as the inside of a character class."""
    out: list[list[int]] = []
    for i in sorted(code_points):
        if out and out[-1][1] == i - 1:
            out[-1][1] = i
        else:
            out.append([i, i])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


def category(name: str, more: str) -> str:
    own = (i for i in range(sys.maxunicode + 1) if unicodedata.category(chr(i))[0] == name)
    return members({*own, *places(more)})


def lower_table() -> dict[int, int]:
    out = {}
    for pair in LOWER.split():
        span, to = pair.split(":")
        out |= {c: int(to, 16) + i for i, c in enumerate(places(span))}
    return out


@lru_cache(maxsize=1)
def patterns() -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """Words of any text, marks that stand alone, and characters that need one of the tables above."""
    letter, number = category("L", LETTERS), category("N", NUMBERS)
    words = rf"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{SPACE}{letter}{number}]+"
    marks = members(places(MARKS))
    return re.compile(words), re.compile(f"([{marks}])"), re.compile(f"[{marks}{members(lower_table())}\u03a3]")


ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (chr(256 + i) for i in range(256 - len(shown)))
    return [chr(b) if b in shown else next(hidden) for b in range(256)]


class WordBpe:
    """A lower-casing byte-level BPE with word ends, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if spec["decoder"] is not None or not model["end_of_word_suffix"]:
            raise ValueError("only vocabularies with word ends and no decoder are supported")
        vocab = model["vocab"]
        end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        by_id = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.tokens = [by_id.get(i, "") for i in range(max(by_id) + 1)]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.last = np.array([vocab[c + end] for c in letters], dtype=np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.split = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.cache: dict[str, bytes] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, NONE where there is none."""
        key = left << 32 | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def merge(self, sym: np.ndarray) -> np.ndarray:
        """Merge each row of symbols to the end; -1 fills a row up and takes the place of what is merged away."""
        rows, width = sym.shape
        sym = np.hstack([sym, np.full((rows, 1), -1, dtype=np.int64)])
        size = (sym >= 0).sum(axis=1)
        place = np.arange(width + 1)
        after = np.where(place[None, :] + 1 < size[:, None], place[None, :] + 1, width)
        before = np.broadcast_to(place - 1, (rows, width + 1)).copy()
        tree = np.full((rows, 2 * width), NONE, dtype=np.int64)

        def leaf(left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
            rank = self.rank(left, right)
            return np.where(rank == NONE, NONE, np.where(rank == NONE, 0, rank) * width + at)

        tree[:, width:] = leaf(sym[:, :-1], sym[:, 1:], place[None, :width])
        level = width // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(
                tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2]
            )
            level //= 2
        row = np.flatnonzero(tree[:, 1] != NONE)
        while row.size:
            best = tree[row, 1]
            at, rank = best % width, best // width
            gone = after[row, at]
            then = after[row, gone]
            sym[row, at] = self.made[rank]
            sym[row, gone] = -1
            after[row, at] = then
            before[row, then] = at
            tree[row, width + at] = leaf(sym[row, at], sym[row, then], at)
            tree[row, width + gone] = NONE
            front = before[row, at]
            has = front >= 0
            f_row, f_at = row[has], front[has]
            tree[f_row, width + f_at] = leaf(sym[f_row, f_at], sym[f_row, at[has]], f_at)
            r, node = np.concatenate([row, row, f_row]), np.concatenate([at, gone, f_at]) + width
            level = width
            while level > 1:
                node >>= 1
                tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
                level //= 2
            row = row[tree[row, 1] != NONE]
        return sym[:, :-1]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        raw = [w.encode() for w in words]
        out: list[bytes] = [b""] * len(words)
        classes: dict[int, list[int]] = {}
        for i, b in enumerate(raw):
            classes.setdefault(max(2, 1 << (len(b) - 1).bit_length()), []).append(i)
        for width, members in classes.items():
            step = max(1, CELLS // width)
            for lo in range(0, len(members), step):
                part = members[lo : lo + step]
                size = np.array([len(raw[i]) for i in part])
                filled = np.arange(width)[None, :] < size[:, None]
                sym = np.full((len(part), width), -1, dtype=np.int64)
                data = np.frombuffer(b"".join(raw[i] for i in part), dtype=np.uint8)
                sym[filled] = self.inner[data]
                sym[np.arange(len(part)), size - 1] = self.last[data[np.cumsum(size) - 1]]
                sym = self.merge(sym)
                kept = sym >= 0
                flat = sym[kept].astype("<u4").tobytes()
                ends = (np.cumsum(kept.sum(axis=1)) * 4).tolist()
                start = 0
                for i, end in zip(part, ends, strict=True):
                    out[i] = flat[start:end]
                    start = end
        return out

    def words(self, text: str) -> list[str | int]:
        """Normalised words of a text, and ids of special tokens written in it."""
        if self.split is None or "<|" not in text:
            return self._plain(text)
        found: list[str | int] = []
        start = 0
        for m in self.split.finditer(text):
            found += self._plain(text[start : m.start()])
            found.append(self.special[m[0]])
            start = m.end()
        return found + self._plain(text[start:])

    @staticmethod
    def _plain(text: str) -> list[str]:
        if text.isascii():
            return ASCII_WORDS.findall(text.lower())
        words, marks, rare = patterns()
        if not rare.search(text):
            return words.findall(unicodedata.normalize("NFC", text).lower())
        text = "".join(unicodedata.normalize("NFC", part) for part in marks.split(text))
        return words.findall(text.replace("\u03a3", "\u03c3").lower().translate(lower_table()))  # no final form of sigma

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.words(t) for t in texts]
        cache = self.cache
        new = list({w for words in split for w in words if w not in cache and isinstance(w, str)})
        if len(cache) + len(new) > CACHED_WORDS:
            cache.clear()
            new = list({w for words in split for w in words if isinstance(w, str)})
        cache.update(zip(new, self.encode_words(new), strict=True))
        for i in self.special.values():
            cache[i] = np.uint32(i).astype("<u4").tobytes()  # type: ignore[index]
        return [b"".join(map(cache.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        """The tokens' texts joined by a space, special tokens included."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    return WordBpe(path)


def chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Consecutive texts of about ``limit`` characters together."""
    part: list[str] = []
    size = 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns one row per input row: the id, ``n_tokens``, ``ids`` (packed as
    little-endian unsigned 32-bit integers) and ``decoded``. A null or empty
    text has no ids and decodes to an empty text. Repeated rows and null ids
    stay as they are; other columns are not carried. ``path`` is the place of
    the tokenizer file on every executor.
    """
    source = id_and_text(df, id_col, text_col)
    schema = StructType(
        [
            source.schema[0],
            StructField("n_tokens", LongType()),
            StructField("ids", BinaryType()),
            StructField("decoded", StringType()),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            done = 0
            for part in chunks(batch.column(1).to_pylist()):
                ids = bpe.encode(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, len(part)),
                        pa.array([len(b) // 4 for b in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([bpe.decode(b) for b in ids], pa.string()),
                    ],
                    names=schema.names,
                )
                done += len(part)

    return source.mapInArrow(run, schema)

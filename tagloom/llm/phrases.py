"""Frequent phrases and how strongly their words hold together.

Texts are hashed as bytes: prefix polynomials give the fingerprint of every
word, prefix polynomials over the words that of every phrase. Fingerprints are
counted in tasks and summed by a shuffle, level by level: pairs only of
frequent words, longer phrases only of frequent pairs, as told by a bit filter
of fixed size that may let too much through but never too little. With each
fingerprint go a pointer to one occurrence and the sum of a second,
independent hash of all its occurrences. Only frequent phrases are read, where
their pointers say, and hashed again: where the sum is not that of so many
occurrences of the text, fingerprints have collided, and those phrases
are counted as text, all occurrences of a block being compared word by word
and byte by byte.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tagloom.llm.common import ascii_lower, stored
from tagloom.llm.words import BASE, mix, powers, prefix_sums

# What ends a piece, what ends a word.
STOPS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
GAP = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
TAIL = re.compile(rb"(?:[\x20\x09.,;:!?\x0A-\x0D]*[^\x20\x09.,;:!?\x0A-\x0D]+){0,3}")
BETWEEN = re.compile(rb"[\x20\x09]+")
LONGEST = 4  # words of a phrase; TAIL takes one less
CHECK_BITS = 20


@dataclass(frozen=True)
class PhraseSettings:
    least: int = 30  # occurrences of a phrase
    covered: int = 80  # hundredths of them inside one longer phrase, from which the phrase is dropped
    top: int = 2000  # phrases returned of each language
    scale: int = 2_000_000
    block: int = 1 << 20  # bytes hashed at once
    merged: int = 400_000  # distinct fingerprints a task holds before it hands them on
    filter_bits: int = 1 << 28  # of the largest filter
    bits: int = 64  # of a fingerprint; fewer in tests
    spread: int = 64  # parts in which a language is ranked first


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower case of A-Z, kind (0 in a word, 1 blank, 2 stop) and two random numbers of each byte."""
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    kind = np.zeros(256, dtype=np.uint8)
    kind[list(BLANKS)], kind[list(STOPS)] = 1, 2
    return low, kind, np.random.default_rng(12).integers(0, 1 << 64, (2, 256), dtype=np.uint64)


class Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as were asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << n.bit_length()
            self.up, self.down = (powers(b, size) for b in (BASE, pow(BASE, -1, 1 << 64)))
        return self.up[:n], self.down[:n]


@dataclass
class Segment:
    """Bytes of a text from ``at``; phrases that start in the first ``own`` bytes count here."""

    data: bytes
    own: int
    doc: int
    at: int


def segments(data: bytes, doc: int, size: int) -> Iterator[Segment]:
    """A text in one piece or, if it is long, cut between words, each part with the next three words at its end."""
    at = 0
    while at < len(data):
        cut = GAP.search(data, at + size) if len(data) - at > size else None
        end = cut.start() if cut else len(data)
        yield Segment(data[at : TAIL.match(data, end).end()], end - at, doc, at)
        at = end


class Block:
    """Words of some texts of one language and fingerprints of their phrases."""

    def __init__(self, parts: list[Segment], s: PhraseSettings, held: Powers):
        low, kind, random = tables()
        raw = np.frombuffer(b"\n".join(p.data for p in parts), dtype=np.uint8)
        self.parts, self.s, self.held, self.low = parts, s, held, low[raw]
        kinds = kind[raw]
        edges = np.flatnonzero(np.diff(kinds == 0, prepend=False, append=False))
        self.start, self.end = edges[::2], edges[1::2]
        self.piece = np.cumsum(kinds == 2)[self.start]
        begin = np.cumsum([0] + [len(p.data) + 1 for p in parts[:-1]])
        self.part = np.searchsorted(begin, self.start, side="right") - 1
        self.begin = begin
        self.counted = self.start < (begin + [p.own for p in parts])[self.part]
        self.sums = [self.sums_of_words(table) for table in random]

    def sums_of_words(self, table: np.ndarray) -> np.ndarray:
        """Polynomials of all prefixes of the words, each word being the polynomial of its bytes."""
        up, down = self.held.of(len(self.low) + 1)
        sums = prefix_sums(table[self.low], up[:-1])
        with np.errstate(over="ignore"):
            words = mix((sums[self.end] - sums[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))
        return prefix_sums(words, up[: len(words)])

    def hashes(self, n: int, which: int) -> np.ndarray:
        """Hash of the ``n`` words from each word on."""
        sums = self.sums[which]
        _, down = self.held.of(len(sums))
        with np.errstate(over="ignore"):
            return mix((sums[n:] - sums[:-n]) * down[: max(len(sums) - n, 0)] + np.uint64(n))

    def prints(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint of the ``n`` words from each word on, and whether they lie in one piece."""
        found = self.hashes(n, 0)
        if self.s.bits < 64:
            found = found & np.uint64((1 << self.s.bits) - 1)
        return found, self.piece[: len(found)] == self.piece[n - 1 :]

    def checks(self, n: int) -> np.ndarray:
        """Second hash of the ``n`` words from each word on; short, so that sums of very many fit 64 bits."""
        return (self.hashes(n, 1) >> np.uint64(64 - CHECK_BITS)).astype(np.int64)

    def pointers(self, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Text of each phrase, by hash, and its first byte and number of bytes there, as one number."""
        part = self.part[at]
        first = self.start[at] - self.begin[part] + np.array([p.at for p in self.parts])[part]
        return np.array([p.doc for p in self.parts])[part], (first << 32) | (self.end[at + n - 1] - self.start[at])

    def numbers(self) -> np.ndarray:
        """Equal numbers for equal words: by fingerprint where the bytes agree, else by the words themselves."""
        found = self.prints(1)[0]
        _, first, number = np.unique(found, return_index=True, return_inverse=True)
        size, like = self.end - self.start, first[number]
        same = np.array_equal(size, size[like])
        if same:
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            same = np.array_equal(self.low[np.repeat(self.start, size) + step], self.low[np.repeat(self.start[like], size) + step])
        if same:
            return number
        known: dict[bytes, int] = {}
        data = self.low.tobytes()
        spans = zip(self.start.tolist(), self.end.tolist(), strict=True)
        return np.fromiter((known.setdefault(data[a:b], len(known)) for a, b in spans), dtype=np.int64, count=len(size))

    def groups(self, at: np.ndarray, found: np.ndarray, n: int, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each distinct phrase of ``n`` words starts first, and how often it does, of those starting at ``at``."""
        _, first, inverse, count = np.unique(found, return_index=True, return_inverse=True, return_counts=True)
        like = at[first[inverse]]
        if not all(np.array_equal(number[at + j], number[like + j]) for j in range(n)):
            rows = np.stack([number[at + j] for j in range(n)], axis=1)
            _, first, count = np.unique(rows, axis=0, return_index=True, return_counts=True)
        return at[first], count

    def text(self, start: np.ndarray, n: int) -> list[bytes]:
        data = self.low.tobytes()
        spans = zip(self.start[start].tolist(), self.end[start + n - 1].tolist(), strict=True)
        return [BETWEEN.sub(b" ", data[a:b]) for a, b in spans]


class Filter:
    """Bits of a set of fingerprints; may know too many, never too few."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, prints: np.ndarray) -> np.ndarray:
        out = np.ones(len(prints), dtype=bool)
        for place in places(prints, len(self.bits) * 8):
            out &= (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        return out


def places(prints: np.ndarray, size: int) -> list[np.ndarray]:
    """Two of the ``size`` bits, a power of two, for each fingerprint."""
    spread = mix(prints)
    low = np.uint64(size - 1)
    return [(spread & low).astype(np.int64), ((spread >> np.uint64(32)) & low).astype(np.int64)]


PAGE = 1 << 16  # bytes of a filter that one group packs


def build_filter(prints: DataFrame, s: PhraseSettings) -> Filter:
    """The filter of a frame of fingerprints: 16 bits for each, ``filter_bits`` at most."""
    size = PAGE * 8
    while size < min(16 * prints.count(), s.filter_bits):
        size *= 2

    def set_bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
            bit = np.unique(np.concatenate(places(found, size)))
            yield pa.RecordBatch.from_pydict({"page": bit // (PAGE * 8), "bit": bit % (PAGE * 8)})

    def pack(page: pa.Table) -> pa.Table:
        bits = np.zeros(PAGE * 8, dtype=np.uint8)
        bits[page.column("bit").to_numpy()] = 1
        return pa.table({"page": page.column("page")[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    out = np.zeros(size // 8, dtype=np.uint8)
    ones = prints.select("print").mapInArrow(set_bits, "page long, bit long").distinct()
    for row in ones.groupBy("page").applyInArrow(pack, "page long, bits binary").toLocalIterator():
        out[row["page"] * PAGE : (row["page"] + 1) * PAGE] = np.frombuffer(row["bits"], dtype=np.uint8)
    return Filter(out)


@dataclass
class Sums:
    """Fingerprints by key: how often, sums of second hashes, pointers; merged now and then."""

    parts: dict[tuple, list[tuple[np.ndarray, ...]]] = field(default_factory=dict)
    size: int = 0

    def add(self, key: tuple, prints: np.ndarray, counts: np.ndarray, checks: np.ndarray, *pointers: np.ndarray) -> None:
        order = np.argsort(prints, kind="stable")
        prints = prints[order]
        first = np.flatnonzero(np.diff(prints, prepend=~prints[:1]))
        totals = [np.add.reduceat(x[order], first) if len(first) else x for x in (counts, checks)]
        self.parts.setdefault(key, []).append((prints[first], *totals, *(x[order[first]] for x in pointers)))
        self.size += len(first)

    def merge(self) -> None:
        waiting, self.parts, self.size = self.parts, {}, 0
        for key, parts in waiting.items():
            self.add(key, *(np.concatenate(x) for x in zip(*parts, strict=True)))

    def drain(self) -> Iterator[pa.RecordBatch]:
        for (lang, n), ((prints, *values),) in self.parts.items():
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(prints), pa.string()), "n": np.full(len(prints), n, dtype=np.int32),
                "print": prints.view(np.int64), **dict(zip(("f", "mass", "doc", "span"), values, strict=True)),
            })
        self.parts, self.size = {}, 0


def blocks(batches: Iterable[pa.RecordBatch], s: PhraseSettings) -> Iterator[tuple[str, Block]]:
    """Texts as blocks of one language each."""
    held, waiting, sizes = Powers(), {}, {}
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        docs, langs = batch.column("doc").to_pylist(), batch.column("lang").to_pylist()
        for doc, lang, text in zip(docs, langs, texts, strict=True):
            for part in segments(text.as_py(), doc, s.block):
                waiting.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + len(part.data) + 1
                if sizes[lang] >= s.block or sum(sizes.values()) >= 4 * s.block:
                    for key in [lang] if sizes[lang] >= s.block else list(waiting):
                        yield key, Block(waiting.pop(key), s, held)
                        sizes.pop(key)
    for lang, parts in waiting.items():
        yield lang, Block(parts, s, held)


Picked = Iterator[tuple[int, np.ndarray]]


def count_prints(pick: Callable[[Block], Picked], s: PhraseSettings) -> Callable:
    """Fingerprints of the phrases a function picks from each block; as a phrase of no words, how many words there are."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for lang, block in blocks(batches, s):
            words = np.array([block.counted.sum()])
            sums.add((lang, 0), np.zeros(1, dtype=np.uint64), words, *[np.zeros(1, dtype=np.int64)] * 3)
            for n, at in pick(block):
                ones = np.ones(len(at), dtype=np.int64)
                sums.add((lang, n), block.prints(n)[0][at], ones, block.checks(n)[at], *block.pointers(at, n))
            if sums.size > 2 * s.merged:
                sums.merge()
                if sums.size > s.merged:
                    yield from sums.drain()
        sums.merge()
        yield from sums.drain()

    return run


def all_words(block: Block) -> Picked:
    yield 1, np.flatnonzero(block.counted)


def of_frequent(known: Filter, n: int, longer: range) -> Callable[[Block], Picked]:
    """Where phrases of some lengths start, all of whose parts of ``n`` words are known."""

    def pick(block: Block) -> Picked:
        prints, whole = block.prints(n)
        fits = whole & known.has(prints)
        for m in longer:
            _, whole = block.prints(m)
            take = whole & block.counted[: len(whole)]
            for j in range(m - n + 1):
                take &= fits[j : j + len(whole)]
            yield m, np.flatnonzero(take)

    return pick


def verified(s: PhraseSettings) -> Callable:
    """Rows of ``frequent`` with their texts, and whether text, fingerprint and sum of hashes agree."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Powers()
        for batch in batches:
            texts = batch.column("phrase").cast(pa.binary()).to_pylist()
            sound = np.zeros(len(texts), dtype=bool)
            if texts:
                block = Block([Segment(t, len(t), 0, 0) for t in texts], s, held)
                size, first = np.bincount(block.part, minlength=len(texts)), np.searchsorted(block.part, np.arange(len(texts)))
                n, f, mass, prints = (batch.column(c).to_numpy() for c in ("n", "f", "mass", "print"))
                for m in range(1, LONGEST + 1):
                    rows = np.flatnonzero((n == m) & (size == m))
                    at = first[rows]
                    same = block.prints(m)[0][at] == prints[rows].view(np.uint64)
                    sound[rows] = same & (block.checks(m)[at] * f[rows] == mass[rows])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sound)], names=[*batch.schema.names, "sound"])

    return run


def read_phrases(known: Filter, s: PhraseSettings) -> Callable:
    """Phrases whose fingerprints are known, counted as text, with one place where each stands."""

    def batch(found: dict) -> pa.RecordBatch:
        keys, values = list(found), list(found.values())
        return pa.RecordBatch.from_pydict({
            "lang": pa.array([k[0] for k in keys], pa.string()), "n": pa.array([k[1] for k in keys], pa.int32()),
            "phrase": pa.array([k[2] for k in keys], pa.binary()).cast(pa.string()), "f": pa.array([v[0] for v in values], pa.int64()),
            "doc": pa.array([v[1] for v in values], pa.int64()), "span": pa.array([v[2] for v in values], pa.int64()),
        })

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int, bytes], list] = {}
        for lang, block in blocks(batches, s):
            number = block.numbers()
            for n in range(1, LONGEST + 1):
                prints, whole = block.prints(n)
                at = np.flatnonzero(whole & block.counted[: len(prints)])
                at = at[known.has(prints[at])]
                first, count = block.groups(at, prints[at], n, number)
                docs, spans = block.pointers(first, n)
                for phrase, c, doc, span in zip(block.text(first, n), count.tolist(), docs.tolist(), spans.tolist(), strict=True):
                    old = found.get((lang, n, phrase))
                    if old:
                        old[0] += c
                    else:
                        found[lang, n, phrase] = [c, doc, span]
            if len(found) > s.merged:
                yield batch(found)
                found = {}
        yield batch(found)

    return run


def frequent_phrases(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     s: PhraseSettings = PhraseSettings()) -> tuple[DataFrame, DataFrame]:  # fmt: skip  # noqa: B008
    """All phrases of 1 to 4 words with at least ``least`` occurrences in their language, and all words by language.

    The first frame has ``lang, n (words), phrase, f, place``; ``place`` is a
    text that holds the phrase, by the smallest id it has, and the byte where it
    stands there. The second has ``lang, words``.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    rows = df.select(F.xxhash64(text).alias("doc"), lang.alias("lang"), text.alias("text"))

    def counted(pick: Callable, name: str) -> DataFrame:
        found = rows.mapInArrow(count_prints(pick, s), "lang string, n int, print long, f long, mass long, doc long, span long")
        sums = [F.sum(c).alias(c) for c in ("f", "mass")]
        total = found.groupBy("lang", "n", "print").agg(*sums, F.first("doc").alias("doc"), F.first("span").alias("span"))
        return stored(total.where((F.col("n") == 0) | (F.col("f") >= s.least)), name)

    words = counted(all_words, "phrase-words")
    pairs = counted(of_frequent(build_filter(words.where("n = 1"), s), 1, range(2, 3)), "phrase-pairs")
    longer = counted(of_frequent(build_filter(pairs.where("n = 2"), s), 2, range(3, LONGEST + 1)), "phrase-longer")
    frequent = words.unionByName(pairs).unionByName(longer).where("n > 0")

    # one text for each hash; copies fold before they travel
    docs = df.select(F.xxhash64(text).alias("doc"), text.alias("text"), F.col(f"`{id_col}`").alias("id"))
    docs = docs.groupBy("doc").agg(F.first("text").alias("text"), F.min("id").alias("id"))
    at, size = F.shiftright("span", 32).cast("int"), F.col("span").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    place = F.struct("id", at.alias("at")).alias("place")
    there = F.substring(F.col("text").cast("binary"), at + 1, size).cast("string")
    phrase = F.regexp_replace(ascii_lower(there), r"[\x20\x09]+", " ").alias("phrase")
    read = frequent.join(docs, "doc").select("lang", "n", "print", "f", "mass", phrase, place)
    kind = T.StructType([*read.schema.fields, T.StructField("sound", T.BooleanType())])
    checked = stored(read.mapInArrow(verified(s), kind), "phrases-read")
    sound = checked.where("sound").select("lang", "n", "phrase", "f", "place")
    unsound = checked.where("not sound")
    if not unsound.isEmpty():
        recount = rows.mapInArrow(read_phrases(build_filter(unsound, s), s), "lang string, n int, phrase string, f long, doc long, span long")
        total = recount.groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f"), F.first("doc").alias("doc"), F.first("span").alias("span"))
        placed = total.where(F.col("f") >= s.least).join(docs, "doc").select("lang", "n", "phrase", "f", place)
        both = sound.unionByName(placed)  # the filter may know sound ones, too: the same text, the same count
        sound = stored(both.groupBy("lang", "n", "phrase").agg(F.max("f").alias("f"), F.min("place").alias("place")), "phrases")
    return sound, words.where("n = 0").select("lang", F.col("f").alias("words"))


def wide(name: str) -> Column:
    """A count as a number whose products stay exact."""
    return F.col(name).cast("decimal(20,0)")


def collocations(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 s: PhraseSettings = PhraseSettings()) -> DataFrame:  # fmt: skip  # noqa: B008
    """The phrases of each language whose words hold together best.

    Returns ``lang, rank, phrase, a, l, r, n, score, place``: occurrences of the
    phrase and of the two parts of its weakest cut, all words of the language,
    the score of that cut, and a place where the phrase stands. A null language
    is ``und``, a null text an empty one; repeated rows count as often as they
    occur, null ids count like others. An empty table gives no rows.
    """
    found, words = frequent_phrases(df, id_col, text_col, lang_col, s)
    word = F.split("phrase", " ")
    join = lambda start, size: F.array_join(F.slice(word, start, size), " ")
    many = found.where("n > 1")
    k = F.col("k")
    cuts = many.select("lang", "phrase", "n", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", join(F.lit(1), k).alias("left"), join(k + 1, F.col("n") - k).alias("right"))
    left = found.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = found.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    score = F.expr(f"cast({s.scale} as decimal(8,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score)
    weakest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))

    size, at = F.col("size"), F.col("at")
    inner = many.where("n > 2").select("lang", "phrase", "n", "f", F.explode(F.sequence(F.lit(2), F.col("n") - 1)).alias("size"))
    inner = inner.select("lang", "phrase", "f", "size", F.explode(F.sequence(F.lit(1), F.col("n") - size + 1)).alias("at"))
    inner = inner.select("lang", join(at, size).alias("phrase"), "f")
    longer = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))

    kept = weakest.select("lang", "phrase", "cut.*").join(longer, ["lang", "phrase"], "left")
    kept = kept.where(F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * s.covered))
    # ranked in parts first, so that what meets in one task is bounded, however many phrases there are
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(s.spread))).orderBy(*order)
    ahead = kept.withColumn("ahead", F.row_number().over(part)).where(F.col("ahead") <= s.top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    best = ahead.withColumn("rank", rank).where(F.col("rank") <= s.top)
    out = best.join(words, "lang").join(found.select("lang", "phrase", "place"), ["lang", "phrase"])
    return out.select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score", "place")

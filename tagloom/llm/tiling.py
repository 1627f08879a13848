"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items meet where they share a short run of words. For
each such pair the longest common runs are marked again and again, none
overlapping another, by running Karp-Rabin: hashes of all unmarked runs of one
length are compared, longer lengths first. The share of an item's words that
tiles cover does not depend on the order in which a document brings its
passages, so reordered items are caught.

Documents are not shuffled. Items are taken in blocks of bounded size, each
block held by every task that reads documents. If there are several, each has
a run of its own, which writes what it hits before the next one starts: tasks
hold one block and the driver at most two.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import id_and_text, stored
from tagloom.llm.words import WordHasher, rolling

HITS = "array<struct<item_id:long,coverage:double,tiles:int>>"


@dataclass(frozen=True)
class TilingSettings:
    least: int = 5  # words of a tile, and of a seed
    first: int = 40  # length looked for first
    coverage: float = 0.8  # share of an item's words from which a document is contaminated
    block_words: int = 2_000_000  # of the items one task holds


def scan(
    item: np.ndarray, doc: np.ndarray, item_free: np.ndarray, doc_free: np.ndarray, item_hash: np.ndarray, doc_hash: np.ndarray, size: int
) -> tuple[list[tuple[int, int, int]], int]:
    """Longest common unmarked runs through equal hashes of ``size`` words, and the greatest length."""
    whole = lambda free: np.convolve(free, np.ones(size, dtype=np.int64), "valid") == size
    i_at, d_at = np.flatnonzero(whole(item_free)), np.flatnonzero(whole(doc_free))
    table: dict[int, list[int]] = {}
    for i in i_at.tolist():
        table.setdefault(int(item_hash[i]), []).append(i)
    near = d_at[np.isin(doc_hash[d_at], item_hash[i_at])]
    found, longest = [], 0
    ends: dict[int, int] = {}  # per diagonal, where the last run ends: shorter ones within it are skipped
    for d in near.tolist():
        for i in table.get(int(doc_hash[d]), ()):
            if ends.get(d - i, 0) > d:
                continue
            n = min(len(item) - i, len(doc) - d)
            same = (item[i : i + n] == doc[d : d + n]) & item_free[i : i + n] & doc_free[d : d + n]
            stop = np.flatnonzero(~same)
            k = int(stop[0]) if len(stop) else n
            if k >= size:
                ends[d - i] = d + k
                found.append((k, i, d))
                longest = max(longest, k)
    return found, longest


def tile(item: np.ndarray, doc: np.ndarray, s: TilingSettings) -> list[tuple[int, int, int]]:
    """Tiles ``(length, place in item, place in document)``, longest first; ties by place."""
    least = min(s.least, len(item))
    item_free, doc_free = np.ones(len(item), dtype=bool), np.ones(len(doc), dtype=bool)
    size, tiles = max(least, min(s.first, len(item), len(doc))), []
    while least <= size <= len(doc):
        found, longest = scan(item, doc, item_free, doc_free, rolling(item, size), rolling(doc, size), size)
        if longest > 2 * size:  # much longer runs come first
            size = min(longest, len(item), len(doc))
            continue
        again = False
        for k, i, d in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            if item_free[i : i + k].all() and doc_free[d : d + k].all():
                item_free[i : i + k] = False
                doc_free[d : d + k] = False
                tiles.append((k, i, d))
            else:
                again = True  # what is left of it may still hold a run
        if again:
            continue
        if size == least:
            break
        size = max(least, size // 2)
    return tiles


class Items:
    """A block of benchmark items with its seeds."""

    def __init__(self, rows: list[tuple[int, str]], s: TilingSettings):
        self.s = s
        self.hasher = WordHasher(fold=True)
        words = [(i, self.hasher.of(t)) for i, t in rows]
        self.items = [(i, w) for i, w in words if len(w)]
        seeds, owner, place = [], [], []
        self.short: dict[int, list[int]] = {}  # items below the seed length, by their one run
        for n, (_, w) in enumerate(self.items):
            if len(w) < s.least:
                self.short.setdefault(len(w), []).append(n)
                continue
            h = rolling(w, s.least)
            seeds.append(h)
            owner.append(np.full(len(h), n))
            place.append(np.arange(len(h)))
        none = np.empty(0, dtype=np.uint64)
        seeds_ = np.concatenate(seeds) if seeds else none
        order = np.argsort(seeds_, kind="stable")
        self.seeds = seeds_[order]
        self.owner = np.concatenate(owner)[order] if owner else none.astype(np.int64)
        self.place = np.concatenate(place)[order] if place else none.astype(np.int64)

    def hits(self, text: str) -> list[tuple[int, float, int]]:
        """Items whose words the text's tiles cover far enough: id, coverage, number of tiles."""
        doc = self.hasher.of(text)
        out = []
        for n in self.candidates(doc):
            item_id, item = self.items[n]
            tiles = tile(item, doc, self.s)
            share = sum(k for k, _, _ in tiles) / len(item)
            if share >= self.s.coverage:
                out.append((item_id, share, len(tiles)))
        return sorted(out, key=lambda h: (-h[1], h[0]))

    def candidates(self, doc: np.ndarray) -> list[int]:
        """Items whose shared seeds alone could cover enough of them."""
        found = []
        for size, members in self.short.items():
            runs = set(rolling(doc, size).tolist())
            found += [n for n in members if int(rolling(self.items[n][1], size)[0]) in runs]
        runs = rolling(doc, self.s.least)
        if not len(runs) or not len(self.seeds):
            return sorted(found)
        at = np.minimum(np.searchsorted(self.seeds, runs), len(self.seeds) - 1)
        shared = np.unique(runs[self.seeds[at] == runs])
        if not len(shared):
            return sorted(found)
        lo, hi = np.searchsorted(self.seeds, shared, "left"), np.searchsorted(self.seeds, shared, "right")
        rows = np.concatenate([np.arange(a, b) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)])
        for n in np.unique(self.owner[rows]).tolist():
            covered = np.zeros(len(self.items[n][1]), dtype=bool)
            for p in self.place[rows[self.owner[rows] == n]].tolist():
                covered[p : p + self.s.least] = True
            if covered.mean() >= self.s.coverage:
                found.append(n)
        return sorted(found)


def blocks_of(benchmark: DataFrame, s: TilingSettings, item_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """Benchmark items in blocks of bounded size, as rows arrive."""
    rows = id_and_text(benchmark, item_col, text_col).where(F.col(item_col).isNotNull())
    block: list[tuple[int, str]] = []
    size = 0
    for item, text in rows.distinct().orderBy(item_col, "text").toLocalIterator():
        words = text.count(" ") + text.count("\n") + 1
        if block and size + words > s.block_words:
            yield block
            block, size = [], 0
        block.append((int(item), text))
        size += words
    if block:
        yield block


def find_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    settings: TilingSettings = TilingSettings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Documents that hold benchmark items, in whatever order of passages.

    Returns one row per input row: the id, ``contaminated``, ``item_id`` and
    ``coverage`` of the item covered most (ties to the smaller id; null
    without one) and ``hits``, all items covered far enough. Words are
    compared with A-Z lower-cased. Items shorter than a tile must occur whole;
    items without words or id match nothing, as do null and empty texts.
    Repeated rows stay; other columns are not carried. Without items no
    document is contaminated.
    """
    s = settings
    rows = id_and_text(docs, id_col, text_col)

    def hits_of(block: list[tuple[int, str]], frame: DataFrame) -> DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(block, s)
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.int32())]))
            for batch in batches:
                found = []
                for text, before in zip(batch.column(1), batch.column(2), strict=True):
                    new = items.hits(text.as_py())
                    found.append(before.as_py() + [dict(zip(("item_id", "coverage", "tiles"), h, strict=True)) for h in new])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(found, kind)], names=[id_col, "text", "hits"]
                )

        schema = f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, text string, hits {HITS}"
        return frame.mapInArrow(run, schema)

    rows_of = rows.withColumn("hits", F.array().cast(HITS))
    blocks = blocks_of(benchmark, s, item_col, item_text_col)
    pending = list(islice(blocks, 2))
    if len(pending) < 2:
        found = hits_of(pending[0], rows_of) if pending else rows_of
    else:
        # Hits depend on the text alone, so those of a block are kept once for each text that has some.
        parts, n = None, 0
        while pending:
            hit = hits_of(pending.pop(0), rows_of).where(F.size("hits") > 0)
            hit = hit.groupBy(F.sha2("text", 256).alias("key")).agg(F.first("hits").alias("hits"))
            part = stored(hit.select("key", F.lit(n).alias("block"), "hits"), "tiling-hits")
            parts = part if parts is None else parts.union(part)
            pending += islice(blocks, 1)
            n += 1
        merged = parts.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("block", "hits"))).alias("of"))
        merged = merged.select("key", F.flatten("of.hits").alias("hits"))
        keyed = rows.select(id_col, F.sha2("text", 256).alias("key"))
        found = keyed.join(merged, "key", "left").select(id_col, F.coalesce("hits", F.array().cast(HITS)).alias("hits"))
    best = F.try_element_at(
        F.array_sort("hits", lambda a, b: F.when(a["coverage"] > b["coverage"], -1).when(a["coverage"] < b["coverage"], 1)
                     .when(a["item_id"] < b["item_id"], -1).when(a["item_id"] > b["item_id"], 1).otherwise(0)), F.lit(1)
    )
    return found.select(
        id_col, (F.size("hits") > 0).alias("contaminated"), best["item_id"].alias("item_id"),
        best["coverage"].alias("coverage"), "hits",
    )

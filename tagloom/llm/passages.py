"""Repeated passages across documents, by sharded Aho-Corasick automata.

A window is so many consecutive words. Each window has an anchor, the smallest
hash of the short word runs in it, so equal windows have equal anchors. Anchors
that occur more than once tell which stretches of a document may be repeated;
every anchor belongs to the first document that has it, and stretches go to
the shard of that document. A shard confirms the windows that recur, compiles
them into an automaton over words, and streams its stretches through it; each
occurrence but the first of a window is marked.

A document whose passages occur very often has its stretches spread over many
shards. Those first reduce their windows to one row each, the rows meet in an
aggregation, and the confirmed windows go to all shards of that document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import id_and_text, stored
from tagloom.llm.words import TextWords, rolling

RANGES = "array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class PassageSettings:
    window: int = 20  # words
    gram: int = 4  # words of an anchor
    load: int = 20_000  # anchor occurrences of one shard
    patterns: int = 50_000  # windows compiled into one automaton
    piece: int = 1 << 22  # bytes of texts handled at once


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every run of ``width`` values, by doubling."""
    size, out = 1, values
    while size < width:
        step = min(size, width - size)
        out = pick(out[:-step], out[step:])
        size += step
    return out


def window_anchors(words: np.ndarray, s: PassageSettings) -> tuple[np.ndarray, np.ndarray]:
    """Anchor of each window, and hashes of the short runs."""
    grams = rolling(words, s.gram)
    return sliding(grams, s.window - s.gram + 1, np.minimum), grams


def inside_text(text: np.ndarray, count: int) -> np.ndarray:
    """Whether each window stays in one text, for the numbers of the texts of all words."""
    return text[:count] == text[len(text) - count :]


def anchors_of(words: np.ndarray, text: np.ndarray, s: PassageSettings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct anchors of texts, and their texts; those at more than one place of a text come twice."""
    if len(words) < s.window:
        return text[:0], words[:0]
    low, grams = window_anchors(words, s)
    low = np.where(inside_text(text, len(low)), low, np.uint64(0))
    wide = s.window - s.gram
    # A short run is an anchor if it is the smallest of some window around it.
    around = sliding(np.concatenate([low[:1].repeat(wide) * 0, low, low[:1].repeat(wide) * 0]), wide + 1, np.maximum)
    at = np.flatnonzero(around == grams)
    at = at[np.lexsort((grams[at], text[at]))]
    values, of = grams[at], text[at]
    again = np.concatenate([[False], (values[1:] == values[:-1]) & (of[1:] == of[:-1])])[: len(at)]
    kept = ~(again & np.concatenate([[False], again[:-1]])[: len(at)])
    return of[kept], values[kept]


def lane_of_runs(anchor: np.ndarray, text: np.ndarray, lane_anchor: np.ndarray, lane_text: np.ndarray) -> np.ndarray:
    """Which lane each anchor of a text has, -1 for none."""
    known = np.unique(lane_anchor)
    place = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
    keys = lane_text * len(known) + np.searchsorted(known, lane_anchor)
    order = np.argsort(keys, kind="stable")
    wanted = text * len(known) + place
    lane = order[np.minimum(np.searchsorted(keys, wanted, sorter=order), len(keys) - 1)]
    return np.where((known[place] == anchor) & (keys[lane] == wanted), lane, -1)


def stretches(
    words: np.ndarray, text: np.ndarray, lane_text: np.ndarray, lane_anchor: np.ndarray, lane: tuple[np.ndarray, ...], s: PassageSettings
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of windows of a text whose anchors have the same lane: an entry of the lane, first words, ends."""
    if len(words) < s.window or not len(lane_anchor):
        return (np.empty(0, np.int64),) * 3
    low = window_anchors(words, s)[0].view(np.int64)
    at = np.flatnonzero(inside_text(text, len(low)))
    low, of = low[at], text[at]
    new = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (of[1:] != of[:-1])])[: len(at)])
    found = lane_of_runs(low[new], of[new], lane_anchor, lane_text)
    same = (found[1:] >= 0) & (found[:-1] >= 0) & (of[new[1:]] == of[new[:-1]])
    for column in lane:
        same &= column[found[1:]] == column[found[:-1]]
    begins = np.flatnonzero((found >= 0) & ~np.concatenate([[False], same])[: len(new)])
    ends = np.flatnonzero((found >= 0) & ~np.concatenate([same, [False]])[: len(new)])
    last = np.append(new[1:], len(at))[ends] - 1
    return found[begins], at[new[begins]], at[last] + s.window


def cut_out(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Hashes of runs of words, as bytes."""
    size = end - start
    ends = np.concatenate([[0], np.cumsum(size)])
    picked = words[np.arange(ends[-1]) + np.repeat(start - ends[:-1], size)]
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer((8 * ends).astype(np.int32)), pa.py_buffer(picked)])


def pieces(batches: Iterable[pa.RecordBatch], s: PassageSettings) -> Iterator[pa.RecordBatch]:
    """Rows whose texts (the second column) have a bounded number of bytes, a longer text alone."""
    for batch in batches:
        size = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
        ends, lo = np.cumsum(size, dtype=np.int64), 0
        while lo < len(ends):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - size[lo] + s.piece, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def texts_of_lists(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of the row of each entry of lists (null: empty), and the entries."""
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), size), lists.flatten()


class Windows:
    """All windows of the stretches of one group, which lie one after another in ``words``.

    ``inside`` says at which words a window starts that stays in its stretch;
    ``hash``, ``id`` and ``at`` (its place in the document) go by word.
    """

    def __init__(self, pdf: pd.DataFrame, s: PassageSettings):
        self.s = s
        self.words = np.frombuffer(b"".join(pdf["words"]), dtype=np.uint64)
        size = np.array([len(b) // 8 for b in pdf["words"]])
        first = np.repeat(np.cumsum(size) - size, size)
        count = len(self.words) - s.window + 1
        place = (np.arange(len(self.words)) - first)[:count]
        self.inside = place <= np.repeat(size, size)[:count] - s.window
        self.hash = rolling(self.words, s.window)
        self.id = np.repeat(pdf["id"].to_numpy(), size)[:count]
        self.at = place + np.repeat(pdf["start"].to_numpy(), size)[:count]

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Words at which distinct windows start first, and numbers of occurrences."""
        own = np.flatnonzero(self.inside)
        own = own[np.lexsort((self.at[own], self.id[own], self.hash[own]))]
        h = self.hash[own]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        return own[first], np.diff(np.append(first, len(h)))

    def rows(self, starts: np.ndarray) -> np.ndarray:
        """Words of the windows that start at some words."""
        return self.words[starts[:, None] + np.arange(self.s.window)]


def as_text(words: np.ndarray) -> str:
    """Words as the letters an automaton reads, one per word, by three bits of the hash.

    Nodes of an automaton look for their children one by one, so a small
    alphabet keeps it fast; whole windows are confirmed by their 64-bit hash.
    """
    return ((words >> np.uint64(61)).astype(np.uint8) + np.uint8(48)).tobytes().decode("latin-1")


def automata(phrases: np.ndarray, s: PassageSettings) -> Iterator[ahocorasick.Automaton]:
    """Automata over all phrases (rows of words), a bounded number in each."""
    for lo in range(0, len(phrases), s.patterns):
        text = as_text(phrases[lo : lo + s.patterns].ravel())
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        # In order, what two neighbours share is still at hand when it is looked for.
        for phrase in sorted(text[at : at + s.window] for at in range(0, len(text), s.window)):
            automaton.add_word(phrase)
        automaton.make_automaton()
        yield automaton


def marked_ranges(
    seen: Windows, phrases: np.ndarray, hashes: np.ndarray, ids: np.ndarray, starts: np.ndarray, s: PassageSettings
) -> pd.DataFrame:
    """Ranges of words that phrases cover, first occurrences left out, in all stretches of a group.

    ``hashes``, ``ids`` and ``starts`` are those of the phrases and their first
    occurrences. What an automaton finds across the ends of two stretches is
    no window and drops out.
    """
    text = as_text(seen.words)
    found = [np.empty(0, np.int64)]
    for automaton in automata(phrases, s):
        found.append(np.fromiter((end for end, _ in automaton.iter(text)), dtype=np.int64) - s.window + 1)
    at = np.unique(np.concatenate(found))
    at = at[seen.inside[at]]
    if not len(at):
        return pd.DataFrame({"id": at, "start": at, "end": at}).astype({"start": "int32", "end": "int32"})
    order = np.argsort(hashes, kind="stable")
    hashes, ids, starts = hashes[order], ids[order], starts[order]
    phrase = np.minimum(np.searchsorted(hashes, seen.hash[at]), len(hashes) - 1)
    doc, start = seen.id[at], seen.at[at]
    later = (ids[phrase] < doc) | ((ids[phrase] == doc) & (starts[phrase] < start))
    chosen = np.flatnonzero((hashes[phrase] == seen.hash[at]) & later)
    chosen = chosen[np.lexsort((start[chosen], doc[chosen]))]
    doc, start = doc[chosen], start[chosen]
    cut = np.flatnonzero((doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + s.window)) + 1
    low, high = np.concatenate([[0], cut])[: len(doc)], np.concatenate([cut - 1, [len(doc) - 1]])[: len(doc)]
    return pd.DataFrame({"id": doc[low], "start": start[low], "end": start[high] + s.window}).astype({"start": "int32", "end": "int32"})


def repeated_ranges(docs: DataFrame, settings: PassageSettings = PassageSettings()) -> DataFrame:
    """``id, ranges`` of the documents ``docs(id, text)`` with words that windows repeated from earlier cover.

    Ranges count words, the end is exclusive; those of one document may
    overlap. Earlier is a smaller id, or a smaller start in the same document.
    """
    s = settings

    def anchor_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, s):
            texts = TextWords(batch.column(1))
            of, anchors = anchors_of(texts.hashes(), texts.text_of(), s)
            ids = batch.column(0).to_numpy()[of]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(anchors.view(np.int64))], names=["id", "anchor"])

    usable = docs.where("id is not null")
    anchors = stored(usable.mapInArrow(anchor_rows, "id long, anchor long"), "anchors")
    suspects = stored(
        anchors.groupBy("anchor").agg(F.count("*").alias("n"), F.min("id").alias("owner")).where("n > 1"), "suspects"
    )
    loads = suspects.groupBy("owner").agg(F.sum("n").alias("load"))
    total = suspects.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    lanes = max(1, -(-total // s.load))
    # Owners of little load share lanes by number; the lanes of others carry the owner and a part.
    salts = F.when(F.col("load") > s.load, F.ceil(F.col("load") / s.load)).otherwise(0).cast("int")
    owners = loads.select("owner", salts.alias("salts"))
    owned = suspects.join(owners, "owner").select("anchor", "owner", "salts")
    part = F.when(F.col("salts") > 0, F.pmod(F.xxhash64("id"), F.col("salts"))).otherwise(
        F.pmod(F.xxhash64("owner"), F.lit(lanes))
    )
    shared = F.col("salts") == 0
    wanted = (
        anchors.join(owned, "anchor")
        .select("id", F.struct("anchor", F.when(shared, 0).otherwise(F.col("owner")).alias("owner"),
                               part.cast("int").alias("part"), (~shared).alias("hot")).alias("lane"))
        .groupBy("id").agg(F.collect_set("lane").alias("lanes"))
    )

    def stretch_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, s):
            texts = TextWords(batch.column(1))
            of, lanes = texts_of_lists(batch.column(2))
            anchor, *lane = (lanes.field(k).to_numpy(zero_copy_only=False) for k in ("anchor", "owner", "part", "hot"))
            words, text = texts.hashes(), texts.text_of()
            entry, start, end = stretches(words, text, of, anchor, tuple(lane), s)
            row = text[start]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x[entry]) for x in lane), pa.array(batch.column(0).to_numpy()[row]),
                 pa.array((start - texts.first[row]).astype(np.int32)), cut_out(words, start, end)],
                names=["owner", "part", "hot", "id", "start", "words"],
            )

    runs = stored(
        usable.join(wanted, "id").select("id", "text", "lanes").mapInArrow(
            stretch_rows, "owner long, part int, hot boolean, id long, start int, words binary"
        ),
        "stretches",
    )

    def local_windows(pdf: pd.DataFrame) -> pd.DataFrame:
        seen = Windows(pdf, s)
        first, times = seen.distinct()
        return pd.DataFrame({
            "owner": pdf["owner"].iloc[0], "hash": seen.hash[first].astype(np.int64), "n": times.astype(np.int64),
            "id": seen.id[first], "start": seen.at[first], "words": [r.tobytes() for r in seen.rows(first)],
        })

    hot = runs.where("hot")
    phrases = (
        hot.groupBy("owner", "part").applyInPandas(local_windows, "owner long, hash long, n long, id long, start int, words binary")
        .groupBy("owner", "hash").agg(F.sum("n").alias("n"), F.min(F.struct("id", "start", "words")).alias("first")).where("n > 1")
        .join(F.broadcast(owners.where("salts > 0")), "owner")  # at most one owner for every ``load`` occurrences
        .select(F.col("owner").alias("of_owner"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("of_part"),
                F.lit(True).alias("of_hot"), "hash", "first.id", "first.start", "first.words")
    )

    def mark(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return right[["id", "start"]].head(0).assign(end=0).astype({"id": "int64", "start": "int32", "end": "int32"})
        seen = Windows(left, s)
        if left["hot"].iloc[0]:
            rows = np.frombuffer(b"".join(right["words"]), dtype=np.uint64).reshape(-1, s.window)
            first = right["hash"].to_numpy().astype(np.uint64), right["id"].to_numpy(), right["start"].to_numpy()
        else:
            place, times = seen.distinct()
            place = place[times > 1]
            rows, first = seen.rows(place), (seen.hash[place], seen.id[place], seen.at[place])
        return marked_ranges(seen, rows, *first, s)

    marked = runs.groupBy("owner", "part", "hot").cogroup(phrases.groupBy("of_owner", "of_part", "of_hot")).applyInPandas(
        mark, "id long, start int, end int"
    )
    return marked.groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))


def drop_repeated(
    df: DataFrame, settings: PassageSettings = PassageSettings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Remove every word covered by a window that starts earlier, too.

    Returns one row per input row: the id (long), ``n_words``, ``n_removed``
    and ``kept`` (remaining words joined by one space). Null and empty texts
    have no words. Repeated rows stay, count as the same place and do not
    remove each other; further texts under one id count as the same document.
    Rows with a null id keep all their words and count for no other. An empty
    table gives an empty result; other columns are not carried.
    """
    s = settings
    docs = id_and_text(df, id_col, text_col).select(F.col(id_col).cast("long").alias("id"), "text")
    ranges = repeated_ranges(docs, s)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, s):
            texts = TextWords(batch.column(1))
            of, found = texts_of_lists(batch.column(2))
            first, most = texts.first[of], texts.first[of + 1]
            edges = (np.minimum(first + found.field(k).to_numpy(), most) for k in ("start", "end"))
            begun, over = (np.bincount(x, minlength=len(texts.start) + 1) for x in edges)
            gone = np.cumsum(begun - over)[:-1] > 0
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[texts.first])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(texts.first)), pa.array(removed), texts.joined(~gone)],
                names=[id_col, "n_words", "n_removed", "kept"],
            )

    rows = docs.join(ranges, "id", "left").select("id", "text", "ranges")
    return rows.mapInArrow(run, f"`{id_col}` long, n_words long, n_removed long, kept string")

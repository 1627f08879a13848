"""Near-duplicate documents by SetSketch registers.

A document's set of word shingles is reduced to registers: exponentially
distributed minima on a logarithmic scale, truncated at both ends. Registers of
a union are the maxima of the registers, and equal registers are as likely as
the sets are alike. Documents with equal sets are one class. Bands of
registers tie class representatives into clusters; within a cluster the
joint likelihood of two register rows estimates their similarity, and pairs
that may reach the threshold are confirmed on the full sets, best first,
unless they are connected already. Links that survive make the components.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import id_and_text, stored
from tagloom.llm.components import components
from tagloom.llm.words import WordHasher, shingles


@dataclass(frozen=True)
class SketchSettings:
    words: int = 5  # of a shingle
    percent: int = 85  # similarity of linked documents, in hundredths
    bands: int = 32
    rows: int = 8  # registers of a band
    base: float = 1.001  # ratio of neighbouring register values
    rate: float = 20.0
    top: int = 65534  # largest register value but one
    margin: float = 4.0  # standard errors an estimate may lie below the threshold
    block: int = 512  # documents of a cluster that are compared at once
    lane: int = 2000  # documents of small clusters in one group
    seed: int = 3

    @property
    def registers(self) -> int:
        return self.bands * self.rows


# The similarity of stages on word shingles; more and shorter bands, as pairs at 0.80 share fewer registers.
FOUR_FIFTHS = SketchSettings(percent=80, bands=42, rows=6)


def multipliers(s: SketchSettings) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(s.seed)
    return (
        rng.integers(0, 1 << 31, s.registers, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
        rng.integers(0, 1 << 32, s.registers, dtype=np.uint32),
    )


def registers(items: np.ndarray, s: SketchSettings, factors: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Registers of a set of 64-bit hashes; all zero for the empty set."""
    if not len(items):
        return np.zeros(s.registers, dtype=np.uint16)
    low = np.full(s.registers, np.iinfo(np.uint32).max, dtype=np.uint32)
    half = (items >> np.uint64(32)).astype(np.uint32)
    times, plus = factors
    with np.errstate(over="ignore"):
        for lo in range(0, len(half), 512):
            np.minimum(low, ((half[lo : lo + 512, None] ^ plus) * times).min(axis=0), out=low)
    least = -np.log1p(-(low + 0.5) / 2.0**32) / s.rate  # smallest of exponentially distributed values
    return np.clip(np.floor(1 - np.log(least) / np.log(s.base)), 0, s.top + 1).astype(np.uint16)


def similarity(greater: np.ndarray, less: np.ndarray, n: float, others: np.ndarray, s: SketchSettings) -> np.ndarray:
    """Jaccard similarity of greatest joint likelihood.

    ``greater`` and ``less`` count registers of one set that are above and
    below those of each of the others; the sets' sizes are known.
    """
    m, scale = s.registers, (s.base - 1) / s.base
    u, v = n / (n + others), others / (n + others)
    spread = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * scale) / np.log(s.base)

    def slope(j: np.ndarray) -> np.ndarray:
        """Derivative of the log-likelihood."""
        a, b = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
        pa_, pb = spread(a), spread(b)
        da = -v * scale / (1 - a * scale) / np.log(s.base)
        db = -u * scale / (1 - b * scale) / np.log(s.base)
        rest = np.maximum(1 - pa_ - pb, 1e-12)
        return greater * da / pa_ + less * db / pb - (m - greater - less) * (da + db) / rest

    low, high = np.zeros_like(v), np.minimum(u / v, v / u)
    for _ in range(24):  # the log-likelihood is concave: halve towards its top
        mid = (low + high) / 2
        up = slope(mid) > 0
        low, high = np.where(up, mid, low), np.where(up, high, mid)
    return (low + high) / 2


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted distinct arrays reach the similarity, exactly."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


class Forest:
    """Union-find over places of a list."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.top(i), self.top(j)
        self.up[max(a, b)] = min(a, b)
        return a != b


def confirmed(sets: list[np.ndarray], regs: np.ndarray, left: np.ndarray, right: np.ndarray, s: SketchSettings) -> list[tuple[int, int]]:
    """Links between ``left`` and ``right`` places that connect what was not connected."""
    sizes = np.array([len(x) for x in sets], dtype=float)
    t = s.percent / 100
    limit = t - s.margin * np.sqrt(t * (1 - t) / s.registers)
    pairs, guesses = [], []
    for i in left:
        others = right[right > i] if right is left else right
        others = others[(sizes[others] >= t * sizes[i]) & (sizes[i] >= t * sizes[others])]
        if not len(others):
            continue
        rows = regs[others]
        greater, less = (regs[i] > rows).sum(axis=1), (regs[i] < rows).sum(axis=1)
        near = np.flatnonzero(s.registers - greater - less >= (limit - 0.1) * s.registers)
        if len(near):
            guess = similarity(greater[near], less[near], sizes[i], sizes[others[near]], s)
            good = guess >= limit
            guesses.append(guess[good])
            pairs.append(np.stack([np.full(good.sum(), i), others[near][good]], axis=1))
    if not pairs:
        return []
    pairs, guesses = np.concatenate(pairs), np.concatenate(guesses)
    forest, out = Forest(len(sets)), []
    for i, j in pairs[np.argsort(-guesses, kind="stable")].tolist():
        if forest.top(i) != forest.top(j) and linked(sets[i], sets[j], s.percent):
            forest.join(i, j)
            out.append((i, j))
    return out


def sketches(df: DataFrame, s: SketchSettings) -> DataFrame:
    """``id, n, digest, bands`` of every row of ``df(id, text)``; a digest stands for a shingle set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, factors = WordHasher(fold=True), multipliers(s)
        for batch in batches:
            n, digest, bands = [], [], []
            for text in batch.column(1):
                items = shingles(hasher.of(text.as_py()), s.words)
                n.append(len(items))
                digest.append(xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None)
                regs = registers(items, s, factors).reshape(s.bands, s.rows)
                bands.append([xxhash.xxh3_64_intdigest(r.tobytes(), seed=i) - (1 << 63) for i, r in enumerate(regs)] if len(items) else [])
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, k) for x, k in zip((n, digest, bands), kinds, strict=True))],
                names=["id", "n", "digest", "bands"],
            )

    return df.mapInArrow(run, "id long, n long, digest binary, bands array<long>")


def near_duplicates(
    df: DataFrame, settings: SketchSettings = FOUR_FIFTHS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Components of documents linked by similar shingle sets.

    Returns one row per input row: the id (long), ``n_shingles``,
    ``component_id`` (smallest id reachable, its own included) and ``kept``
    (id = component_id). Texts with fewer words than a shingle are one
    shingle; null texts and texts without words have none and link with
    nothing. Rows with the same id count as one document with several texts.
    A null id links with nothing, has a null component and is kept. An empty
    table gives an empty result; other columns are not carried.

    A pair at the threshold shares no band with a probability of
    ``(1 - t ** rows) ** bands``, 3 in a million as set (4 in 100,000 by
    ``SketchSettings()`` at 0.85), and is then only found through others of
    its group.
    """
    s = settings
    source = id_and_text(df, id_col, text_col).select(F.col(id_col).cast("long").alias("id"), "text")
    rows = stored(sketches(source, s), "sketches")
    classes = rows.where("digest is not null and id is not null").groupBy("digest").agg(
        F.min("id").alias("rep"), F.first("bands").alias("bands"), F.count("*").alias("copies")
    )
    keyed = classes.select("rep", F.posexplode("bands").alias("band", "value"))
    stars = keyed.groupBy("band", "value").agg(F.min("rep").alias("low"), F.count("*").alias("n")).where("n > 1").drop("n")
    rough = keyed.join(stars, ["band", "value"]).where("rep > low").select(F.col("rep").alias("a"), F.col("low").alias("b"))
    clusters = stored(components(rough, "clusters").withColumnRenamed("component", "cluster"), "clusters")
    links = stored(confirm_clusters(source, classes.select("digest", "rep"), clusters, s), "links")
    # Texts that share an id are one document.
    shared = rows.where("digest is not null").select("id", "digest").join(classes.select("digest", "rep"), "digest")
    shared = shared.groupBy("id").agg(F.min("rep").alias("b"), F.max("rep").alias("a")).where("a > b").select("a", "b")
    found = components(links.union(shared), "components")
    named = classes.join(found, F.col("rep") == F.col("id"), "left").select(
        "digest", F.coalesce("component", "rep").alias("component")
    )
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return rows.join(named, "digest", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def confirm_clusters(source: DataFrame, classes: DataFrame, clusters: DataFrame, s: SketchSettings) -> DataFrame:
    """Confirmed links ``a, b`` that connect representatives of the same cluster.

    Clusters up to the block size share groups; larger ones are cut into
    blocks and each pair of blocks is a group of its own, so no group is
    larger than two blocks or a lane with one block more.
    """
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("size"))
    count = clusters.count()
    lanes = max(1, -(-count // s.lane))
    blocks = F.ceil(F.col("size") / s.block).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda i: F.struct(F.least(i, F.col("own")).alias("i"), F.greatest(i, F.col("own")).alias("j")),
    )
    alone = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    placed = (
        clusters.join(sizes, "cluster").withColumn("blocks", blocks).withColumn("own", own)
        .select("id", "cluster", "own",
                F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(lanes)) - lanes).otherwise(F.col("cluster")).alias("lane"),
                F.explode(F.when(F.col("blocks") == 1, alone).otherwise(pairs)).alias("pair"))
        .select("id", "cluster", "own", "lane", "pair.i", "pair.j")
    )
    wanted = classes.join(clusters, F.col("rep") == F.col("id")).select("id", "digest")

    def sets_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(fold=True)
        for batch in batches:
            ids, sets = [], []
            for i, text, digest in zip(*(batch.column(k) for k in range(3)), strict=True):
                items = shingles(hasher.of(text.as_py()), s.words).tobytes()
                if xxhash.xxh3_128_digest(items) == digest.as_py():
                    ids.append(i.as_py())
                    sets.append(items)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["id", "items"])

    sets = source.join(wanted, "id").select("id", "text", "digest").mapInArrow(sets_of, "id long, items binary")
    sets = sets.dropDuplicates(["id", "items"])

    def links_of(pdf: pd.DataFrame) -> pd.DataFrame:
        factors = multipliers(s)
        out: list[tuple[int, int]] = []
        for _, part in pdf.sort_values(["cluster", "id"], kind="stable").groupby("cluster", sort=False):
            ids, own = part["id"].to_numpy(), part["own"].to_numpy()
            sets = [np.frombuffer(b, dtype=np.uint64) for b in part["items"]]
            regs = np.stack([registers(x, s, factors) for x in sets])
            i, j = int(part["i"].iloc[0]), int(part["j"].iloc[0])
            left = np.flatnonzero(own == i) if i != j else np.arange(len(ids))
            right = np.flatnonzero(own == j) if i != j else left
            out += [(int(ids[a]), int(ids[b])) for a, b in confirmed(sets, regs, left, right, s)]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return placed.join(sets, "id").groupBy("lane", "i", "j").applyInPandas(links_of, "a long, b long")

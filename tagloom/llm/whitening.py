"""Whitened embeddings from exact covariances.

Entries become whole numbers. A first pass adds them up by dimension; a second
adds up the squares of centred entries for every dimension and of the centred
sum of every pair of dimensions. What the variance of a sum exceeds the two
variances by is twice their covariance, so that no product of two dimensions
is ever formed. All sums are exact: tasks keep them in parts of 32 bits and
the parts are added by a shuffle. The matrix they make, whose size depends on
the dimensions only, is decomposed once; vectors are projected where they lie.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HALF = (1 << 32) - 1


@dataclass(frozen=True)
class WhitenSettings:
    components: int = 8
    scale: int = 1024
    shift: int = 100_000
    null_share: float = 1e-12  # of the trace; components below it have no variance to divide by


@dataclass(frozen=True)
class Fit:
    """Exact sums over the vectors a model is fitted on, and what follows from them."""

    n: int
    sums: list[int]
    values: np.ndarray  # of the components, falling
    vectors: np.ndarray  # one component a column
    trace: float


def whole(vectors: pa.Array, s: WhitenSettings) -> np.ndarray:
    """Rows of whole numbers from lists of equal length; Python numbers where 64 bits do not hold them."""
    flat = np.floor(vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) * s.scale)
    big = len(flat) and np.abs(flat).max() >= 1 << 52
    numbers = np.array([int(x) for x in flat], dtype=object) if big else flat.astype(np.int64)
    return (numbers + s.shift).reshape(len(vectors), -1)


def centred(x: np.ndarray, times: int, minus: list[int]) -> np.ndarray:
    """``times * x - minus``, exactly."""
    most = max((abs(int(v)) for v in (x.min(), x.max())), default=0) if x.size else 0
    if x.dtype != object and times * most + max(map(abs, minus), default=0) < 1 << 62:
        return x * times - np.array(minus, dtype=np.int64)
    return x.astype(object) * times - np.array(minus, dtype=object)


def total(x: np.ndarray) -> np.ndarray:
    """Column sums as Python numbers."""
    most = int(np.abs(x).max()) if x.size else 0
    return x.sum(axis=0).astype(object) if most * max(len(x), 1) < 1 << 62 else x.astype(object).sum(axis=0)


def squares(x: np.ndarray) -> np.ndarray:
    most = int(np.abs(x).max()) if x.size else 0
    return total((x if most < 1 << 31 else x.astype(object)) ** 2)


def pair_squares(z: np.ndarray) -> list[int]:
    """Sums of squares of every column and of the sum of every pair of columns: (0), (0, 1), (0, 2), ..., (1), (1, 2), ..."""
    out: list[int] = []
    for i in range(z.shape[1]):
        sums = z[:, i : i + 1] + z[:, i:]
        sums[:, 0] = z[:, i]
        out.extend(int(q) for q in squares(sums))
    return out


def parts(values: Iterable[int]) -> Iterator[tuple[int, int, int]]:
    """Numbers as ``(place, power, part)`` of 32 bits; all parts have the number's sign."""
    for at, value in enumerate(values):
        sign, rest, power = (-1 if value < 0 else 1), abs(int(value)), 0
        while rest:
            yield at, power, sign * (rest & HALF)
            rest, power = rest >> 32, power + 1


def exact_sums(rows: DataFrame, of_batch: Callable[[np.ndarray], list[int]], size: int, s: WhitenSettings) -> list[int]:
    """Sums, over all rows, of the numbers a function gives for a batch of vectors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [0] * size
        for batch in batches:
            if batch.num_rows:
                held = [a + int(b) for a, b in zip(held, of_batch(whole(batch.column("vector"), s)), strict=True)]
        at, power, part = zip(*parts(held), strict=True) if any(held) else ((), (), ())
        yield pa.RecordBatch.from_pydict({
            "at": pa.array(at, pa.int32()), "power": pa.array(power, pa.int32()), "part": pa.array(part, pa.int64())
        })

    found = rows.select("vector").mapInArrow(run, "at int, power int, part long")
    out = [0] * size
    for r in found.groupBy("at", "power").agg(F.sum("part").alias("part")).collect():
        out[r["at"]] += r["part"] << (32 * r["power"])
    return out


def usable(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """Rows that take part, as ``id, vector``, and the number of dimensions."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), vector.alias("vector")).where(vector.isNotNull() & ~bad & (F.size(vector) > 0))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    size = sizes[0]["size"] if sizes else 0
    return rows.where(F.size("vector") == size), size


def fit(rows: DataFrame, size: int, s: WhitenSettings) -> Fit:
    """Components of the covariance of all rows.

    Squares are taken of differences to the whole part of the mean, which are
    short, and carried over to those of the mean itself, which only a fraction can say.
    """
    n, *sums = exact_sums(rows, lambda x: [len(x), *total(x)], size + 1, s)
    near = [t // max(n, 1) for t in sums]
    off = [t - n * m for t, m in zip(sums, near, strict=True)]  # n times the mean of the differences
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    q = exact_sums(rows, lambda x: pair_squares(centred(x, 1, near)), len(pairs), s)
    # n * sum of squares of (n * x - S) = n * (n * (n * q - t * t)), the same for sums of two dimensions
    spread = {(i, j): n * value - (off[i] if i == j else off[i] + off[j]) ** 2 for (i, j), value in zip(pairs, q, strict=True)}
    cov = np.zeros((size, size))
    for i, j in pairs:
        twice = 2 * spread[i, i] if i == j else spread[i, j] - spread[i, i] - spread[j, j]
        cov[i, j] = cov[j, i] = twice / (2 * n * n)
    values, vectors = np.linalg.eigh(cov) if size else (np.zeros(0), np.zeros((0, 0)))
    values, vectors = values[::-1][: s.components], vectors[:, ::-1][:, : s.components]
    for k in range(len(values)):
        vectors[:, k] *= np.sign(vectors[np.argmax(np.abs(vectors[:, k])), k]) or 1
    trace = sum(spread[i, i] for i in range(size))
    return Fit(n, sums, values, vectors, trace / (n * n) if n else 0.0)


def projected(x: np.ndarray, f: Fit, s: WhitenSettings) -> tuple[np.ndarray, np.ndarray]:
    """``n * x - S`` and the whitened components of each row; nan where there is no variance."""
    y = centred(x, f.n, f.sums)
    if not f.trace:
        return y, np.full((len(x), len(f.values)), np.nan)
    seen = f.values > s.null_share * f.trace
    with np.errstate(invalid="ignore", divide="ignore"):
        return y, (y / f.n).astype(float) @ f.vectors / np.where(seen, np.sqrt(np.abs(f.values)), np.nan)


def identity_error(rows: DataFrame, f: Fit, s: WhitenSettings) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    k = len(f.values)

    def moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = projected(whole(batch.column("vector"), s), f, s)[1]
                sums += w.sum(axis=0)
                products += w.T @ w
        yield pa.RecordBatch.from_pydict({"at": np.arange(k + k * k), "value": np.concatenate([sums, products.ravel()])})

    found = rows.select("vector").mapInArrow(moments, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    flat = np.zeros(k + k * k)
    for r in found.collect():
        flat[r["at"]] = r["value"]
    mean = flat[:k] / f.n
    seen = ~np.isnan(mean)
    error = np.abs(flat[k:].reshape(k, k) / f.n - np.outer(mean, mean) - np.eye(k))[np.ix_(seen, seen)]
    return float(error.max()) if error.size else None


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", s: WhitenSettings = WhitenSettings()) -> DataFrame:  # noqa: B008
    """Whitened leading components of every vector, one row each.

    Returns the id, ``component`` (from 1), ``n`` (vectors fitted on),
    ``deviation`` (exact sum of ``(n * x - S) ** 2``; null beyond 64 bits),
    ``whitened``, ``explained`` (share of the variance) and ``identity_error``.
    Vectors that are null, empty, hold null or non-finite entries or have another
    length than most (the shorter of equally common ones) take no part. Repeated rows count as often as
    they occur; ids may be null. A component without variance has no
    ``whitened`` and stays out of ``identity_error``; where there is no variance at all,
    ``explained`` is null, too. An empty table gives no rows.
    """
    rows, size = usable(df, id_col, vector_col)
    f = fit(rows, size, s)
    k = len(f.values)
    error = identity_error(rows, f, s) if f.n else None
    explained = [float(v) / f.trace if f.trace else None for v in f.values]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y, w = projected(whole(batch.column("vector"), s), f, s)
            far = y.astype(object) if y.size and math.isqrt((1 << 63) // size) <= int(np.abs(y).max()) else y
            deviation = [int(d) if d < 1 << 63 else None for d in (far**2).sum(axis=1)]
            rows = len(deviation)
            order = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id").take(pa.array(order)),
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), rows),
                "n": np.full(rows * k, f.n),
                "deviation": pa.array(deviation, pa.int64()).take(pa.array(order)),
                "whitened": pa.array(w.ravel(), from_pandas=True),
                "explained": pa.array(explained * rows, pa.float64()),
                "identity_error": pa.array([error] * (rows * k), pa.float64()),
            })

    kind = dict(rows.dtypes)["id"]
    out = rows.mapInArrow(run, f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return out.withColumnRenamed("id", id_col)

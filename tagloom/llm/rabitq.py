"""Nearest neighbours by largest inner product with randomly rotated one-bit codes.

Every vector is taken relative to the mean, rotated at random and kept as one
sign bit per dimension with two correction scalars. From packed bits an inner
product is estimated with an error bound that holds with high probability.
Vectors whose upper bound reaches the lower bound of the k-th best are
reranked with their exact inner products.

All rows are coded; the only thing fitted is the mean. Queries and vectors are
cut into blocks of bounded size and each pair of blocks is one task's work.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CodeSettings:
    k: int = 20
    query_rows: int = 1024  # of one block of queries
    vector_rows: int = 4096  # of one block of vectors
    epsilon: float = 1.9  # width of the error bound
    seed: int = 7


def rotation(dims: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, distance to the centre, and the code's inner product with its own direction."""
    rest = (vectors - centre) @ turn
    norm = np.sqrt((rest * rest).sum(axis=1))
    bits = rest >= 0
    own = np.abs(rest).sum(axis=1) / (np.where(norm > 0, norm, 1.0) * np.sqrt(rest.shape[1]))
    return np.packbits(bits, axis=1), norm, np.where(norm > 0, own, 1.0)


def estimate(
    queries: np.ndarray, centre: np.ndarray, turn: np.ndarray, packed: np.ndarray, norm: np.ndarray, own: np.ndarray, epsilon: float
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of queries (rows) and coded vectors (columns), and their error bounds."""
    dims = len(centre)
    signs = np.unpackbits(packed, axis=1, count=dims).astype(np.float32) * 2 - 1
    turned = (queries @ turn).astype(np.float32)
    product = (turned @ signs.T) / np.float32(np.sqrt(dims))
    length = np.sqrt((queries * queries).sum(axis=1))
    guess = (queries @ centre)[:, None] + product * (norm / own)[None, :]
    spread = norm * np.sqrt(np.maximum(0.0, 1 - own * own)) / own * (epsilon / np.sqrt(max(1, dims - 1)))
    return guess, length[:, None] * spread[None, :]


def exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed alike."""
    return (vectors * query[None, :]).sum(axis=1)


def search_block(
    q_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, codes: tuple, centre: np.ndarray, turn: np.ndarray, s: CodeSettings
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its k best vectors of the block, by exact inner product and then id."""
    step = max(1, (1 << 22) // max(1, len(ids)))
    for lo in range(0, len(q_ids), step):
        guess, bound = estimate(queries[lo : lo + step], centre, turn, *codes, s.epsilon)
        for i in range(len(guess)):
            q = lo + i
            low = guess[i] - bound[i]
            low[ids == q_ids[q]] = -np.inf
            limit = np.partition(low, len(low) - s.k)[len(low) - s.k] if len(low) > s.k else -np.inf
            near = np.flatnonzero((guess[i] + bound[i] >= limit) & (ids != q_ids[q]))
            score = exact(queries[q], vectors[near])
            best = np.lexsort((ids[near], -score))[: s.k]
            yield q_ids[q], ids[near][best], score[best]


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows ``(id, v)`` whose vectors take part: no null, no null or non-finite component, not all zero."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull())
    return rows.where(F.col("v").isNotNull()).where(finite & F.exists("v", lambda x: x != 0))


def nearest(
    df: DataFrame,
    is_query,
    settings: CodeSettings = CodeSettings(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k nearest rows of every row for which ``is_query(id)`` holds.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``, nearest
    first and ties by the smaller id; a query's own id is no candidate. Rows
    whose vector is null, zero or not finite, or whose id is null, take no
    part; vectors of another length than a query's are no candidates for it.
    Repeated ids count as rows of their own among candidates and are one query
    if their vectors agree. Other columns are not carried. An empty table
    gives an empty result.
    """
    s = settings
    rows = usable(df, id_col, vector_col).withColumn("dims", F.size("v"))
    asked = rows.where(is_query(F.col("id"))).distinct()
    # Block counts follow the row counts, so that blocks keep their size.
    counts = rows.groupBy("dims").agg(F.count("*").alias("n"), F.count_if(is_query(F.col("id"))).alias("q"))
    mean = (
        rows.select("dims", F.posexplode("v").alias("i", "x")).groupBy("dims", "i").agg(F.avg("x").alias("x"))
        .groupBy("dims").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias("centre"))
    )
    lanes = lambda n, size: F.ceil(F.col(n) / size).cast("int")
    plan = counts.join(mean, "dims").select(
        "dims", "centre", lanes("q", s.query_rows).alias("q_lanes"), lanes("n", s.vector_rows).alias("v_lanes")
    )  # one row per vector length
    planned = lambda side: side.join(F.broadcast(plan), "dims")
    place = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    queries = planned(asked).select(
        F.col("dims").alias("of_dims"), place("q_lanes").alias("of_q"),
        F.explode(F.sequence(F.lit(0), F.col("v_lanes") - 1)).alias("of_v"), F.col("id").alias("query_id"), F.col("v").alias("query"),
    )
    vectors = planned(rows).where("q_lanes > 0").select(
        "dims", F.explode(F.sequence(F.lit(0), F.col("q_lanes") - 1)).alias("q_lane"), place("v_lanes").alias("v_lane"),
        "id", "v", "centre",
    )
    key = ["dims", "q_lane", "v_lane"]

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if len(left) and len(right):
            right = right.sort_values("id", kind="stable")
            data = np.array(right["v"].tolist(), dtype=np.float64)
            centre = np.array(right["centre"].iloc[0], dtype=np.float64)
            turn = rotation(data.shape[1], s.seed)
            codes = encode(data, centre, turn)
            asked = np.array(left["query"].tolist(), dtype=np.float64)
            found = search_block(left["query_id"].to_numpy(), asked, right["id"].to_numpy(), data, codes, centre, turn, s)
            for q, ids, score in found:
                out[0].append(np.full(len(ids), q))
                out[1].append(ids)
                out[2].append(score)
        return pd.DataFrame({n: np.concatenate(x) for n, x in zip(("query_id", "vec_id", "score"), out, strict=True)})

    near = queries.groupBy("of_dims", "of_q", "of_v").cogroup(vectors.select(*key, "id", "v", "centre").groupBy(*key)).applyInPandas(
        block, "query_id long, vec_id long, score double"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= s.k).select(
        "query_id", "rank", "vec_id", "score"
    )

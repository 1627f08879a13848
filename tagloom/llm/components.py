"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import stored


def components(edges: DataFrame, name: str) -> DataFrame:
    """``id, component`` for every id in ``edges(a, b)``; the component is its smallest id.

    Large-star and small-star steps alternate until nothing changes: each
    vertex hooks its larger neighbours, then its smaller ones, on the smallest
    it knows. Only minima per vertex meet, so a vertex with very many edges is
    no burden; each round is written to the shared folder.
    """
    oriented = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    now, before = stored(oriented, name), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("id"), F.col("v").alias("component"))
            ).groupBy("id").agg(F.min("component").alias("component"))
        before = mark
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        now = stored(small.union(low.select("u", F.col("m").alias("v"))).distinct(), name)

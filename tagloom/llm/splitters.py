"""Shards of near equal size by sampled splitters, with built-in functions only.

Records are ordered by a hash of their text, equal texts by id. Samples, drawn
the likelier the larger a record is, give the boundaries of many ranges of
about the same load. Ranges are counted exactly; those that come out too full
(a text that very many records share) are cut again by samples of text and id,
and what is still too full then (records that are wholly alike) is dealt out by
number. Running sums within a range and the exact sizes of the ranges before it
say how many bytes lie before a record, and so its shard and its place there.
Copies of a text stay together unless they are more than a hundredth of a shard.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagloom.llm.common import stored


@dataclass(frozen=True)
class ShardSettings:
    shards: int = 24
    ranges: int = 1024  # at least so many ranges
    range_rows: int = 2_000_000  # and one more for so many rows: what a task sorts at once
    samples: int = 16  # expected samples of a range; boundaries are chosen among ranges * samples records
    overfull: float = 2.0  # times the average load, from which a range is cut again
    whole: int = 100  # copies of a text stay together up to this part of a shard
    overhead: int = 8  # bytes a record needs beside its text


def point(key: Column, key_id: Column) -> Column:
    return F.struct(key.alias("key"), key_id.alias("id"))


def numbers(values: Iterable[int]) -> Column:
    """A short list as a constant array."""
    return F.from_json(F.lit(json.dumps(list(values))), "array<bigint>")


def quantiles(rows: DataFrame, at: Column, load: Column, s: ShardSettings, ranges: int, seed: int) -> str:
    """Boundaries of ranges of equal load, as JSON; every ``samples``-th of a sorted sample.

    A row is drawn once or more, on average ``load * ranges * samples`` times;
    what decides is a hash of the row, so that a repeated task draws the same.
    """
    chance = F.pmod(F.xxhash64("key", "id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor(load * (ranges * s.samples) + chance).cast("int")
    drawn = rows.where(copies > 0).select(F.explode(F.array_repeat(at, copies)).alias("at"))
    ordered = F.sort_array(F.collect_list("at"))
    chosen = F.filter(ordered, lambda _, i: i % s.samples == s.samples - 1)
    return drawn.agg(F.to_json(F.array_distinct(chosen)).alias("bounds")).first()["bounds"]


def range_of(at: Column, bounds: Column, size: int) -> Column:
    """How many of the sorted boundaries are not above ``at``; a binary search."""
    steps = numbers(1 << i for i in reversed(range(size.bit_length())))

    def step(found: Column, width: Column) -> Column:
        return F.when(F.get(bounds, (found + width - 1).cast("int")) <= at, found + width).otherwise(found)

    return F.aggregate(steps, F.lit(0).cast("bigint"), step).cast("int")


def shard_rows(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    s: ShardSettings = ShardSettings(),  # noqa: B008
    keep: Sequence[str] = (),
) -> DataFrame:
    """Shard and place of every record.

    Returns the id, ``size`` (bytes of the text and the overhead),
    ``text_crc32``, ``shard`` and ``slot`` (from 0 in each shard, in order), and
    the columns named in ``keep`` as fields of ``row``. A null text is an empty one. Null
    ids come first among copies of a text; records that are alike in text and
    id are interchangeable, each gets a place of its own. An empty table gives
    no rows. More shards than records leave shards empty.

    The driver gets the boundaries and the sizes of ranges, one for every
    ``range_rows`` rows (``ranges`` at least); one task sorts ``samples`` times as many keys.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    columns = [
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(text) + s.overhead).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint").alias("key"),
        F.xxhash64(F.monotonically_increasing_id()).alias("salt"),
    ]
    if keep:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"))
    keyed = stored(df.select(*columns), "shard-keys")
    found = keyed.agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).first()
    rows, total = max(found["rows"], 1), max(found["bytes"] or 0, 1)
    ranges = max(s.ranges, rows // s.range_rows)
    load = (F.col("size") / float(total) + 1.0 / rows) / 2

    kind = f"array<struct<key:bigint,id:{dict(keyed.dtypes)['id']}>>"
    nobody = F.lit(None).cast(dict(keyed.dtypes)["id"])
    coarse = quantiles(keyed, point(F.col("key"), nobody), load, s, ranges, 1)
    bounds, size = F.from_json(F.lit(coarse), kind), len(json.loads(coarse))
    at = point(F.col("key"), F.col("id"))

    def loads() -> list[float]:
        """Load of each range without its largest record, which no boundary can divide."""
        out = [0.0] * (size + 1)
        rest = (F.sum(load) - F.max(load)).alias("rest")
        for r in keyed.groupBy(range_of(at, bounds, size).alias("range")).agg(rest).collect():
            out[r["range"]] = r["rest"]
        return out

    limit = s.overfull / ranges
    full = [int(x > limit) for x in loads()]
    if any(full):
        within = keyed.where(F.get(numbers(full), range_of(at, bounds, size)) == 1)
        fine = quantiles(within, at, load, s, ranges, 2)
        both = F.array_sort(F.array_union(bounds, F.from_json(F.lit(fine), kind)))
        merged = keyed.sparkSession.range(1).select(F.to_json(both).alias("bounds")).first()["bounds"]
        bounds, size = F.from_json(F.lit(merged), kind), len(json.loads(merged))
    parts = [max(1, round(x * ranges)) if x > limit else 1 for x in loads()]
    first = list(accumulate(parts, initial=0))
    place = range_of(at, bounds, size)
    share = F.pmod(F.col("salt"), F.get(numbers(parts), F.col("range")))
    cells = keyed.withColumn("range", place).withColumn("cell", (F.get(numbers(first), F.col("range")) + share).cast("int"))

    counts = [(0, 0)] * first[-1]
    for r in cells.groupBy("cell").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).collect():
        counts[r["cell"]] = (r["rows"], r["bytes"])
    rows_before = numbers(accumulate((c[0] for c in counts), initial=0))
    bytes_before = numbers(accumulate((c[1] for c in counts), initial=0))

    cell = Window.partitionBy("cell")
    so_far = cell.orderBy("key", "id", "salt")
    copies = Window.partitionBy("cell", "key")
    start = F.get(bytes_before, F.col("cell")) + F.sum("size").over(so_far.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    ranked = cells.withColumn("rank", F.get(rows_before, F.col("cell")) + F.row_number().over(so_far) - 1).withColumn("start", start)
    grouped = ranked.withColumn("all", F.sum("size").over(copies)).withColumn("from", F.min("start").over(copies))
    middle = F.when(F.col("all") * (s.shards * s.whole) <= total, 2 * F.col("from") + F.col("all")).otherwise(
        2 * F.col("start") + F.col("size")
    )
    placed = grouped.withColumn("twice", middle * s.shards).withColumn("shard", F.expr(f"int(twice div {2 * total})"))
    firsts = {r["shard"]: r["rank"] for r in placed.groupBy("shard").agg(F.min("rank").alias("rank")).collect()}
    slot = F.col("rank") - F.get(numbers(firsts.get(i, 0) for i in range(s.shards)), F.col("shard"))
    return placed.select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", slot.alias("slot"), *(["row"] if keep else [])
    )


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", s: ShardSettings = ShardSettings()) -> None:  # noqa: B008
    """Write all columns of a table as Parquet, one folder ``shard=N`` for each shard, in the order of the slots.

    Where the table has a column of that name, the folder's name ends with as many underscores as it takes.
    """
    folder = "shard"
    while folder in df.columns:
        folder += "_"
    out = shard_rows(df, id_col, text_col, s, df.columns)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = out.repartitionByRange(tasks, "shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.select(F.col("shard").alias(folder), "row.*").write.partitionBy(folder).parquet(path)

"""The wide table: cells in files or in a catalog table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schema import CELL_ID, CELLS
from ..session import BROADCAST_ROWS, settle


# Row groups say which keys they may hold, so that a lookup skips those that do not have its key.
KEY_FILTER = {"parquet.bloom.filter.enabled#row_key": "true", "parquet.bloom.filter.adaptive.enabled": "true"}

# Bytes of a row group: small enough that skipping one counts.
ROW_GROUP = {"parquet.block.size": str(32 << 20)}


def scan_cells(spark: SparkSession, path: str) -> DataFrame:
    """All versions of all cells below a path."""
    return spark.read.schema(CELLS).parquet(path)


def scan_table(spark: SparkSession, table: str) -> DataFrame:
    """All versions of all cells of a catalog table."""
    return spark.read.table(table).select(*CELLS.fieldNames())


def latest_cells(cells: DataFrame, ts: bool = False, value: bool = False) -> DataFrame:
    """One row per (row_key, family, qualifier), with only what the caller asks for.

    Presence and time are plain hash aggregates. The newest value is the
    dearer one, as string buffers make Spark sort; equal times take the
    greater value. Filters on the three id columns may go below this, filters
    on time or value may not.
    """
    if value:
        newest = F.max(F.struct("ts", "value")).alias("newest")
        return cells.groupBy(*CELL_ID).agg(newest).select(*CELL_ID, "newest.ts", "newest.value")
    if ts:
        return cells.groupBy(*CELL_ID).agg(F.max("ts").alias("ts"))
    return cells.select(*CELL_ID).distinct()


@dataclass(frozen=True)
class ValueNumbers:
    """The values of a table in their order, and the times it spans."""

    values: DataFrame  # (named, number)
    count: int
    first: int
    last: int
    timeless: int  # cells without a time


def number_values(cells: DataFrame) -> ValueNumbers:
    """Number the values of a table, in one pass; made once, it serves folds of any part of the table."""
    times = [F.min("ts").alias("first"), F.max("ts").alias("last"), F.count_if(F.col("ts").isNull()).alias("timeless")]
    seen = settle(cells.groupBy("value").agg(*times), "cell-values")
    totals = [F.min("first").alias("first"), F.max("last").alias("last"), F.sum("timeless").alias("timeless")]
    found = seen.agg(F.count("*").alias("count"), *totals).first()
    number = (F.row_number().over(Window.orderBy("value")) - 1).alias("number")
    values = seen.select(F.col("value").alias("named"), number)
    return ValueNumbers(values, max(found["count"], 1), found["first"] or 0, found["last"] or 0, found["timeless"] or 0)


def latest_by_number(cells: DataFrame, numbers: ValueNumbers | None = None, most_values: int = BROADCAST_ROWS) -> DataFrame:
    """``latest_cells`` with times and values, for tables of few different values.

    Time and number of the value are one long, whose maximum is a hash
    aggregate; equal times take the greater value as before. Where there are more
    than ``most_values`` values, cells without a time, or times too far apart,
    the general fold is taken; the rows are the same. The job fails on a cell
    with a value or time that ``numbers`` does not know.
    """
    of = numbers or number_values(cells)
    if of.count > most_values or of.timeless or (of.last - of.first + 1) * of.count >= 1 << 63:
        return latest_cells(cells, value=True)
    known = F.broadcast(of.values)
    numbered = cells.join(known, F.col("value").eqNullSafe(F.col("named")), "left")
    fits = F.col("number").isNotNull() & F.col("ts").between(of.first, of.last)
    packed = F.when(fits, (F.col("ts") - of.first) * of.count + F.col("number"))
    packed = F.coalesce(packed, F.raise_error(F.lit("a value or time that was not numbered")).cast("bigint"))
    folded = numbered.groupBy(*CELL_ID).agg(F.max(packed).alias("packed"))
    ts = F.expr(f"packed div {of.count}L") + of.first
    unpacked = folded.select(*CELL_ID, ts.alias("ts"), F.pmod("packed", F.lit(of.count)).alias("number"))
    return unpacked.join(known, "number").select(*CELL_ID, "ts", F.col("named").alias("value"))


def write_cells(cells: DataFrame, path: str, order: tuple[str, ...] = ("row_key", "qualifier", "ts")) -> None:
    """Write cells sorted over the whole dataset, so that readers skip row groups.

    Key order serves lookups; ``("qualifier", "row_key", "ts")`` serves prefix
    scans, and ``("ts", "row_key", "qualifier")`` time ranges. All three columns take
    part, so one hot key or tag still spreads over several ranges. In every order
    row groups carry a bloom filter of their keys.
    """
    ordered = cells.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.write.mode("overwrite").options(**KEY_FILTER, **ROW_GROUP).parquet(path)


def write_clustered_table(cells: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Write the current cells bucketed by key: later exports and key joins need no shuffle.

    Versions are folded first, so a key comes to its bucket with one row per tag.
    """
    # repartition to the bucket count: one file per bucket, not one per task and bucket
    writer = (
        latest_cells(cells, value=True)
        .repartition(buckets, "row_key")
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, "row_key")
        .sortBy("row_key", "qualifier")
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def has_rows(cells: DataFrame) -> bool:
    return not cells.isEmpty()


def newest_first(*tie_breaks: str) -> list[Column]:
    """Sort columns; the tie-breaks also let the range partitioner split a hot time."""
    return [F.desc("timeStamp"), *[F.asc(c) for c in tie_breaks]]

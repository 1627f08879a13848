"""Projections and filters over cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys, qualifiers, text
from ..schema import CELLS
from ..sources.cells import latest_cells, newest_first

# Fixed value: rows in a preview.
PREVIEW_ROWS = 20


def dump_cells(cells: DataFrame) -> DataFrame:
    """Every current cell with all its parts."""
    return latest_cells(cells, value=True).select(*CELLS.fieldNames())


def flat_tags(cells: DataFrame) -> DataFrame:
    """``(rowkey, tag)`` per current cell; keys without a colon stay out."""
    return (
        latest_cells(cells.where(F.contains("row_key", F.lit(":"))))
        .select(keys.key_prefix_last("row_key").alias("rowkey"), qualifiers.strip_vendor("qualifier").alias("tag"))
        .where(F.col("tag") != "")
    )


def flat_updates(cells: DataFrame) -> DataFrame:
    """``(rowkey, tag, timeStamp)`` per current cell, with whole key and qualifier."""
    return latest_cells(cells, ts=True).select(
        F.col("row_key").alias("rowkey"), F.col("qualifier").alias("tag"), F.col("ts").alias("timeStamp")
    )


def sort_by_time_desc(updates: DataFrame) -> DataFrame:
    return updates.orderBy(*newest_first("rowkey", "tag"))


def vendor_updates(cells: DataFrame, prefix: str = "kd") -> DataFrame:
    """Updates of the qualifiers with a prefix and their readable date, newest first."""
    updates = flat_updates(cells.where(F.col("qualifier").startswith(prefix)))
    return sort_by_time_desc(updates.withColumn("date", text.ms_to_datetime("timeStamp")))


def time_range_updates(cells: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Updates of current cells with ``start_ms <= timeStamp < end_ms``.

    The lower bound also goes below the fold of versions, to the scan: what it
    takes away is older than the newest version of any cell that counts. The
    upper bound may not, as it would show cells by an older version. A table
    written in order of time (``write_cells``) skips the row groups before the range.
    """
    recent = flat_updates(cells.where(F.col("ts") >= start_ms))
    return recent.where(F.col("timeStamp") < end_ms)


def prefix_scan_keys(cells: DataFrame, prefix: str) -> DataFrame:
    """Id of every well-lengthed key that has a qualifier with the prefix; one row per whole key."""
    hits = cells.where(F.col("qualifier").startswith(prefix) & keys.key_is_loose_ok("row_key"))
    return hits.select("row_key").distinct().select(keys.key_prefix_first("row_key").alias("rowkey"))


def sample_rows(df: DataFrame, fraction: float, key: list[str], seed: int = 0) -> DataFrame:
    """Rows whose hash of seed and key falls below the fraction: the same ones however the input is split."""
    text_key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
    place = F.conv(F.substring(F.md5(text_key), 1, 8), 16, 10).cast("bigint")
    return df.where(place < int(fraction * 2**32))


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of a frame, in its own order."""
    return df.limit(n)

"""Counts, reach and inverted indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys, qualifiers
from .scan import flat_tags

# Rows of a reach report.
TOP_TAGS = 200


def count_by_os(ids: DataFrame) -> DataFrame:
    return ids.groupBy("os").agg(F.count("*").alias("count"))


def count_ids(ids: DataFrame) -> DataFrame:
    return ids.agg(F.count("*").alias("count"))


def tag_reach(cells: DataFrame, top: int = TOP_TAGS) -> DataFrame:
    """Tags by distinct devices, most first, ties by tag.

    Devices are told apart before they are counted, spread by tag and device,
    so a tag everybody has costs one row per task in the last step.
    """
    reach = flat_tags(cells).groupBy("tag").agg(F.countDistinct("rowkey").alias("cnt"))
    return reach.orderBy(F.desc("cnt"), "tag").limit(top)


def _tagged(cells: DataFrame) -> DataFrame:
    return (
        cells.where(F.contains("row_key", F.lit(":")))
        .select(keys.key_prefix_last("row_key").alias("rowkey"), qualifiers.strip_vendor("qualifier").alias("tag"))
        .where(F.col("tag") != "")
    )


def tag_index(cells: DataFrame) -> DataFrame:
    """Distinct ``(tag, rowkey)``: the index as a flat table, for tags of any reach."""
    return _tagged(cells).distinct()


def tag_to_devices(cells: DataFrame, parts: int = 1) -> DataFrame:
    """``(tag, part, rowkeys)``: the index as sorted arrays.

    Every tag has up to ``parts`` records; a device goes to a part by a hash of
    its key, whatever the tag. The parts of a tag are disjoint and together
    whole. Name as many parts as keep the devices of the most common tag within
    a record, or take the flat ``tag_index``.
    """
    hashed = F.conv(F.substring(F.md5("rowkey"), 1, 8), 16, 10).cast("bigint")
    placed = tag_index(cells).select("tag", "rowkey", (hashed % parts).cast("int").alias("part"))
    return placed.groupBy("tag", "part").agg(F.sort_array(F.collect_list("rowkey")).alias("rowkeys"))


def tag_to_devices_text(cells: DataFrame, parts: int = 1) -> DataFrame:
    """``tag_to_devices`` with the devices joined by commas."""
    return tag_to_devices(cells, parts).withColumn("rowkeys", F.array_join("rowkeys", ","))

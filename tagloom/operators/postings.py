"""Tags as bitmaps over numbered devices, so that audiences of several tags are sums of bits.

Devices get numbers: a bucket by the hash of their id and a place among the
devices of the bucket, in order of their ids. 32,768 places are a page, and a tag
has one bitmap of 4 kB for every page in which it has devices. A tag that very many
devices have is thus many records of one size, spread over all tasks. Unions and
intersections of tags meet page by page; only the devices of the result are
looked up in the dictionary of numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import qualifiers

# Fixed value: places in one of Spark's bitmaps.
PAGE_BITS = 32_768


@dataclass(frozen=True)
class Postings:
    """``devices``: ``(device, page, bit)``; ``tags``: ``(tag, page, bits)``, one row for each tag and page."""

    devices: DataFrame
    tags: DataFrame


def key_tags(cells: DataFrame) -> DataFrame:
    """``(device, tag)`` with whole row keys as devices: what ``audience_filter`` looks at."""
    return cells.select(F.col("row_key").alias("device"), qualifiers.strip_vendor("qualifier").alias("tag")).distinct()


def numbered(pairs: DataFrame, buckets: int) -> DataFrame:
    """``(device, tag, page, bit)`` of distinct ``(device, tag)`` pairs.

    One shuffle by bucket; take as many buckets as leave some tens of
    thousands of devices in each. A bucket with more than a page's devices has several pages.
    """
    hashed = F.conv(F.substring(F.md5("device"), 1, 8), 16, 10).cast("bigint")
    placed = pairs.where(F.col("device").isNotNull()).withColumn("bucket", (hashed % buckets).cast("int"))
    place = F.dense_rank().over(Window.partitionBy("bucket").orderBy("device")) - 1
    page = F.floor(F.col("place") / PAGE_BITS) * buckets + F.col("bucket")
    return placed.withColumn("place", place).select(
        "device", "tag", page.cast("bigint").alias("page"), (F.col("place") % PAGE_BITS).alias("bit")
    )


def dictionary(pairs: DataFrame) -> DataFrame:
    return pairs.select("device", "page", "bit").distinct()


def bitmaps(pairs: DataFrame) -> DataFrame:
    """``(tag, page, bits)`` of numbered pairs; bits are set map side first."""
    return pairs.groupBy("tag", "page").agg(F.bitmap_construct_agg("bit").alias("bits"))


def write_postings(pairs: DataFrame, path: str, buckets: int) -> None:
    """Write the postings of ``(device, tag)`` pairs: tags in their order, devices by page."""
    spark = pairs.sparkSession
    found = numbered(pairs, buckets)
    found.repartitionByRange("page", "bit").sortWithinPartitions("page", "bit", "tag").write.parquet(f"{path}/pairs")
    stored = spark.read.schema(found.schema).parquet(f"{path}/pairs")
    dictionary(stored).repartitionByRange("page", "bit").sortWithinPartitions("page", "bit").write.parquet(f"{path}/devices")
    bitmaps(stored).repartitionByRange("tag", "page").sortWithinPartitions("tag", "page").write.parquet(f"{path}/tags")


def read_postings(spark: SparkSession, path: str) -> Postings:
    devices = spark.read.schema("device string, page bigint, bit int").parquet(f"{path}/devices")
    return Postings(devices, spark.read.schema("tag string, page bigint, bits binary").parquet(f"{path}/tags"))


def any_of(tags: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Bitmaps, by page, of the devices with any of the tags."""
    hit = tags.where(F.col("tag").isin(*wanted)) if wanted else tags.where(F.lit(False))
    return hit.groupBy("page").agg(F.bitmap_or_agg("bits").alias("bits"))


def all_of(tags: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Bitmaps, by page, of the devices with all of the tags; no tags are nobody's."""
    wanted = list(dict.fromkeys(wanted))
    hit = tags.where(F.col("tag").isin(*wanted)) if wanted else tags.where(F.lit(False))
    met = hit.groupBy("page").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("tags"))
    return met.where(F.col("tags") == len(wanted)).select("page", "bits")


def both(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bitmaps of the devices in two results."""
    met = left.unionByName(right).groupBy("page").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("sides"))
    return met.where(F.col("sides") == 2).select("page", "bits")


def either(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bitmaps of the devices in any of two results."""
    return left.unionByName(right).groupBy("page").agg(F.bitmap_or_agg("bits").alias("bits"))


def has_bit(bits: Column, bit: Column) -> Column:
    """Whether a bit of a bitmap is set."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), bit % 8)).cast("int").bitwiseAND(F.lit(1)) == 1


def members(devices: DataFrame, found: DataFrame) -> DataFrame:
    """The devices of a result; with a ``tag`` column in it, the devices of every tag."""
    listed = devices.join(found, "page").where(has_bit(F.col("bits"), F.col("bit")))
    return listed.select(*[c for c in found.columns if c not in ("page", "bits")], "device")


def size(found: DataFrame) -> DataFrame:
    """How many devices a result has."""
    return found.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("count"))


def reach(tags: DataFrame) -> DataFrame:
    """Devices of every tag, read off the bitmaps."""
    return tags.groupBy("tag").agg(F.sum(F.bitmap_count("bits")).alias("cnt"))

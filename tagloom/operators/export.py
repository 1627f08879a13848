"""Exports: devices put together again from their cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys, qualifiers
from ..functions.keys import key_prefix_first, key_prefix_last


def assemble(cells: DataFrame, collected: dict[str, Column]) -> DataFrame:
    """Sorted arrays of qualifiers per key, one per entry of ``collected``.

    ``collected`` maps a name to a text column over cells, null where the cell
    has nothing to add; a key with no text at all keeps an empty array. Every
    key has exactly one record, as long as its own distinct tags; who cannot
    hold such a record takes the flat tags.

    Tags are told apart by key and tag first, which lets map tasks fold
    versions and shares a hot key among tasks, and only then meet by key. On
    cells bucketed by key nothing is shuffled.
    """
    tags = cells.select("row_key", "qualifier").distinct()
    return tags.groupBy("row_key").agg(*[F.sort_array(F.collect_list(c)).alias(n) for n, c in collected.items()])


def _stripped(cells: DataFrame) -> DataFrame:
    kept = cells.where(F.contains("row_key", F.lit(":")))
    rows = assemble(kept, {"qualifiers": F.col("qualifier")})
    tags = F.filter(F.transform("qualifiers", qualifiers.strip_vendor), lambda t: t != "")
    return rows.select(key_prefix_last("row_key").alias("rowkey"), tags.alias("tags"))


def tags_as_string(cells: DataFrame) -> DataFrame:
    """``(rowkey, "t1,t2,...")`` without vendors, in qualifier order."""
    return _stripped(cells).withColumn("tags", F.array_join("tags", ","))


def tags_as_array(cells: DataFrame) -> DataFrame:
    """``(rowkey, [t1, t2, ...])`` without vendors, in qualifier order."""
    return _stripped(cells)


def recoded(array: Column | str) -> Column:
    """Recoded tags as text, in the order of the raw qualifiers."""
    return F.array_join(F.transform(array, qualifiers.recode_qualifier), ",")


def clean_export(cells: DataFrame) -> DataFrame:
    """``(did, tags, os)`` of well-formed keys, with their legal columns recoded.

    Keys whose columns are all illegal stay, with empty tags.
    """
    legal = F.when(qualifiers.is_exportable_column("qualifier"), F.col("qualifier"))
    rows = assemble(cells.where(keys.key_is_wellformed("row_key")), {"legal": legal})
    device = key_prefix_first("row_key")
    return rows.select(
        keys.display_did(device, with_kind=True).alias("did"),
        recoded("legal").alias("tags"),
        keys.os_number(device).alias("os"),
    )


def _raw(cells: DataFrame) -> DataFrame:
    rows = assemble(cells.where(keys.key_is_loose_ok("row_key")), {"qualifiers": F.col("qualifier")})
    return rows.select(key_prefix_first("row_key").alias("device"), "qualifiers")


def export_string(cells: DataFrame) -> DataFrame:
    """``(rowkey, value)`` with raw qualifiers joined by commas, ready for JSON lines."""
    return _raw(cells).select(F.col("device").alias("rowkey"), F.array_join("qualifiers", ",").alias("value"))


def export_array(cells: DataFrame, plain: bool = False) -> DataFrame:
    """``(did, tags, os)`` with raw qualifiers as an array; ``plain`` keeps the id as stored, without os."""
    rows = _raw(cells)
    if plain:
        return rows.select(F.col("device").alias("did"), F.col("qualifiers").alias("tags"))
    return rows.select(
        keys.display_did("device").alias("did"), F.col("qualifiers").alias("tags"), keys.os_number("device").alias("os")
    )


def last_update(cells: DataFrame) -> DataFrame:
    """``(rowkey, maxTimestamp)`` of every well-lengthed key.

    The newest version of a key's cells is its newest version of all, so one
    aggregate of longs will do.
    """
    rows = cells.where(keys.key_is_loose_ok("row_key")).groupBy("row_key").agg(F.max("ts").alias("maxTimestamp"))
    return rows.select(key_prefix_first("row_key").alias("rowkey"), "maxTimestamp")

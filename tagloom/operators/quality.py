"""Checks of keys, columns and configurations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys, qualifiers
from ..functions.text import split_list
from ..sources.cells import latest_cells


def _keys(cells: DataFrame) -> DataFrame:
    return cells.select("row_key").distinct()


def _columns(cells: DataFrame) -> DataFrame:
    columns = latest_cells(cells)
    return columns.select(keys.key_prefix_first("row_key").alias("rowkey"), "qualifier")


def dirty_rowkeys(cells: DataFrame) -> DataFrame:
    """Whole keys that are not well-formed."""
    return _keys(cells.where(~keys.key_is_wellformed("row_key")))


def dirty_columns(cells: DataFrame) -> DataFrame:
    """``(rowkey, qualifier)`` of the columns of well-formed keys that cannot be exported."""
    bad = ~qualifiers.is_exportable_column("qualifier")
    return _columns(cells.where(keys.key_is_wellformed("row_key") & bad))


def legacy_ap_audit(cells: DataFrame) -> DataFrame:
    """``(rowkey, qualifier)`` of retired column names on well-lengthed keys."""
    return _columns(cells.where(keys.key_is_loose_ok("row_key") & qualifiers.is_legacy_column("qualifier")))


def legacy_key_audit(cells: DataFrame) -> DataFrame:
    """Whole keys without a colon or with an id of another length."""
    return _keys(cells.where(~keys.key_is_loose_ok("row_key")))


def dirty_summary(cells: DataFrame) -> DataFrame:
    """One row: clean keys, dirty keys, dirty columns."""
    key_ok = keys.key_is_wellformed("row_key")
    bad = key_ok & ~qualifiers.is_exportable_column("qualifier")
    # good columns count as nothing, so a key mostly travels as a single row
    found = cells.select("row_key", F.when(bad, F.col("qualifier")).alias("bad_column")).distinct()
    per_key = found.groupBy("row_key").agg(F.count("bad_column").alias("bad_columns"))
    return per_key.agg(
        F.count_if(key_ok).alias("clean_rows"),
        F.count_if(~key_ok).alias("dirty_rowkeys"),
        F.coalesce(F.sum("bad_columns"), F.lit(0)).alias("dirty_columns"),
    )


def _sizes(delimiters: dict[str, str]) -> dict[str, Column]:
    return {c: F.coalesce(F.size(split_list(c, d)), F.lit(0)) for c, d in delimiters.items()}


def lists_align(delimiters: dict[str, str]) -> Column:
    """Whether the delimited lists in these columns all have the same number of items; a null list has none."""
    first, *others = _sizes(delimiters).values()
    return reduce(lambda ok, n: ok & (n == first), others, F.lit(True))


def list_error(delimiters: dict[str, str]) -> Column:
    """What is wrong with a row of parallel lists, by name and number of items; null if nothing is."""
    sizes = F.concat_ws(", ", *[F.concat(F.lit(f"{c} "), n.cast("string")) for c, n in _sizes(delimiters).items()])
    return F.when(~lists_align(delimiters), F.concat(F.lit("the parallel lists differ in length: "), sizes))


def validate_projects(config: DataFrame, delimiters: dict[str, str], strict: bool = False) -> DataFrame:
    """All rows of parallel lists with ``error``, null where the lists are of one length.

    With ``strict``, the job fails on the first row that has an error; the
    message is that error.
    """
    error = list_error(delimiters)
    if strict:
        error = F.when(error.isNotNull(), F.raise_error(error).cast("string"))
    return config.withColumn("error", error)

"""Lookups of many keys at once, as joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys, qualifiers, text
from ..functions import as_col
from ..session import LITERALS, listed, named_values
from ..sources.cells import latest_cells
from .export import assemble


def request_keys(lines: DataFrame, with_kind: bool = True) -> DataFrame:
    """Keys of the lines of a lookup list, lower case, built from the id or taken as they are."""
    kept = lines.where(text.min_length("value", text.MIN_LOOKUP_LINE))
    key = keys.build_key_by_hyphen("value") if with_kind else F.lower("value")
    return kept.select(key.alias("row_key"))


def cells_of(cells: DataFrame, requested: DataFrame) -> DataFrame:
    """Cells of the requested keys; an empty key is nobody's.

    No broadcast hint: Spark broadcasts the list when it measures it as small
    enough, else it merges, where a hot key among the cells can be split. Then
    a bloom filter of the keys drops other cells where they are scanned,
    before anything is shuffled.
    """
    return cells.join(named_values(requested.select("row_key"), "row_key").distinct(), "row_key", "left_semi")


def cells_of_keys(cells: DataFrame, row_keys: Sequence[str]) -> DataFrame:
    """Cells of keys the caller holds.

    Few enough keys reach the scan as equalities, so that row groups whose
    statistics or bloom filters rule all of them out are not read.
    """
    if len(row_keys) > LITERALS:
        return cells_of(cells, listed(cells.sparkSession, list(row_keys), "row_key"))
    return cells.where(F.col("row_key").isin(*row_keys)) if row_keys else cells.where(F.lit(False))


def get_row(cells: DataFrame, key: str) -> DataFrame:
    """All current cells of one key, and the key's length in bytes."""
    return get_rows_of(cells, [key])


def get_rows_of(cells: DataFrame, row_keys: Sequence[str]) -> DataFrame:
    """``get_row`` for keys the caller holds."""
    return _with_key_bytes(latest_cells(cells_of_keys(cells, row_keys), value=True))


def get_rows(cells: DataFrame, requested: DataFrame) -> DataFrame:
    """``get_row`` for every key of a frame."""
    return _with_key_bytes(latest_cells(cells_of(cells, requested), value=True))


def _with_key_bytes(cells: DataFrame) -> DataFrame:
    return cells.withColumn("key_bytes", F.octet_length("row_key"))


def lookup_vendor_tags(cells: DataFrame, requested: DataFrame, qualifier: str | None = None) -> DataFrame:
    """``(row_key, tags)`` per distinct requested key, ``tags`` mapping every vendor to its codes.

    Unknown vendors are left out, and a key that is not there gets empty lists.
    With ``qualifier``, only that column is looked at, which reaches the scan.
    """
    requested = requested.select("row_key").distinct()
    if qualifier is not None:
        cells = cells.where(F.col("qualifier") == qualifier)
    known = qualifiers.vendor_of("qualifier").isin(*[v for v, _, _ in qualifiers.VENDORS])
    asked = cells_of(cells.where(known), requested)
    found = assemble(asked, {"qualifiers": F.col("qualifier")})
    held = F.coalesce("qualifiers", F.array().cast("array<string>"))
    # two projections: the pairs are made once and then read by every vendor
    pairs = requested.join(found, "row_key", "left").select(
        "row_key", qualifiers.split_qualifiers(held).alias("pairs")
    )
    return pairs.select("row_key", qualifiers.codes_by_vendor("pairs").alias("tags"))


def keys_with_tags(cells: DataFrame, tags: DataFrame) -> DataFrame:
    """Distinct keys that have any of the tags (column ``tag``, without vendor)."""
    tagged = cells.select("row_key", qualifiers.strip_vendor("qualifier").alias("tag"))
    return tagged.join(tags.select("tag"), "tag", "left_semi").select("row_key").distinct()


def audience_filter(ids: DataFrame, cells: DataFrame, tags: DataFrame) -> DataFrame:
    """The rows of ``ids`` whose ``row_key`` has any of the tags; repeated rows stay."""
    return ids.join(keys_with_tags(cells, tags), "row_key", "left_semi")


def vendor_tags_of(cells: DataFrame, row_keys: Sequence[str], qualifier: str | None = None) -> DataFrame:
    """``lookup_vendor_tags`` for keys the caller holds."""
    asked = listed(cells.sparkSession, list(row_keys), "row_key")
    return lookup_vendor_tags(cells_of_keys(cells, row_keys), asked, qualifier)


def tags_intersect(tags: Column | str, wanted: list[str]) -> Column:
    """Whether an array of tags holds any wanted one."""
    return F.arrays_overlap(as_col(tags), F.array(*[F.lit(t) for t in wanted]))

"""Qualifiers: ``<vendor>_<code>``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import as_col

# Vendor prefix, its number in exports, its name in lookups.
VENDORS = (
    ("mh", "010", "md"),
    ("td", "011", "td"),
    ("up", "012", "up"),
    ("ap", "015", "ap"),
    ("kd", "017", "kd"),
    ("am", "018", "am"),
    ("qx", "019", "qx"),
    ("sz", "021", "sz"),
)

# This vendor's number is followed, at this index, by a filler.
FILLED_VENDOR = "mh"
FILL_INDEX = 6
FILL_TEXT = "0"

# Fixed value: marks of the retired column naming.
LEGACY_MARK = "_ap_"


def is_legal_column(qualifier: Column | str) -> Column:
    """Exactly two characters that are neither digits nor underscores.

    A pattern without backtracking is cheaper here than taking characters out.
    """
    return as_col(qualifier).rlike(r"\A[0-9_]*[^0-9_][0-9_]*[^0-9_][0-9_]*\z")


def insert_at(text: Column | str, index: int = FILL_INDEX, piece: str = FILL_TEXT) -> Column:
    """``text`` with ``piece`` put in at a zero-based index; null if the text is too short."""
    text = as_col(text)
    joined = F.concat(F.substring(text, 1, index), F.lit(piece), F.substring(text, F.lit(index + 1), F.length(text)))
    return F.when(F.length(text) >= index, joined)


def strip_vendor(qualifier: Column | str) -> Column:
    """The qualifier without its first three characters."""
    qualifier = as_col(qualifier)
    return F.substring(qualifier, F.lit(4), F.length(qualifier))


def recode_qualifier(qualifier: Column | str) -> Column:
    """Vendor prefix replaced by its number; unknown prefixes stay, too short ones give null."""
    qualifier = as_col(qualifier)

    def numbered(vendor: str, number: str) -> Column:
        swapped = F.concat(F.lit(number), strip_vendor(qualifier))
        return insert_at(swapped) if vendor == FILLED_VENDOR else swapped

    return reduce(
        lambda rest, v: F.when(qualifier.startswith(f"{v[0]}_"), numbered(v[0], v[1])).otherwise(rest),
        reversed(VENDORS),
        qualifier,
    )


def is_exportable_column(qualifier: Column | str) -> Column:
    """Legal, and long enough to be recoded."""
    qualifier = as_col(qualifier)
    too_short = qualifier.startswith(f"{FILLED_VENDOR}_") & (F.length(qualifier) < FILL_INDEX)
    return is_legal_column(qualifier) & ~too_short


def is_legacy_column(qualifier: Column | str) -> Column:
    return F.contains(F.lower(as_col(qualifier)), F.lit(LEGACY_MARK))


def vendor_of(qualifier: Column | str) -> Column:
    """First underscore-separated part."""
    return F.substring_index(F.rtrim(as_col(qualifier), F.lit("_")), "_", 1)


def code_of(qualifier: Column | str) -> Column:
    """Second underscore-separated part; null where only underscores follow the first."""
    kept = F.rtrim(as_col(qualifier), F.lit("_"))
    return F.when(F.contains(kept, F.lit("_")), F.substring_index(F.substring_index(kept, "_", 2), "_", -1))


def split_qualifiers(qualifiers: Column | str) -> Column:
    """Array of ``(vendor, code)`` for an array of qualifiers."""
    return F.transform(
        as_col(qualifiers), lambda q: F.struct(vendor_of(q).alias("vendor"), code_of(q).alias("code"))
    )


def codes_by_vendor(pairs: Column | str) -> Column:
    """Map from every vendor's lookup name to its codes, in the order of ``split_qualifiers``."""
    pairs = as_col(pairs)

    def codes(vendor: str) -> Column:
        own = F.filter(pairs, lambda p: (p["vendor"] == vendor) & p["code"].isNotNull())
        return F.transform(own, lambda p: p["code"])

    return F.create_map(*[x for vendor, _, name in VENDORS for x in (F.lit(name), codes(vendor))])

"""Text lines, lists, times and JSON."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import EXPORT_LINE
from . import as_col

# Shortest line taken from an id file, from a lookup list.
MIN_ID_LINE = 20
MIN_LOOKUP_LINE = 4


def min_length(line: Column | str, n: int = MIN_ID_LINE) -> Column:
    return F.length(as_col(line)) >= n


def split_take_nth(line: Column | str, delimiter: str = ",", n: int = 0) -> Column:
    """Item ``n`` of a line; null past the end, where trailing empty items do not count."""
    line = as_col(line)
    items = F.split(line, re.escape(delimiter))
    rest = F.array_join(F.slice(items, F.lit(n + 1), F.size(items) + 1), "")
    found = rest != ""
    if n == 0:
        found = found | (line == "")
    return F.when(found, F.get(items, F.lit(n)))


def split_list(text: Column | str, delimiter: str = ",") -> Column:
    """Items of a list without trailing empty ones; an empty text is one empty item."""
    text = as_col(text)
    kept = F.rtrim(text, F.lit(delimiter))
    none = F.array().cast("array<string>")
    return F.when((kept == "") & (text != ""), none).otherwise(F.split(kept, re.escape(delimiter)))


def split_tag_list(tags: Column | str) -> Column:
    return split_list(tags, ",")


def ms_to_datetime(ms: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of the first ten digits of an epoch-millisecond value."""
    seconds = F.substring(as_col(ms).cast("string"), 1, 10).cast("long")
    return F.from_unixtime(seconds, "yyyy-MM-dd HH:mm:ss")


def date_range(start: Column | str, end: Column | str) -> Column:
    """All ``yyyyMMdd`` days from start to end, both included; empty if they are reversed."""
    first, last = (F.to_date(as_col(c), "yyyyMMdd") for c in (start, end))
    days = F.transform(F.sequence(first, F.greatest(first, last)), lambda d: F.date_format(d, "yyyyMMdd"))
    return F.when(last >= first, days).otherwise(F.array().cast("array<string>"))


def tags_to_json(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns))


def parse_export_json(line: Column | str) -> Column:
    """Struct of ``did`` and ``tags`` from an exported line."""
    return F.from_json(as_col(line), EXPORT_LINE)


def join_fields(columns: list[str], delimiter: str = ",") -> Column:
    """All columns as one text; a null prints as ``null``."""
    return F.concat_ws(delimiter, *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])

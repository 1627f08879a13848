"""Where patterns occur in texts, with built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,value:string>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def find_all(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as an array of ``(start, end, value)``.

    Places count code points, ``end`` is exclusive. A text is cut into pairs
    of what lies before a match and the match; running sums of their lengths
    are the places. ``pattern`` has no capturing group and matches no empty
    text; its repeated groups are possessive, so that long texts cost no
    stack. Texts without a match cost one search.
    """
    cut = rf"(?s)(.*?)(?:({pattern})|\z)"
    pairs = F.zip_with(
        F.regexp_extract_all(text, F.lit(cut), F.lit(1)),
        F.regexp_extract_all(text, F.lit(cut), F.lit(2)),
        lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")),
    )

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + pair["gap"]
        end = start + F.length(pair["value"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        found = F.when(pair["value"] == "", acc["found"]).otherwise(F.concat(acc["found"], F.array(span)))
        return F.struct(end.alias("at"), found.alias("found"))

    none = F.array().cast(f"array<{SPAN}>")
    first = F.struct(F.lit(0).alias("at"), none.alias("found"))
    return F.when(F.rlike(text, F.lit(pattern)), F.aggregate(pairs, first, step, lambda acc: acc["found"])).otherwise(none)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")

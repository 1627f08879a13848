"""Audiences from ad logs, nested result logs and id lists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions import keys, text
from ..session import BROADCAST_ROWS, LITERALS, named_values, settle

# The id types of a project, by number, and the log kinds.
ID_COLUMNS = ("cid", "creative_id")
KINDS = ("imp", "clk")

# Names of the folders of an extract.
FOLDERS = ("campaign", "log_kind", "log_day")

# Ids that may become a literal scan filter; a limit of the plan only, the join decides on the rows.
FILTER_IDS = LITERALS


@dataclass(frozen=True)
class Project:
    """Which ids count for a project, in which logs, over which inclusive days."""

    name: str
    imp: bool
    clk: bool
    id_type: int
    ids: tuple[str, ...]
    start: str
    end: str

    @property
    def id_column(self) -> str:
        return ID_COLUMNS[0] if self.id_type == 0 else ID_COLUMNS[1]

    @property
    def kinds(self) -> list[str]:
        return [kind for kind, used in zip(KINDS, (self.imp, self.clk)) if used]


def _items(joined: str, delimiter: str) -> list[str]:
    items = joined.split(delimiter)
    while len(items) > 1 and not items[-1]:
        items.pop()
    return items


def parse_projects(projects: str, imp: str, clk: str, id_types: str, ids: str, starts: str, ends: str) -> list[Project]:
    """Projects from parallel lists, joined by ``,`` (the id lists by ``;``)."""
    lists = [_items(x, ",") for x in (projects, imp, clk, id_types, starts, ends)]
    id_lists = _items(ids, ";")
    if len({len(x) for x in [*lists, id_lists]}) != 1:
        raise ValueError("the parallel lists of a project configuration differ in length")
    return [
        Project(name, int(i) == 1, int(c) == 1, int(t), tuple(x.strip(" '\"") for x in wanted.split(",")), start, end)
        for name, i, c, t, start, end, wanted in zip(*lists, id_lists)
    ]


def _days(start: str, end: str) -> int:
    first, last = (datetime.strptime(x, "%Y%m%d") for x in (start, end))
    return max((last - first).days + 1, 0)


def _project_days(logs: DataFrame, projects: Sequence[Project]) -> DataFrame:
    """``(slot, project, kind, day, id_type, id)``, one row per day, broadcast if few enough."""
    rows = []
    for slot, p in enumerate(projects):
        wanted = dict.fromkeys(str(int(x)) if _is_number(logs, p.id_column) else x for x in p.ids)
        rows += [(slot, p.name, k, p.id_column, x, p.start, p.end) for k in p.kinds for x in wanted]
    schema = "slot int, project string, kind string, id_type string, id string, start string, end string"
    days = F.explode(text.date_range("start", "end")).alias("day")
    config = logs.sparkSession.createDataFrame(rows, schema)
    config = config.select("slot", "project", "kind", "id_type", "id", days)
    size = sum(_days(start, end) for *_, start, end in rows)
    return F.broadcast(config) if size <= BROADCAST_ROWS else config


def _candidates(logs: DataFrame, projects: Sequence[Project]) -> DataFrame:
    """Log rows of kinds and days any project could want, by literal filters that reach the scan."""
    return logs.where(
        F.col("day").between(min(p.start for p in projects), max(p.end for p in projects))
        & F.col("kind").isin(*{k for p in projects for k in p.kinds})
    )


def _is_number(logs: DataFrame, column: str) -> bool:
    return isinstance(logs.schema[column].dataType, IntegralType)


def _with_any_id(logs: DataFrame, projects: Sequence[Project]) -> DataFrame:
    """Log rows with an id any project wants, by a literal filter."""
    any_id = F.lit(False)
    for column in ID_COLUMNS:
        ids = sorted({x for p in projects if p.id_column == column for x in p.ids})
        if ids:
            any_id = any_id | F.col(column).isin(*[int(x) if _is_number(logs, column) else x for x in ids])
    return logs.where(any_id)


def _by_id_type(logs: DataFrame, config: DataFrame, used: Sequence[str]) -> DataFrame:
    """Matches of long lists of ids, one join for each id type.

    The ids keep the column's own type and are written down first. Their size
    is known then, so Spark broadcasts them or, where both sides are
    shuffled, lets their bloom filter drop other rows at the scan.
    """
    wanted = settle(config, "project-days")
    found = []
    for column in used:
        ids = F.col("id").cast(logs.schema[column].dataType).alias(column)
        mine = named_values(wanted, "kind").where(F.col("id_type") == column).select("slot", "project", "kind", "day", ids)
        found.append(logs.join(mine, ["kind", "day", column]).select("slot", "project", *logs.columns))
    return reduce(DataFrame.unionByName, found)


def campaign_filter(logs: DataFrame, projects: Sequence[Project]) -> DataFrame:
    """Log rows wanted by the projects, with ``slot`` (position) and ``project``.

    One scan serves all projects and days. Every id type becomes a row of
    ``(id_type, id)``, so the match is an equi-join. Beyond ``FILTER_IDS`` ids
    there is one scan, and one join, for each id type. A row that several projects
    want appears once for each.
    """
    if not any(p.kinds for p in projects):
        return logs.where(F.lit(False)).select(F.lit(0).alias("slot"), F.lit("").alias("project"), "*")
    used = [c for c in ID_COLUMNS if any(p.id_column == c for p in projects)]
    candidates = _candidates(logs, projects)
    if len({(p.id_column, x) for p in projects for x in p.ids}) > FILTER_IDS:
        return _by_id_type(candidates, _project_days(logs, projects), used)
    ids = F.explode(F.array(*[F.struct(F.lit(c).alias("id_type"), F.col(c).cast("string").alias("id")) for c in used]))
    keyed = _with_any_id(candidates, projects).select("*", ids.alias("match")).select("*", "match.*").drop("match")
    matched = keyed.join(_project_days(logs, projects), ["kind", "day", "id_type", "id"])
    return matched.select("slot", "project", *logs.columns)


def campaign_extract(
    logs: DataFrame, campaigns: Sequence[Project], fields: Sequence[str] | None = None
) -> DataFrame:
    """``campaign_filter`` with chosen fields, all columns by default, plus ``FOLDERS`` to write by."""
    rows = campaign_filter(logs, campaigns)
    places = [f"{source} as {name}" for source, name in zip(("project", "kind", "day"), FOLDERS, strict=True)]
    chosen = select_fields(rows, [*(fields or [f"`{c}`" for c in logs.columns]), *places])
    if len(set(chosen.columns)) < len(chosen.columns):
        raise ValueError(f"fields need names of their own, other than {FOLDERS}")
    return chosen


def select_fields(df: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Expressions over the columns, or all columns if none are named."""
    return df.selectExpr(*fields) if fields else df


def named_fields(df: DataFrame, did: str = "did", os: str = "os", tags: str = "tags") -> DataFrame:
    """Columns under the names the imports use; a column that is not there is left out."""
    names = {"did": did, "os": os, "tags": tags}
    return df.select(*[F.col(source).alias(name) for name, source in names.items() if source in df.columns])


def audience_ids(uids: DataFrame) -> DataFrame:
    """Distinct normalised ids of a ``uid`` column, with their os; null and empty ones drop out."""
    ids = uids.select(keys.normalize_id("uid").alias("id")).where(F.col("id") != "").distinct()
    return with_os(ids)


def with_os(ids: DataFrame) -> DataFrame:
    return ids.withColumn("os", keys.os_of_id("id"))


def ids_of_lines(lines: DataFrame, delimiter: str = ",", n: int = 0) -> DataFrame:
    """Distinct normalised ids at position ``n`` of the long enough lines, with their os."""
    taken = lines.where(text.min_length("value")).select(text.split_take_nth("value", delimiter, n).alias("raw"))
    ids = taken.where(F.col("raw").isNotNull()).select(keys.normalize_id("raw").alias("id")).distinct()
    return with_os(ids)


def explode_results(nested: DataFrame, dealid: str | None = None, rescode: str | None = None) -> DataFrame:
    """One row per nested result, optionally of one deal and one result code."""
    rows = nested.select("deviceId", "deviceType", F.explode("results").alias("result"), "timestamp").select(
        "deviceId", "deviceType", F.col("result.dealid").alias("dealid"), F.col("result.resultCode").alias("rescode"), "timestamp"
    )
    for column, wanted in (("dealid", dealid), ("rescode", rescode)):
        if wanted is not None:
            rows = rows.where(F.col(column) == wanted)
    return rows


def audience_from_results(results: DataFrame) -> DataFrame:
    return results.select("deviceId", "deviceType").distinct()

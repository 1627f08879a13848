"""The jobs a user runs: exports, audits, imports and audience ingests."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import keys, qualifiers
from ..operators import audience, export, lookup, mutate, scan
from ..session import settle
from ..sources import files, sinks

AUDIT_MODES = ("json", "timestamp", "prefix", "clean", "delete", "audience")


def export_job(
    cells: DataFrame, path: str, modes: Iterable[str] = ("string",), files: int | None = None, prefix: str = "kd"
) -> dict[str, str]:
    """Write exports below ``path`` and return where each went.

    ``update`` excludes the others; ``string`` and ``array`` may run together
    and then the second is made from the first.
    """
    modes = set(modes)
    if unknown := modes - {"string", "array", "update"}:
        raise ValueError(f"unknown export modes: {sorted(unknown)}")
    if "update" in modes:
        scan.vendor_updates(cells, prefix).write.mode("overwrite").parquet(f"{path}/update")
        return {"update": f"{path}/update"}
    devices = export.tags_as_array(cells)
    written = {}
    if "array" in modes:
        written["array"] = f"{path}/array"
        sinks.write_parquet_compact(devices, written["array"], files)
        devices = cells.sparkSession.read.schema(devices.schema).parquet(written["array"])
    if "string" in modes:
        written["string"] = f"{path}/string"
        joined = devices.withColumn("tags", F.array_join("tags", ","))
        sinks.write_parquet_compact(joined, written["string"], files)
    return written


def extract_job(
    logs: DataFrame,
    campaigns: Sequence[audience.Project],
    path: str,
    fields: Sequence[str] | None = None,
    fmt: str = "parquet",
    delimiter: str = ",",
    mode: str = "overwrite",
) -> list[str]:
    """Write the log rows of campaigns, in one folder per campaign, kind and day.

    The folders are named by ``audience.FOLDERS``, so rows may well have fields
    of their own called day or kind. Campaigns of one name share a folder.
    ``fmt`` is ``parquet`` or ``text``; returns the fields of a row.
    """
    rows = audience.campaign_extract(logs, campaigns, fields)
    folders = list(audience.FOLDERS)
    if fmt == "text":
        sinks.write_delimited_text(rows, path, delimiter, partition_by=folders, mode=mode)
    elif fmt == "parquet":
        sinks.sized(rows, None, folders).write.mode(mode).partitionBy(*folders).parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return [c for c in rows.columns if c not in folders]


def audit_lines(cells: DataFrame, check: bool = False) -> DataFrame:
    """``(value, output)``: clean JSON lines and, with ``check``, dirty keys and columns.

    One pass over the cells: every device comes together once, with its legal
    columns apart from the others, and then gives the lines of all outputs.
    """
    key_ok = keys.key_is_wellformed("row_key")
    legal = qualifiers.is_exportable_column("qualifier")
    devices = export.assemble(
        cells if check else cells.where(key_ok),
        {
            "legal": F.when(key_ok & legal, F.col("qualifier")),
            "illegal": F.when(key_ok & ~legal, F.col("qualifier")) if check else F.lit(None).cast("string"),
        },
    )
    device = keys.key_prefix_first("row_key")
    clean = F.to_json(
        F.struct(
            keys.display_did(device, with_kind=True).alias("did"),
            export.recoded("legal").alias("tags"),
            keys.os_number(device).alias("os"),
        )
    )

    def line(value, output: str):
        return F.struct(value.alias("value"), F.lit(output).alias("output"))

    if not check:
        return devices.select(clean.alias("value"), F.lit("clean").alias("output"))
    bad_columns = F.transform("illegal", lambda q: line(F.concat_ws(",", device, q), "dirty_columns"))
    lines = F.when(key_ok, F.concat(F.array(line(clean, "clean")), bad_columns)).otherwise(
        F.array(line(F.col("row_key"), "dirty_rowkeys"))
    )
    return devices.select(F.inline(lines))


def audit_job(
    spark: SparkSession,
    cells: DataFrame,
    path: str,
    mode: str,
    *,
    prefix: str = "",
    check: bool = False,
    log: str | None = None,
    keys_path: str | None = None,
    at_ms: int | None = None,
    ids_path: str | None = None,
    tags_path: str | None = None,
) -> dict[str, int]:
    """Run one mode of the audit program and return how many records it wrote, by output.

    ``json``, ``timestamp``, ``prefix`` and ``clean`` write text below ``path``;
    ``delete`` appends deletes of the keys in ``keys_path`` to the mutation
    ``log``; ``audience`` writes the ids below ``ids_path`` that have a tag
    listed in ``tags_path``, in one output per input file: its path below
    ``ids_path``, with the name cut at its first dot. The counts are observed
    while the records are written.
    """
    seen = Observation()
    if mode == "json":
        sinks.write_json_lines(counted(export.export_array(cells), seen), path)
    elif mode == "timestamp":
        sinks.write_csv_pairs(counted(export.last_update(cells), seen), path)
    elif mode == "prefix":
        sinks.write_csv_pairs(counted(scan.prefix_scan_keys(cells, prefix), seen), path)
    elif mode == "clean":
        lines = audit_lines(cells, check)
        outputs = ("clean", "dirty_rowkeys", "dirty_columns") if check else ("clean",)
        totals = [F.count_if(F.col("output") == o).alias(o) for o in outputs]
        sinks.write_lines(lines.observe(seen, *totals), path, partition_by=("output",))
    elif mode == "delete":
        row_keys = files.read_id_lines(spark, keys_path).select(F.col("value").alias("row_key"))
        mutate.upsert_cells(counted(mutate.delete_rows(row_keys, at_ms), seen), log)
    elif mode == "audience":
        # written down first, so that Spark knows the size of what it may broadcast
        tags = files.require_tags(settle(files.read_filter_tags(spark, tags_path).distinct(), "filter-tags"))
        lines = files.below(files.read_dir_recursive(spark, ids_path), ids_path)
        hits = lookup.audience_filter(id_file_keys(lines), cells, tags)
        out = hits.select("value", result_name("path").alias("output"))
        sinks.write_lines(counted(out, seen), path, partition_by=("output",))
    else:
        raise ValueError(f"unknown audit mode {mode!r}, known are {AUDIT_MODES}")
    return dict(seen.get)


def counted(df: DataFrame, seen: Observation) -> DataFrame:
    """The frame, with its number of records observed when it runs."""
    return df.observe(seen, F.count(F.lit(1)).alias("records"))


def id_file_keys(lines: DataFrame) -> DataFrame:
    """Lines of id files with the row key each stands for, its kind told by the path below their folder."""
    key = F.lower(F.concat_ws(":", "value", keys.kind_from_path("path")))
    return lines.withColumn("row_key", key)


def result_name(path: str) -> Column:
    """Output of an input file: its folder, and its name up to the first dot with a fixed ending."""
    folder = F.regexp_extract(path, "^(.*/)?", 0)
    return F.concat(folder, keys.processed_path(F.substring_index(path, "/", -1)))


def import_puts(rows: DataFrame, at_ms: int, tag: str | None = None, **names: str) -> DataFrame:
    """Puts of an import: of one tag if it is given, else of every row's tag list."""
    named = audience.named_fields(rows, **names)
    return mutate.retarget_puts(named, tag, at_ms) if tag is not None else mutate.taglist_puts(named, at_ms)


def import_job(rows: DataFrame, log: str, at_ms: int, tag: str | None = None, **names: str) -> dict[str, int]:
    """Append an import to the log in one pass over the rows.

    Returns the total and, where rows have an os, the number of rows of each,
    all observed while the puts are written; ``os_other`` counts every other
    os and none.
    """
    named = audience.named_fields(rows, **names)
    seen = Observation()
    counts = os_counts("os") if "os" in named.columns else []
    mutate.upsert_cells(import_puts(named.observe(seen, F.count(F.lit(1)).alias("total"), *counts), at_ms, tag), log)
    return dict(seen.get)


def os_counts(os: str) -> list[Column]:
    """Rows of each os, and of any other or none, as aggregates."""
    known = F.coalesce(F.col(os).isin(*keys.OS_NUMBERS), F.lit(False))
    each = [F.count_if(F.col(os) == number).alias(f"os_{number}") for number in keys.OS_NUMBERS]
    return [*each, F.count_if(~known).alias("os_other")]


def save_audience(
    ids: DataFrame, at_ms: int, tag: str, path: str | None = None, log: str | None = None, files: int | None = None
) -> dict[str, int]:
    """Write an audience as Parquet, as puts of its tag, or both from one computation.

    Returns the total and the number of ids of each os, observed on the way.
    """
    if not path and not log:
        raise ValueError("name a path, a log or both")
    seen = Observation()
    by_os = [F.count_if(F.col("os") == os).alias(f"os_{os}") for os in keys.OS_NUMBERS]
    ids = ids.observe(seen, F.count(F.lit(1)).alias("total"), *by_os)
    if path:
        sinks.write_parquet_compact(ids, path, files)
        ids = ids.sparkSession.read.schema(ids.schema).parquet(path)
    if log:
        puts = mutate.retarget_puts(ids.withColumnRenamed("id", "did"), tag, at_ms)
        mutate.upsert_cells(puts, log)
    return dict(seen.get)


def ingest_id_file(spark: SparkSession, path: str, delimiter: str = ",", n: int = 0) -> DataFrame:
    """Audience of an id file: ``(id, os)``."""
    return audience.ids_of_lines(files.read_id_lines(spark, path), delimiter, n)


def ingest_campaign_audience(logs: DataFrame, projects: Sequence[audience.Project]) -> DataFrame:
    """Audience of all projects, from both log kinds: ``(id, os)``."""
    return audience.audience_ids(audience.campaign_filter(logs, projects).select("uid"))

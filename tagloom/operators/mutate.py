"""Puts and deletes in an append-only log, folded into the current state.

A log row is a cell and an ``op``:

=================  ====================================================
``put``            one version of a cell
``delete_row``     hides all versions of a key up to ``ts``
``delete_column``  hides all versions of a cell up to ``ts``
``delete_version`` hides the one version of a cell at exactly ``ts``
=================  ====================================================

A put and a delete of the same time: the delete wins. Writing a batch twice
changes nothing, so a job that lost executors can simply run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys
from ..functions.text import split_tag_list
from ..schema import CELL_ID, CELLS, FAMILY, MUTATIONS, PRESENT

PUT, DELETE_ROW, DELETE_COLUMN, DELETE_VERSION = "put", "delete_row", "delete_column", "delete_version"


def _mutations(df: DataFrame) -> DataFrame:
    known = {f.name: F.col(f.name) if f.name in df.columns else F.lit(None) for f in MUTATIONS.fields}
    return df.select(*[known[f.name].cast(f.dataType).alias(f.name) for f in MUTATIONS.fields])


def puts_of(cells: DataFrame) -> DataFrame:
    """Cells as a log of puts."""
    return _mutations(cells.withColumn("op", F.lit(PUT)))


def put_cell(
    spark: SparkSession, row_key: str, qualifier: str, at_ms: int, family: str = FAMILY, value: str = PRESENT
) -> DataFrame:
    return spark.createDataFrame([(PUT, row_key, family, qualifier, at_ms, value, None)], MUTATIONS)


def retarget_puts(devices: DataFrame, tag: str, at_ms: int) -> DataFrame:
    """One put of ``ap_<tag>`` per ``(did, os)`` row."""
    return _mutations(
        devices.select(
            F.lit(PUT).alias("op"),
            keys.build_key_by_os("did", "os").alias("row_key"),
            F.lit(FAMILY).alias("family"),
            F.lit(f"ap_{tag}").alias("qualifier"),
            F.lit(at_ms).alias("ts"),
            F.lit(PRESENT).alias("value"),
        )
    )


def taglist_puts(rows: DataFrame, at_ms: int) -> DataFrame:
    """One put per item of the comma list of every ``(did, tags)`` row; ``did`` is a whole key."""
    return _mutations(
        rows.select(
            F.lit(PUT).alias("op"),
            F.lower("did").alias("row_key"),
            F.lit(FAMILY).alias("family"),
            F.explode(split_tag_list("tags")).alias("qualifier"),
            F.lit(at_ms).alias("ts"),
            F.lit(PRESENT).alias("value"),
        )
    )


def delete_rows(row_keys: DataFrame, at_ms: int) -> DataFrame:
    """Deletes of whole rows; the keys are used exactly as given."""
    return _mutations(
        row_keys.select("row_key")
        .distinct()
        .select(
            F.lit(DELETE_ROW).alias("op"),
            "row_key",
            F.lit(None).alias("family"),
            F.lit(None).alias("qualifier"),
            F.lit(at_ms).alias("ts"),
            F.lit(None).alias("value"),
        )
    )


def delete_column(
    log: DataFrame, ids: DataFrame, column: str, at_ms: int, mode: str = "latest", family: str = FAMILY
) -> DataFrame:
    """Deletes of one column for a list of ids (column ``id``).

    ``latest`` hides the newest version up to ``at_ms``, so the one before it
    comes back; ``all`` hides every version up to ``at_ms``. The same call over
    a log that has its deletes already picks the same versions again, as the
    deletes carry ``at_ms``; later puts are left alone.
    """
    targets = ids.select(keys.build_key_by_hyphen("id").alias("row_key")).distinct()
    if mode == "all":
        marked = targets.select("row_key", F.lit(at_ms).alias("ts")).withColumn("op", F.lit(DELETE_COLUMN))
    elif mode == "latest":
        concerned = (F.col("op") == DELETE_ROW) | ((F.col("family") == family) & (F.col("qualifier") == column))
        own = (F.col("op") == DELETE_VERSION) & F.col("marked_at").eqNullSafe(F.lit(at_ms))
        late = (F.col("op") == PUT) & (F.col("ts") > at_ms)
        shown = current_state(log.where(concerned & ~own & ~late).join(targets, "row_key", "left_semi"))
        marked = shown.select("row_key", "ts").withColumns({"op": F.lit(DELETE_VERSION), "marked_at": F.lit(at_ms)})
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return _mutations(
        marked.withColumns({"family": F.lit(family), "qualifier": F.lit(column), "value": F.lit(None)})
    )


def _without_versions(log: DataFrame) -> DataFrame:
    """Puts whose exact version no delete names.

    The join needs no hint: with no such deletes Spark drops it, with few it
    broadcasts them by measured size, with many it merges on the whole cell
    and version, a key that does not run hot.
    """
    dead = log.where(F.col("op") == DELETE_VERSION).select(*CELL_ID, "ts")
    return log.where(F.col("op") == PUT).join(dead, [*CELL_ID, "ts"], "left_anti")


def row_deletes(log: DataFrame) -> DataFrame:
    """The newest delete of every row that has one."""
    return (
        log.where(F.col("op") == DELETE_ROW).groupBy("row_key").agg(F.max("ts").alias("row_deleted_at"))
    )


def column_deletes(log: DataFrame) -> DataFrame:
    """The newest delete of every cell that has one."""
    return log.where(F.col("op") == DELETE_COLUMN).groupBy(*CELL_ID).agg(F.max("ts").alias("column_deleted_at"))


def outlives(marker: str) -> Column:
    """Whether a version is younger than a delete that may be there."""
    return F.col(marker).isNull() | (F.col("ts") > F.col(marker))


def current_state(log: DataFrame) -> DataFrame:
    """The newest visible version of every cell.

    Puts and column deletes fold in one aggregate, map side first, so the
    versions of a hot cell never travel; row deletes meet what is left, one row
    per cell. A cell shows if its newest put is younger than its deletes.
    """
    marks = log.where(F.col("op") == DELETE_COLUMN)
    folded = (
        _without_versions(log)
        .unionByName(marks)
        .groupBy(*CELL_ID)
        .agg(
            F.max(F.when(F.col("op") == PUT, F.struct("ts", "value"))).alias("newest"),
            F.max(F.when(F.col("op") == DELETE_COLUMN, F.col("ts"))).alias("column_deleted_at"),
        )
        .where(F.col("newest").isNotNull())
        .select(*CELL_ID, "newest.ts", "newest.value", "column_deleted_at")
        .where(outlives("column_deleted_at"))
    )
    return (
        folded.join(row_deletes(log), "row_key", "left")
        .where(outlives("row_deleted_at"))
        .select(*CELLS.fieldNames())
    )


def apply_mutations(base: DataFrame, *batches: DataFrame) -> DataFrame:
    """Current state of a base table of cells after batches of puts and deletes."""
    log = puts_of(base)
    for batch in batches:
        log = log.unionByName(batch)
    return current_state(log)


def upsert_cells(mutations: DataFrame, path: str) -> None:
    """Append a batch to the log, one folder per op, so that deletes are read without the puts."""
    mutations.write.mode("append").partitionBy("op").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A log of batches."""
    return spark.read.schema(MUTATIONS).parquet(path).select(*MUTATIONS.fieldNames())

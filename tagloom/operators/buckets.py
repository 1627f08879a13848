"""The wide table as a folded log in buckets of keys.

A key belongs to a bucket by its hash, and every bucket is a folder. Folding a
batch rewrites only the buckets whose keys it names (copy on write, by dynamic
partition overwrite); all others keep their files. A bucket holds what still
matters of all batches so far: versions no delete of a row or column has
hidden, and the newest of those deletes, so that a late put of an old time stays
hidden. Every row carries the number of the last batch folded into its bucket.

Folding is safe to repeat. The new contents are written aside first and are
only then put in place, and buckets that have a batch already are left alone,
so a job that died at any point is simply run again with the same number.
Batches are folded one at a time, by one writer, with rising numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_col
from ..schema import CELL_ID, MUTATIONS
from ..session import BROADCAST_ROWS, LITERALS, listed, named_values
from ..sources.cells import KEY_FILTER, ROW_GROUP
from .mutate import DELETE_COLUMN, DELETE_ROW, DELETE_VERSION, PUT, column_deletes, outlives, row_deletes

VERSIONS = PUT, DELETE_VERSION
KINDS = *VERSIONS, DELETE_COLUMN, DELETE_ROW

STORED = T.StructType([*MUTATIONS.fields, T.StructField("batch", T.LongType())])


@dataclass(frozen=True)
class Buckets:
    """Where a bucketed table lies and how many buckets it has; that number is part of the folders' name."""

    path: str
    count: int

    @property
    def column(self) -> str:
        return f"bucket_of_{self.count}"

    def of(self, row_key: Column | str) -> Column:
        return F.pmod(F.xxhash64(as_col(row_key)), F.lit(self.count)).cast("int")

    def schema(self) -> T.StructType:
        return T.StructType([*STORED.fields, T.StructField(self.column, T.IntegerType())])


def folded(log: DataFrame) -> DataFrame:
    """The part of a log that still matters, whatever comes later.

    Puts and deletes of versions that a delete of their row or column hides are
    gone, and of those deletes only the newest of each row and cell are left.
    A version that is deleted by itself stays, with its delete, so that
    the same choice of versions can be made again. Rows that are alike are one.
    """
    rows, columns = row_deletes(log), column_deletes(log)
    shown = _shown(log.where(F.col("op").isin(*VERSIONS)), columns, rows)
    return shown.distinct().unionByName(_marks(columns, rows))


def _shown(versions: DataFrame, columns: DataFrame, rows: DataFrame) -> DataFrame:
    """Versions that no delete of their column or row hides."""
    return (
        versions.join(columns, CELL_ID, "left")
        .where(outlives("column_deleted_at"))
        .join(rows, "row_key", "left")
        .where(outlives("row_deleted_at"))
        .select(*MUTATIONS.fieldNames())
    )


def _marks(columns: DataFrame, rows: DataFrame) -> DataFrame:
    """The deletes of columns that those of rows leave, and those of rows, as a log."""
    marks = columns.select(F.lit(DELETE_COLUMN).alias("op"), *CELL_ID, F.col("column_deleted_at").alias("ts")).join(
        rows, "row_key", "left"
    )
    marks = marks.where(outlives("row_deleted_at")).drop("row_deleted_at")
    all_rows = rows.select(F.lit(DELETE_ROW).alias("op"), "row_key", F.col("row_deleted_at").alias("ts"))
    every = marks.unionByName(all_rows, allowMissingColumns=True)
    known = {f.name: F.col(f.name) if f.name in every.columns else F.lit(None) for f in MUTATIONS.fields}
    return every.select(*[known[f.name].cast(f.dataType).alias(f.name) for f in MUTATIONS.fields])


def _of_kinds(log: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """A log of some kinds of operations, kind by kind: Spark sees which there are none of and leaves out their joins."""
    parts = [log.where(F.col("op") == kind).withColumn("op", F.lit(kind)) for kind in kinds]
    return reduce(DataFrame.unionByName, parts) if parts else log.where(F.lit(False))


def _kinds(log: DataFrame) -> list[str]:
    """The kinds of operations in a log, four at most."""
    return sorted(r[0] for r in log.select("op").where(F.col("op").isin(*KINDS)).distinct().collect())


def merged(old: DataFrame, fresh: DataFrame, kinds: Sequence[str], aside: str) -> DataFrame:
    """``folded`` of a folded log and a batch that has some kinds of operations.

    What is old has outlived the old deletes and is distinct, so it meets
    only the deletes of the batch; without any it stays as it is. The versions
    of the batch meet all deletes. Deletes and versions of the batch are
    written aside once: few of them are broadcast to the old rows, which then
    need no shuffle.
    """
    is_version = F.col("op").isin(*VERSIONS)
    deleting = [kind for kind in kinds if kind not in VERSIONS]
    kept, marks, log = old.where(is_version), old.where(~is_version), old
    if deleting:
        named = _of_kinds(_stored(_marks(column_deletes(fresh), row_deletes(fresh)), f"{aside}/deletes"), deleting)
        log = old.unionByName(named)
        kept = _shown(kept, column_deletes(named), row_deletes(named))
        marks = _marks(column_deletes(log), row_deletes(log))
    if len(deleting) < len(kinds):
        shown = _shown(fresh.where(is_version), column_deletes(log), row_deletes(log))
        shown = _stored(shown.distinct(), f"{aside}/versions")
        kept = _unlike(kept, shown).unionByName(shown)
    return kept.unionByName(marks)


def _stored(log: DataFrame, path: str) -> DataFrame:
    log.write.mode("overwrite").parquet(path)
    return log.sparkSession.read.schema(MUTATIONS).parquet(path)


def _unlike(log: DataFrame, others: DataFrame) -> DataFrame:
    """Rows that are not among stored others. They meet by one number, which sorts fast and never runs hot."""
    names = MUTATIONS.fieldNames()
    few = others.count() <= BROADCAST_ROWS
    left = log.withColumn("digest", F.xxhash64(*names)).alias("l")
    right = others.withColumn("digest", F.xxhash64(*names)).alias("r").hint("broadcast" if few else "merge")
    alike = reduce(Column.__and__, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in names])
    return left.join(right, (F.col("l.digest") == F.col("r.digest")) & alike, "left_anti").select(*names)


def read_stored(spark: SparkSession, buckets: Buckets) -> DataFrame:
    """All rows with their bucket; a table that is not there has none."""
    try:
        found = spark.read.schema(buckets.schema()).parquet(buckets.path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], buckets.schema())
    return found


def read_log(spark: SparkSession, buckets: Buckets) -> DataFrame:
    """The table as a log: what ``current_state`` and ``delete_column`` take."""
    log = read_stored(spark, buckets).select(*MUTATIONS.fieldNames())
    return _of_kinds(log, _kinds(log))


def watermarks(spark: SparkSession, buckets: Buckets, among: Sequence[int] | None = None) -> DataFrame:
    """``(bucket, batch)``: the last batch of every bucket, or of some, whose folders alone are read.

    Only one column is, and it is alike in all rows of a file.
    """
    stored = read_stored(spark, buckets)
    if among is not None:
        stored = stored.where(F.col(buckets.column).isin(*among))
    return stored.groupBy(F.col(buckets.column).alias("bucket")).agg(F.max("batch").alias("batch"))


def _behind(spark: SparkSession, buckets: Buckets, among: Sequence[int], number: int) -> list[int]:
    """Those of some buckets that have neither the batch nor a later one."""
    done = watermarks(spark, buckets, among).where(F.col("batch") >= number).select("bucket")
    return sorted(set(among) - set(_numbers(done)))


def _numbers(df: DataFrame) -> list[int]:
    """Bucket numbers of a frame; as many as there are buckets at most."""
    return sorted(r[0] for r in df.distinct().collect())


def _writer(rows: DataFrame, buckets: Buckets) -> DataFrameWriter:
    """A writer of rows by bucket; in each task keys are in order."""
    ordered = rows.sortWithinPartitions(buckets.column, "row_key", "qualifier", "ts")
    writer = ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**ROW_GROUP)
    return writer.partitionBy(buckets.column)


def _write(rows: DataFrame, buckets: Buckets, path: str) -> None:
    """Put rows in place that were written aside by bucket: they lie together already and are not shuffled again."""
    _writer(rows, buckets).options(**KEY_FILTER).parquet(path)


def _ready(spark: SparkSession, path: str) -> list[int] | None:
    """Buckets of a batch that was written aside to its end, or None."""
    try:
        return _numbers(spark.read.schema("bucket int").parquet(path))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _stage(spark: SparkSession, buckets: Buckets, batch: DataFrame, number: int, aside: str) -> list[int]:
    """Write the new contents of the buckets a batch names, and then, as the sign that they are whole, their numbers."""
    at, names = buckets.of("row_key"), MUTATIONS.fieldNames()
    named = batch.select(at.alias("bucket"), "op").distinct().collect()  # as many as buckets, four times at most
    touched = _behind(spark, buckets, sorted({r.bucket for r in named}), number)
    kinds = sorted({r.op for r in named if r.op in KINDS})
    fresh = _of_kinds(batch.select(*names).where(at.isin(touched)), kinds)
    old = read_stored(spark, buckets).where(F.col(buckets.column).isin(touched)).select(*names)
    held = _kinds(old)
    log = merged(_of_kinds(old, held), fresh, kinds, f"{aside}/fresh") if held else folded(fresh)
    rows = log.withColumns({"batch": F.lit(number).cast("long"), buckets.column: at})
    # a large bucket is split over tasks
    _writer(rows.hint("rebalance", F.col(buckets.column)), buckets).parquet(f"{aside}/rows")
    spark.createDataFrame([(b,) for b in touched], "bucket int").write.mode("overwrite").parquet(f"{aside}/ready")
    return touched


def fold_batch(spark: SparkSession, buckets: Buckets, batch: DataFrame, number: int, staging: str) -> list[int]:
    """Fold a batch of mutations into the table; returns the buckets that were rewritten.

    ``number`` names the batch: repeat it after a failure, raise it for the
    next batch. ``staging`` is a folder on the same store, where each batch gets
    a folder of its own that may be removed once the call has returned.
    """
    aside = f"{staging.rstrip('/')}/batch-{number}"
    touched = _ready(spark, f"{aside}/ready")
    if touched is None:
        touched = _stage(spark, buckets, batch, number, aside)
    # the others were put in place by an earlier attempt
    todo = _behind(spark, buckets, touched, number)
    if todo:
        rows = spark.read.schema(buckets.schema()).parquet(f"{aside}/rows")
        _write(rows.where(F.col(buckets.column).isin(todo)), buckets, buckets.path)
    return todo


def rows_of_keys(spark: SparkSession, buckets: Buckets, row_keys: Sequence[str]) -> DataFrame:
    """The part of the log that concerns some keys the caller holds: only their folders are listed and read."""
    if len(row_keys) > LITERALS:
        return rows_of(spark, buckets, listed(spark, list(row_keys), "row_key"))
    if not row_keys:
        return read_stored(spark, buckets).where(F.lit(False)).select(*MUTATIONS.fieldNames())
    wanted = F.col("row_key").isin(*row_keys) & F.col(buckets.column).isin(*[buckets.of(F.lit(k)) for k in row_keys])
    return read_stored(spark, buckets).where(wanted).select(*MUTATIONS.fieldNames())


def rows_of(spark: SparkSession, buckets: Buckets, requested: DataFrame) -> DataFrame:
    """The part of the log that concerns the keys of a frame; their buckets prune the folders while the job runs."""
    asked = named_values(requested.select("row_key"), "row_key").distinct()
    asked = asked.withColumn(buckets.column, buckets.of("row_key"))
    found = read_stored(spark, buckets).join(asked, [buckets.column, "row_key"], "left_semi")
    return found.select(*MUTATIONS.fieldNames())

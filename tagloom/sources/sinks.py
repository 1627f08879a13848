"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import join_fields

# Fixed value: records per JSON or text file.
RECORDS_PER_FILE = 100_000


def sized(df: DataFrame, files: int | None, folders: list[str] | None = None) -> DataFrame:
    """The rows in a given number of files, or in files of Spark's advisory size.

    Both add a shuffle on purpose: narrowing without one would leave the whole
    last stage with that few tasks. With ``folders``, rows of a folder meet, so
    not every task writes to every folder, and AQE splits what is too big.
    """
    return df.repartition(files) if files else df.hint("rebalance", *map(F.col, folders or []))


def write_parquet_compact(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite") -> None:
    sized(df, files).write.mode(mode).parquet(path)


def write_delimited_text(
    df: DataFrame,
    path: str,
    delimiter: str = ",",
    partition_by: list[str] | None = None,
    files: int | None = None,
    mode: str = "overwrite",
) -> str:
    """Write all columns of a row as one line; returns the header of the lines."""
    partition_by = partition_by or []
    fields = [c for c in df.columns if c not in partition_by]
    lines = sized(df.select(join_fields(fields, delimiter).alias("value"), *partition_by), files, partition_by)
    lines.write.mode(mode).partitionBy(*partition_by).text(path)
    return delimiter.join(fields)


def write_uid_text(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = ("kind", "project", "day"),
    files: int = 10,
    mode: str = "overwrite",
) -> None:
    """Write ``uid`` lines into one folder per kind, project and day.

    Rows meet by folder and by one of ``files`` slices of the uid, so a folder
    gets at most that many files and a hot one is still written by many tasks.
    Uids that are null give no line.
    """
    slice_ = F.pmod(F.xxhash64("uid"), F.lit(files))
    rows = df.where(F.col("uid").isNotNull()).select("uid", *partition_by)
    # AQE may split what is too big, hence a rebalance and not a plain repartition
    spread = rows.withColumn("slice", slice_).hint("rebalance", *map(F.col, [*partition_by, "slice"])).drop("slice")
    spread.write.mode(mode).partitionBy(*partition_by).text(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("maxRecordsPerFile", RECORDS_PER_FILE).json(path)


def write_lines(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Write a frame of one text column, plus folders, in files of limited length."""
    df.write.mode(mode).option("maxRecordsPerFile", RECORDS_PER_FILE).partitionBy(*partition_by).text(path)


def write_csv_pairs(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write columns joined by commas, such as key and last update, in chunks."""
    write_lines(df.select(join_fields(df.columns).alias("value")), path, mode=mode)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def create_table(spark: SparkSession, table: str, path: str | None = None) -> bool:
    """Create an empty cell table; false if it was there already."""
    if table_exists(spark, table):
        return False
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (row_key STRING, family STRING, qualifier STRING, ts BIGINT, value STRING)"
        f" USING parquet{location}"
    )
    return True


def drop_table(spark: SparkSession, table: str) -> bool:
    """Drop a table; false if there was none."""
    there = table_exists(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    return there

"""Id files, tag lists and nested logs."""

from __future__ import annotations

from urllib.parse import quote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import split_tag_list


def read_parquet_ids(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_json_ids(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """JSON lines; a schema saves the extra pass that infers one."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def read_id_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines, column ``value``; ``path`` may be a glob such as ``base/{a,b}/*``."""
    return spark.read.text(path)


def read_glob_union(spark: SparkSession, base: str, kinds: list[str], projects: list[str]) -> DataFrame:
    """Uid lines of several kinds and projects, as ``write_uid_text`` lays them out."""
    return read_id_lines(spark, f"{base}/kind={{{','.join(kinds)}}}/project={{{','.join(projects)}}}/*")


def read_dir_recursive(spark: SparkSession, path: str) -> DataFrame:
    """Lines of every file below a folder, each with the path of its file."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("path"))


def below(lines: DataFrame, folder: str) -> DataFrame:
    """``path`` without scheme, host and the folder that was read."""
    whole = F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    base = quote(urlparse(folder).path.rstrip("/")) + "/"
    start = F.instr(whole, base)
    inner = F.when(start > 0, F.substring(whole, start + len(base), F.length(whole))).otherwise(whole)
    return lines.withColumn("path", inner)


def read_filter_tags(spark: SparkSession, path: str) -> DataFrame:
    """Tags of the comma list in the first line of the one file at ``path``.

    The first line sits in the block that starts at 0, whatever the file's size.
    Spark cannot see how long the line is: write the tags down before a join
    that may broadcast them.
    """
    lines = spark.read.text(path)
    if len(lines.inputFiles()) != 1:
        raise ValueError(f"the filter tags must be in one file, {path} has {len(lines.inputFiles())}")
    first = lines.where("_metadata.file_block_start = 0").limit(1)
    return first.select(F.explode(split_tag_list("value")).alias("tag"))


def require_tags(tags: DataFrame) -> DataFrame:
    if tags.isEmpty():
        raise ValueError("the filter tags are empty")
    return tags

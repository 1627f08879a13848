"""Helpers the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.session import work_dir

# A word is a run of anything but ASCII white space; a fixed pattern.
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the cluster's shared folder and read it back.

    Cuts the lineage: work that later steps read more than once is done once
    and outlives lost executors.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator works on; a null text is an empty one."""
    return df.select(F.col(f"`{id_col}`").alias(id_col), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % modulus

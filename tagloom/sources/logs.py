"""Ad logs in one folder per kind, partitioned by day."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schema import LOGS
from . import avro


def read_day_logs(
    spark: SparkSession,
    paths: dict[str, str],
    start: str | None = None,
    end: str | None = None,
    fmt: str = "parquet",
    schema: StructType = LOGS,
) -> DataFrame:
    """Union of the logs of every kind in ``paths`` over inclusive ``yyyyMMdd`` days, all by default.

    The literal day bounds prune folders before any file is opened. The schema
    is explicit, since inference reads the day folders as integers. ``fmt`` may
    be ``avro``: read by Spark's package where that is on the classpath, else by
    the source in ``avro``.
    """
    wanted = F.lit(True)
    if start is not None:
        wanted = wanted & (F.col("day") >= start)
    if end is not None:
        wanted = wanted & (F.col("day") <= end)
    bounds = {}
    if fmt == "avro" and not has_avro(spark):
        fmt = avro.register(spark)
        bounds = {name: day for name, day in (("start", start), ("end", end)) if day is not None}
    per_kind = [
        spark.read.format(fmt).schema(schema).options(**bounds).load(path).where(wanted).withColumn("kind", F.lit(kind))
        for kind, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, per_kind)


def has_avro(spark: SparkSession) -> bool:
    """Whether Spark's own Avro package is on the classpath."""
    try:
        spark.read.format("avro").schema("day string").load([])
    except AnalysisException:
        return False
    return True


def write_day_logs(logs: DataFrame, paths: dict[str, str], fmt: str = "parquet") -> None:
    """Write logs in the layout ``read_day_logs`` reads; a busy day is split over several files."""
    own = fmt == "avro" and not has_avro(logs.sparkSession)
    for kind, path in paths.items():
        rows = logs.where(F.col("kind") == kind).drop("kind").hint("rebalance", F.col("day"))
        if own:  # it makes the folders of the days itself
            rows.write.format(avro.register(logs.sparkSession)).mode("append").save(path)
        else:
            rows.write.format(fmt).partitionBy("day").save(path)

"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Short rows a frame built from driver-side lists may have and still be broadcast. Beyond it
# only the join strategy differs, never the rows.
BROADCAST_ROWS = 100_000

# Keys or ids that may stand in a plan as literals; a limit of the plan only.
LITERALS = 1_000

RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a join with a list of keys or ids sends their bloom filter to the scan of the large side
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64MB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
    # lists of so many literals reach Parquet as equalities, which its filters can answer, not as a range
    "spark.sql.parquet.pushdown.inFilterThreshold": str(LITERALS),
}

# Settled when a session starts: no stack walk for every column expression built.
START_DEFAULTS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app: str = "tagloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library defaults; ``conf`` entries win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**START_DEFAULTS, **RUNTIME_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime defaults on a session somebody else created."""
    for key, value in RUNTIME_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local master without that setting gets a folder on this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/tagloom/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared work folder and read it back.

    It is computed once, outlives lost executors, and has a size on disk, by
    which Spark decides whether it may be broadcast.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def named_values(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is neither null nor empty; nothing matches those.

    The filter also tells Spark that a join with these rows is selective, so that it
    prepares a bloom filter of them where both sides have to be shuffled.
    """
    return df.where(F.col(column) != "")


def listed(spark: SparkSession, values: list[str], column: str) -> DataFrame:
    """A one-column frame of driver-side values, broadcast only if it is short."""
    frame = spark.createDataFrame([(v,) for v in values], f"{column} string")
    return F.broadcast(frame) if len(values) <= BROADCAST_ROWS else frame

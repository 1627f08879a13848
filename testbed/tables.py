"""The datasets the engine works on, derived from the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagloom.operators import audience, export
from tagloom.operators.audience import Project
from tagloom.schema import NESTED, RETARGET, TAG_LIST
from tagloom.session import apply_defaults, work_dir
from tagloom.sources import cells as cell_source
from tagloom.sources import logs as log_source

# Where the stored datasets of each session and table folder are.
_PATHS: dict[tuple[str, str, str], str] = {}

# What the supplied files look like.
_SCHEMAS: dict[str, StructType] = {}

PROJECTS = [
    Project("p1", True, False, 0, ("1", "2"), "20240105", "20240110"),
    Project("p2", True, True, 1, ("103",), "20240108", "20240115"),
]


def device_id(n: Column) -> Column:
    """Device id of a number: odd ones look like UUIDs, even ones are plain MD5."""
    digest = F.md5(n.cast("string"))
    uuid = digest  # hyphens go in from the right, so that the digest, the dear part, is named and computed once
    for at in (21, 17, 13, 9):
        uuid = F.overlay(uuid, F.lit("-"), F.lit(at), F.lit(0))
    return F.when(n % 2 == 1, uuid).otherwise(digest)


def pick(n: Column, *values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = apply_defaults(spark)
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _SCHEMAS:  # reading the schema off the files is a job of its own
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def _stored(self, name: str, write: Callable[[str], None], read: Callable[[str], DataFrame]) -> DataFrame:
        """A dataset the jobs find on disk: written once per session, then read."""
        place = (self.spark.conf.get("spark.app.id", ""), self.sf_dir, name)
        if place in _PATHS:
            try:
                return read(_PATHS[place])
            except AnalysisException:  # the work folder was cleared meanwhile
                pass
        path = work_dir(self.spark, name)
        write(path)
        _PATHS[place] = path
        return read(path)

    def cells(self) -> DataFrame:
        return self._stored(
            "cells",
            lambda path: cell_source.write_cells(self.derived_cells(), path),
            lambda path: cell_source.scan_cells(self.spark, path),
        )

    def logs(self) -> DataFrame:
        def paths(base: str) -> dict[str, str]:
            return {kind: f"{base}/{kind}" for kind in audience.KINDS}

        return self._stored(
            "logs",
            lambda base: log_source.write_day_logs(self.derived_logs(), paths(base)),
            lambda base: log_source.read_day_logs(self.spark, paths(base)),
        )

    def derived_cells(self) -> DataFrame:
        event, user = F.col("event_id"), F.col("user_id")
        did = device_id(user)
        kind = F.when(user % 2 == 1, F.lit("ifa")).otherwise(F.lit("didmd5"))
        code = F.concat(F.lpad(((event * 7 + user) % 40).cast("string"), 3, "0"), F.lit("001"))
        vendor = pick(event, "mh", "td", "up", "ap", "kd", "am", "qx", "sz")
        parts = self.raw("events").select(
            user.alias("u"), event.alias("e"), did.alias("did"), kind.alias("kind"), code.alias("code"),
            vendor.alias("vendor"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        )
        row_key = (
            F.when(F.expr("u % 29 = 3"), F.concat(F.upper("did"), F.lit(":"), "kind"))
            .when(F.expr("u % 31 = 1"), F.concat("did", "kind"))
            .when(F.expr("u % 37 = 2"), F.concat(F.substring("did", 1, 20), F.lit(":"), "kind"))
            .otherwise(F.concat("did", F.lit(":"), "kind"))
        )
        qualifier = (
            F.when(F.expr("e % 97 = 0"), F.lit("mh_1"))
            .when(F.expr("e % 41 = 0"), F.concat(F.lit("x_ap_"), "code"))
            .otherwise(F.concat("vendor", F.lit("_"), "code"))
        )
        return parts.select(
            row_key.alias("row_key"), F.lit("cf").alias("family"), qualifier.alias("qualifier"), "ts",
            F.expr("cast(e % 10 as string)").alias("value"),
        )

    def derived_logs(self) -> DataFrame:
        event = F.col("event_id")
        did = device_id(F.col("user_id"))
        uid = F.when(event % 3 == 0, F.upper(did)).when(event % 3 == 1, F.concat(F.lit(" "), did)).otherwise(did)
        return self.raw("events").select(
            F.when(F.col("event_type").isin("click", "purchase"), F.lit("clk")).otherwise(F.lit("imp")).alias("kind"),
            F.date_format("ts", "yyyyMMdd").alias("day"),
            uid.alias("uid"),
            (event % 5).alias("cid"),
            (100 + event % 7).alias("creative_id"),
        )

    def lines(self) -> DataFrame:
        n = F.col("c_custkey") % 50
        did = device_id(F.col("c_custkey") % 400)
        line = (
            F.when(n == 7, F.lit("short,line"))
            .when(n == 8, F.concat("c_name", "c_mktsegment"))
            .when(n == 9, F.concat("c_name", F.lit(","), F.upper(did), F.lit("\t,"), "c_mktsegment"))
            .otherwise(F.concat_ws(",", "c_name", did, "c_mktsegment"))
        )
        return self.raw("customer").select(line.alias("value"))

    def nested(self) -> DataFrame:
        return self._stored(
            "nested",
            lambda path: self.derived_nested().write.parquet(path),
            lambda path: self.spark.read.schema(NESTED).parquet(path),
        )

    def derived_nested(self) -> DataFrame:
        """Result logs with the nested results of an order; some orders have none, or a null list."""
        customer, order = F.col("o_custkey"), F.col("o_orderkey")
        result = F.struct(
            (1100000 + F.col("l_partkey") % 50).cast("string").alias("dealid"),
            F.when(F.col("l_returnflag") == "A", F.lit("1005"))
            .when(F.col("l_returnflag") == "N", F.lit("1006"))
            .otherwise(F.lit("1007"))
            .alias("resultCode"),
        )
        lists = self.raw("lineitem").groupBy("l_orderkey").agg(F.collect_list(result).alias("found"))
        joined = self.raw("orders").join(lists, order == F.col("l_orderkey"), "left")
        none = F.array().cast("array<struct<dealid:string,resultCode:string>>")
        results = F.when(order % 13 == 0, None).when(order % 11 == 0, none).otherwise(F.col("found"))
        return joined.select(
            F.md5(customer.cast("string")).alias("deviceId"),
            (customer % 2).cast("string").alias("deviceType"),
            results.alias("results"),
            F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("timestamp"),
        )

    def ids(self) -> DataFrame:
        """One device id per customer; some are devices with cells."""
        return self.raw("customer").select(device_id(F.col("c_custkey")).alias("id"))

    def debtors(self) -> DataFrame:
        """Row keys of the customers in debt."""
        ids = self.raw("customer").where(F.col("c_acctbal") < 0).select(device_id(F.col("c_custkey")).alias("value"))
        return ids.select(F.concat("value", F.when(F.contains("value", F.lit("-")), F.lit(":ifa"))
                                   .otherwise(F.lit(":didmd5"))).alias("row_key"))

    def retarget(self) -> DataFrame:
        return self._stored(
            "retarget",
            lambda path: audience.ids_of_lines(self.lines(), ",", 1).withColumnRenamed("id", "did").write.parquet(path),
            lambda path: self.spark.read.schema(RETARGET).parquet(path),
        )

    def taglist(self) -> DataFrame:
        def derived() -> DataFrame:
            devices = export.assemble(self.cells(), {"tags": F.col("qualifier")})
            return devices.select(F.col("row_key").alias("did"), F.array_join("tags", ",").alias("tags"))

        return self._stored(
            "taglist",
            lambda path: derived().write.parquet(path),
            lambda path: self.spark.read.schema(TAG_LIST).parquet(path),
        )

"""Schemas of the datasets the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

# One row per stored version of one tag of one device; presence is the data.
CELLS = T.StructType(
    [
        T.StructField("row_key", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("qualifier", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)

CELL_ID = ["row_key", "family", "qualifier"]

# ``op`` is one of put, delete_row, delete_column, delete_version.
# ``marked_at`` is the time of the mutation that chose a version to delete.
MUTATIONS = T.StructType(
    [T.StructField("op", T.StringType()), *CELLS.fields, T.StructField("marked_at", T.LongType())]
)

LOGS = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("cid", T.LongType()),
        T.StructField("creative_id", T.LongType()),
        T.StructField("day", T.StringType()),
    ]
)

NESTED = T.StructType(
    [
        T.StructField("deviceId", T.StringType()),
        T.StructField("deviceType", T.StringType()),
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("dealid", T.StringType()),
                        T.StructField("resultCode", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField("timestamp", T.LongType()),
    ]
)

RETARGET = T.StructType([T.StructField("did", T.StringType()), T.StructField("os", T.StringType())])

TAG_LIST = T.StructType([T.StructField("did", T.StringType()), T.StructField("tags", T.StringType())])

EXPORT_LINE = T.StructType(
    [
        T.StructField("did", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)

# Fixed values.
FAMILY = "cf"
PRESENT = "1"

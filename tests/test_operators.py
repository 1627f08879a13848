import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tagloom.operators import aggregate, audience, export, lookup, quality, scan
from tagloom.operators.audience import Project, campaign_filter, parse_projects
from tagloom.session import listed
from tagloom.sources.cells import latest_cells, write_clustered_table

from .conftest import rows

A = "a" * 32
B = "b" * 32
U = "abcdef01-2345-6789-abcd-ef0123456789"


def test_latest_takes_newest_version(cells):
    got = cells((f"{A}:x", "kd_1", 1, "1"), (f"{A}:x", "kd_1", 3, "3"), (f"{A}:x", "kd_1", 2, "9"))
    assert rows(latest_cells(got, value=True)) == [(f"{A}:x", "cf", "kd_1", 3, "3")]
    assert rows(latest_cells(got, ts=True)) == [(f"{A}:x", "cf", "kd_1", 3)]
    assert latest_cells(got).count() == 1


def test_exports_of_two_colons_and_none(cells):
    table = cells(("a:b:c", "kd_1"), ("abc", "kd_1"), ("abc", "kd"))
    assert rows(export.tags_as_string(table)) == [("a:b", "1")]
    assert rows(scan.flat_tags(table)) == [("a:b", "1")]
    assert rows(quality.dirty_rowkeys(table)) == rows(quality.legacy_key_audit(table)) == [("a:b:c",), ("abc",)]


def test_clean_export(cells):
    table = cells(
        (f"{A}:didmd5", "mh_012345"),
        (f"{A}:didmd5", "kd_9"),
        (f"{A}:didmd5", "am_1"),
        (f"{A}:didmd5", "mh_01"),
        (f"{B}:didmd5", "bad_x"),
        (f"{U}:ifa", "td_1"),
        (f"{U.upper()}:ifa", "td_1"),
        (f"{'c' * 32}:foobar", "kd_1"),
    )
    assert rows(export.clean_export(table)) == [
        (f"{U.upper()}:ifa", "0111", 1),
        (f"{A}:didmd5", "0181,0179,0100120345", 0),  # order of the raw qualifiers
        (f"{B}:didmd5", "", 0),  # all columns illegal
        (f"{'c' * 32}:didmd5", "0171", 0),
    ]
    assert rows(quality.dirty_columns(table)) == [(A, "mh_01"), (B, "bad_x")]
    assert rows(quality.dirty_rowkeys(table)) == [(f"{U.upper()}:ifa",)]
    assert rows(quality.dirty_summary(table)) == [(4, 1, 2)]


def skewed_cells(spark, devices=200, hot_tags=400, versions=20):
    """Cells of which one key holds most, and one of its cells a third of all."""
    rng = random.Random(3)
    data = [(f"{A}:didmd5", f"kd_{i:05d}", v) for i in range(hot_tags) for v in range(3)]
    data += [(f"{A}:didmd5", "kd_00000", 100 + v) for v in range(devices * versions // 2)]
    data += [
        (f"{d:032d}:didmd5", f"{rng.choice(['kd', 'td', 'zz'])}_{rng.randrange(30):05d}", v)
        for d in range(devices)
        for v in range(versions)
    ]
    schema = "row_key string, qualifier string, ts bigint"
    df = spark.createDataFrame(data, schema).repartition(6)
    expected = defaultdict(set)
    for key, q, _ in data:
        expected[key].add(q)
    return df.select("row_key", F.lit("cf").alias("family"), "qualifier", "ts", F.lit("1").alias("value")), expected


def test_assemble_has_one_record_per_key(spark):
    table, expected = skewed_cells(spark)
    got = export.assemble(table, {"q": F.col("qualifier")}).collect()
    assert {r.row_key: r.q for r in got} == {k: sorted(v) for k, v in expected.items()} and len(got) == len(expected)


def test_index_parts_are_disjoint_and_whole(spark):
    table, expected = skewed_cells(spark)
    table = table.unionByName(
        spark.range(3000).select(
            F.concat(F.lpad(F.col("id").cast("string"), 32, "x"), F.lit(":didmd5")).alias("row_key"),
            F.lit("cf").alias("family"), F.lit("kd_hot").alias("qualifier"), F.lit(1).alias("ts"), F.lit("1").alias("value"),
        )
    )
    whole = {(r.tag, r.rowkey) for r in aggregate.tag_index(table).collect()}
    got = aggregate.tag_to_devices(table, parts=6).collect()
    pairs = [(r.tag, d) for r in got for d in r.rowkeys]
    assert len(pairs) == len(set(pairs)) and set(pairs) == whole
    hot = [r for r in got if r.tag == "hot"]
    assert sorted(r.part for r in hot) == list(range(6))
    assert all(300 < len(r.rowkeys) < 700 for r in hot)
    assert all(r.rowkeys == sorted(r.rowkeys) for r in got)
    single = aggregate.tag_to_devices_text(table).where("tag = 'hot'").collect()
    assert len(single) == 1 and single[0].part == 0 and single[0].rowkeys.count(",") == 2999


def test_reach_against_index(spark):
    table, _ = skewed_cells(spark)
    reach = dict(aggregate.tag_reach(table, top=1000).collect())
    counted = dict(aggregate.tag_index(table).groupBy("tag").count().collect())
    assert reach == counted


def test_export_round_trip_and_partition_of_keys(spark):
    table, expected = skewed_cells(spark)
    exported = export.export_array(table)
    assert {r.did: r.tags for r in exported.collect()} == {k[:32]: sorted(v) for k, v in expected.items()}
    keys = table.select("row_key").distinct().count()
    assert export.clean_export(table).count() + quality.dirty_rowkeys(table).count() == keys


def test_clustered_table_needs_no_shuffle(spark, tmp_path):
    table, expected = skewed_cells(spark)
    write_clustered_table(table, "clustered_cells", 4, str(tmp_path / "clustered"))
    try:
        stored = spark.table("clustered_cells")
        for result in (export.clean_export(stored), export.tags_as_array(stored), export.last_update(stored)):
            assert "Exchange" not in result._jdf.queryExecution().executedPlan().toString()
        assert rows(export.tags_as_string(stored)) == rows(export.tags_as_string(table))
    finally:
        spark.sql("DROP TABLE clustered_cells")


def test_prefix_filter_reaches_the_scan(spark, tmp_path):
    table, _ = skewed_cells(spark)
    path = str(tmp_path / "cells")
    table.write.parquet(path)
    stored = spark.read.schema(table.schema).parquet(path)
    plan = scan.prefix_scan_keys(stored, "kd_0001")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(qualifier,kd_0001)" in plan
    assert "ReadSchema: struct<row_key:string,qualifier:string>" in plan
    updates = scan.vendor_updates(stored)._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(qualifier,kd)" in updates


def test_prefix_scan_keeps_one_row_per_whole_key(cells):
    table = cells((f"{A}:didmd5", "kd_1"), (f"{A}:didmd5", "kd_2"), (f"{A}:ifa", "kd_1"), (f"{B}:didmd5", "td_1"), ("x:y", "kd_1"))
    assert rows(scan.prefix_scan_keys(table, "kd")) == [(A,), (A,)]


def test_lookup(spark, cells):
    table = cells(
        (f"{A}:didmd5", "kd_017_9"), (f"{A}:didmd5", "kd_017_8"), (f"{A}:didmd5", "kd"), (f"{A}:didmd5", "mh_1"),
        (f"{A}:didmd5", "zz_1"), (f"{B}:didmd5", "td_1"),
    )
    asked = spark.createDataFrame([(f"{A}:didmd5",), (f"{A}:didmd5",), ("absent:ifa",)], "row_key string")
    empty = {n: [] for n in ("md", "td", "up", "ap", "kd", "am", "qx", "sz")}
    got = {r.row_key: r.tags for r in lookup.lookup_vendor_tags(table, asked).collect()}
    assert got == {f"{A}:didmd5": {**empty, "kd": ["017", "017"], "md": ["1"]}, "absent:ifa": empty}
    got = {r.row_key: r.tags for r in lookup.lookup_vendor_tags(table, asked, "mh_1").collect()}
    assert got == {f"{A}:didmd5": {**empty, "md": ["1"]}, "absent:ifa": empty}
    assert [tuple(r)[:5] for r in lookup.get_row(table, f"{B}:didmd5").collect()] == [(f"{B}:didmd5", "cf", "td_1", 1, "1")]
    assert lookup.get_row(table, f"{B}:didmd5").first().key_bytes == 39


def test_audience_filter_keeps_repeats_and_agrees_with_arrays(spark):
    table, _ = skewed_cells(spark)
    wanted = ["00003", "00399"]
    hits = {r.row_key for r in lookup.keys_with_tags(table, listed(spark, wanted, "tag")).collect()}
    arrays = export.tags_as_array(table).where(lookup.tags_intersect("tags", wanted)).collect()
    assert {r.rowkey for r in arrays} == {k[:32] for k in hits} and hits
    ids = table.select("row_key")
    kept = lookup.audience_filter(ids, table, listed(spark, wanted, "tag"))
    assert kept.count() == ids.where(F.col("row_key").isin(*hits)).count()


def logs_of(spark, *data):
    return spark.createDataFrame(list(data), "kind string, day string, uid string, cid bigint, creative_id bigint")


def test_campaign_filter(spark):
    logs = logs_of(
        spark,
        ("imp", "20240101", "u1", 1, 100),
        ("imp", "20240101", "u2", 2, 103),
        ("clk", "20240101", "u3", 1, 103),
        ("imp", "20240103", "u4", 1, 103),
        ("imp", "20231231", "u5", 1, 103),
    )
    p = Project("p", True, False, 0, ("1",), "20240101", "20240102")
    q = Project("q", True, True, 1, ("103", "104"), "20240101", "20240103")
    got = campaign_filter(logs, [p, q, p]).select("slot", "project", "uid")
    assert rows(got) == [(0, "p", "u1"), (1, "q", "u2"), (1, "q", "u3"), (1, "q", "u4"), (2, "p", "u1")]
    # ids past the literal filter and the broadcast size give the same rows
    many = Project("p", True, False, 0, tuple(str(i) for i in range(1, 60_000)), "20240101", "20240102")
    assert rows(campaign_filter(logs, [many]).select("uid")) == [("u1",), ("u2",)]
    assert campaign_filter(logs, [Project("n", False, False, 0, ("1",), "20240101", "20240102")]).count() == 0
    back = Project("r", True, False, 0, ("1",), "20240102", "20240101")
    assert campaign_filter(logs, [back]).count() == 0


def test_campaign_extract_fields(spark):
    logs = logs_of(spark, ("imp", "20240101", "u1", 1, 100))
    p = Project("p", True, False, 0, ("1",), "20240101", "20240102")
    got = audience.campaign_extract(logs, [p], ["concat(uid, ',', cid) as both"])
    assert got.columns == ["both", *audience.FOLDERS] and rows(got) == [("u1,1", "p", "imp", "20240101")]
    assert audience.campaign_extract(logs, [p]).columns == [*logs.columns, *audience.FOLDERS]


def test_parse_projects():
    got = parse_projects("p,q", "1,0", "0,1", "0,1", "1,2;103", "20240101,20240102", "20240103,20240104")
    assert got[0] == Project("p", True, False, 0, ("1", "2"), "20240101", "20240103")
    assert got[1].id_column == "creative_id" and got[1].kinds == ["clk"]
    with pytest.raises(ValueError):
        parse_projects("p,q", "1", "0,1", "0,1", "1;2", "a,b", "c,d")


def test_validate_projects(spark):
    data = [("a,b", "1,0", "1,2;3"), ("a,b", "1", "1,2;3"), ("a", "1,", "x;"), (None, "1", "1"), ("a,b", "0,1", "1;2;3;")]
    config = spark.createDataFrame(data, "projects string, imp string, ids string")
    delimiters = {"projects": ",", "imp": ",", "ids": ";"}
    errors = [r.error for r in quality.validate_projects(config, delimiters).collect()]
    start = "the parallel lists differ in length: "
    wanted = [None, "projects 2, imp 1, ids 2", None, "projects 0, imp 1, ids 1", "projects 2, imp 2, ids 3"]
    assert errors == [w and start + w for w in wanted]
    aligned = quality.validate_projects(config.where(quality.lists_align(delimiters)), delimiters, strict=True)
    assert [r.error for r in aligned.collect()] == [None, None]
    with pytest.raises(Exception, match="differ in length: projects 2, imp 1, ids 2"):
        quality.validate_projects(config.limit(2), delimiters, strict=True).collect()


def test_ids_of_lines_and_logs(spark):
    lines = spark.createDataFrame([(f"x,{A.upper()}\t,y",), (f"x,{A}",), (f"x,{U}",), ("x,short",), ("no delimiter in this line",)], "value string")
    assert rows(audience.ids_of_lines(lines, ",", 1)) == sorted([(A, "0"), (U, "1")])
    uids = spark.createDataFrame([("Ab",), (" ab",), (None,), ("  ",), ("a-b",)], "uid string")
    assert rows(audience.audience_ids(uids)) == [("a-b", "1"), ("ab", "0")]


def test_explode_results(spark):
    schema = "deviceId string, deviceType string, results array<struct<dealid:string,resultCode:string>>, timestamp bigint"
    nested = spark.createDataFrame(
        [("d1", "0", [("x", "1005"), ("y", "1005"), ("x", "1006")], 1), ("d1", "0", [("x", "1005")], 2), ("d2", "1", [], 3), ("d3", "1", None, 4)],
        schema,
    )
    found = audience.explode_results(nested, "x", "1005")
    assert rows(found) == [("d1", "0", "x", "1005", 1), ("d1", "0", "x", "1005", 2)]
    assert rows(audience.audience_from_results(found)) == [("d1", "0")]
    assert audience.explode_results(nested).count() == 4


def test_scan_details(spark, cells):
    table = cells((f"{A}:x", "kd_1", 1000), (f"{A}:x", "kd_1", 3000), (f"{A}:x", "kdx", 2000), (f"{A}:x", "td_1", 5000))
    updates = scan.vendor_updates(table).collect()
    assert [(r.tag, r.timeStamp) for r in updates] == [("kd_1", 3000), ("kdx", 2000)]
    assert rows(scan.time_range_updates(table, 2000, 5000).select("tag")) == [("kd_1",), ("kdx",)]
    assert rows(export.last_update(cells((f"{A}:x", "kd_1", 1), (f"{A}:x", "td_1", 7)))) == [(A, 7)]
    assert scan.preview(spark.range(100)).count() == 20
    assert 0 < scan.sample_rows(spark.range(10_000), 0.1, ["id"], 1).count() < 2000

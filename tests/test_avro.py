"""The Avro source against the Avro library of the JVM, which Spark ships without its own source."""

import json
from pathlib import Path

import pytest

from tagloom.schema import LOGS
from tagloom.sources import avro, logs

from .conftest import rows

RECORD = {
    "type": "record", "name": "Log", "namespace": "x.y",
    "fields": [
        {"name": "uid", "type": ["null", "string"]},
        {"name": "extra", "type": {"type": "map", "values": "long"}},
        {"name": "cid", "type": "int"},
        {"name": "kind", "type": {"type": "enum", "name": "Kind", "symbols": ["IMP", "CLK"]}},
        {"name": "sum", "type": {"type": "fixed", "name": "Sum", "size": 4}},
        {"name": "prices", "type": {"type": "array", "items": ["double", "null"]}},
        {"name": "near", "type": {"type": "record", "name": "Near", "fields": [
            {"name": "ok", "type": "boolean"}, {"name": "raw", "type": "bytes"}, {"name": "other", "type": "Kind"}]}},
        {"name": "up", "type": ["null", "Log"]},
        {"name": "creative_id", "type": {"type": "long", "logicalType": "timestamp-millis"}},
    ],
}


def sample(i):
    """A record as Avro's JSON."""
    return {
        "uid": {"string": f"ü-{i}"} if i % 3 else None, "extra": {f"k{j}": j - (1 << 40) for j in range(i % 4)}, "cid": i - 50,
        "kind": "CLK" if i % 2 else "IMP", "sum": "abcd", "prices": [{"double": i / 4}, None][: i % 3],
        "near": {"ok": i % 2 == 0, "raw": "\u0001ÿ", "other": "IMP"}, "up": {"x.y.Log": sample(i - 1)} if i % 5 == 1 else None,
        "creative_id": i * (1 << 33),
    }


def jvm_write(spark, path, records, schema=RECORD, codec="deflate"):
    """A file written by the library, in small blocks."""
    api = spark._jvm.org.apache.avro
    parsed = getattr(api, "Schema$Parser")().parse(json.dumps(schema))
    read, write = api.generic.GenericDatumReader(parsed), api.generic.GenericDatumWriter(parsed)
    path.parent.mkdir(parents=True, exist_ok=True)
    out = api.file.DataFileWriter(write).setCodec(api.file.CodecFactory.fromString(codec)).setSyncInterval(200)
    out = out.create(parsed, spark._jvm.java.io.File(str(path)))
    for r in records:
        out.append(read.read(None, api.io.DecoderFactory.get().jsonDecoder(parsed, json.dumps(r))))
    out.close()


def load(spark, path, schema, **options):
    return spark.read.format(avro.register(spark)).schema(schema).options(**options).load(str(path))


ALL = "creative_id long, uid string, kind string, sum binary, prices array<double>, near struct<ok:boolean,raw:binary,other:string>, extra map<string,long>, cid int, none string"


@pytest.mark.parametrize("codec", ["null", "deflate", "snappy", "bzip2", "xz"])
@pytest.mark.parametrize("split", [150, 1 << 20])
def test_files_of_the_library(spark, tmp_path, codec, split):
    jvm_write(spark, tmp_path / "a.avro", [sample(i) for i in range(200)], codec=codec)
    jvm_write(spark, tmp_path / "none.avro", [], codec=codec)
    got = sorted(load(spark, tmp_path, ALL, splitBytes=str(split)).collect(), key=lambda r: r.creative_id)
    assert [r.cid for r in got] == [i - 50 for i in range(200)]
    for i, r in enumerate(got):
        want = sample(i)
        assert r.creative_id == want["creative_id"] and r.uid == (f"ü-{i}" if i % 3 else None) and r.kind == want["kind"]
        assert r.extra == want["extra"] and r.prices == [i / 4, None][: i % 3] and r.none is None
        assert r["sum"] == b"abcd" and tuple(r.near) == (i % 2 == 0, b"\x01\xff", "IMP")


def test_only_asked_columns(spark, tmp_path):
    jvm_write(spark, tmp_path / "a.avro", [sample(i) for i in range(7)])
    df = load(spark, tmp_path, "cid int")
    assert df.columns == ["cid"] and sorted(r.cid for r in df.collect()) == [i - 50 for i in range(7)]


def test_library_reads_what_is_written(spark, tmp_path):
    schema = "day string, a int, b long, c double, d string, e boolean, f array<int>, g struct<x:int,y:string>, h map<string,long>, i binary, j float"
    data = [
        ("2024 01/01", 1, -(1 << 62), 0.5, "é", True, [1, None, 3], (5, None), {"k": 7}, b"\x00\xff", 0.25),
        (None, None, None, None, None, None, None, None, None, None, None),
        ("x", -1, (1 << 63) - 1, -0.0, "", False, [], (None, "y"), {}, b"", -1.5),
    ]
    df = spark.createDataFrame(data * 40, schema)
    df.repartition(3).write.format(avro.register(spark)).mode("append").save(str(tmp_path / "out"))
    files = sorted((tmp_path / "out").rglob("*.avro"))
    assert not list((tmp_path / "out").glob("_*")) and {p.parent.name for p in files} == {
        "day=2024%2001%2F01", "day=__HIVE_DEFAULT_PARTITION__", "day=x"
    }
    api, seen = spark._jvm.org.apache.avro, []
    for f in files:
        reader = api.file.DataFileReader(spark._jvm.java.io.File(str(f)), api.generic.GenericDatumReader())
        while reader.hasNext():
            seen.append(json.loads(str(reader.next())))
    assert len(seen) == 120
    first = next(r for r in seen if r["a"] == 1)
    assert first["b"] == -(1 << 62) and first["d"] == "é" and first["f"] == [1, None, 3] and first["g"] == {"x": 5, "y": None}
    back = load(spark, tmp_path / "out", schema)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_days_are_pruned(spark, tmp_path):
    """Files of days out of the range are not opened, and no task is made for them."""
    for day in (1, 2, 3, 4):
        jvm_write(spark, tmp_path / "imp" / f"day=2024010{day}" / "a.avro", [sample(i) for i in range(day)])
    for day in (1, 4):
        (tmp_path / "imp" / f"day=2024010{day}" / "broken.avro").write_bytes(b"no Avro")
    (tmp_path / "imp" / "day=20240102" / "_SUCCESS").write_bytes(b"")
    paths = {"imp": str(tmp_path / "imp")}
    got = logs.read_day_logs(spark, paths, "20240102", "20240103", fmt="avro")
    assert got.columns == [*LOGS.fieldNames(), "kind"] and rows(got.select("day", "kind").distinct()) == [("20240102", "imp"), ("20240103", "imp")]
    assert got.count() == 5
    options = {"path": str(tmp_path / "imp"), "start": "20240102", "end": "20240103"}
    found = avro.AvroReader(LOGS, options).partitions()
    assert sorted(Path(p.path).parent.name for p in found) == ["day=20240102", "day=20240103"]
    with pytest.raises(Exception, match="not an Avro file"):
        logs.read_day_logs(spark, paths, fmt="avro").count()


def test_day_logs_round_trip(spark, tmp_path):
    schema = "kind string, uid string, cid long, creative_id long, day string"
    data = [(k, f" U{i}", i, None if i % 2 else i, f"2024010{i % 4}") for i in range(60) for k in ("imp", "clk")]
    table = spark.createDataFrame(data, schema)
    paths = {k: f"{tmp_path}/{k}" for k in ("imp", "clk")}
    logs.write_day_logs(table, paths, fmt="avro")
    assert sorted(map(repr, logs.read_day_logs(spark, paths, fmt="avro").select(*table.columns).collect())) == sorted(map(repr, table.collect()))
    days = logs.read_day_logs(spark, paths, "20240101", "20240102", fmt="avro")
    assert {r.day for r in days.collect()} == {"20240101", "20240102"} and days.count() == 60


def test_a_task_that_dies_leaves_nothing_to_read(spark, tmp_path):
    """Tasks that end after the write was given up may leave files, but only in a folder that is not read."""
    from pyspark.sql import functions as F

    bad = spark.range(100, numPartitions=4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("died"))).otherwise("a").alias("day"), "id")
    with pytest.raises(Exception, match="died"):
        bad.write.format(avro.register(spark)).mode("append").save(str(tmp_path / "out"))
    seen = [f.relative_to(tmp_path / "out").parts[0] for f in (tmp_path / "out").rglob("*.avro")]
    assert all(part.startswith("_staging-") for part in seen)

import pytest

from tagloom.operators import aggregate, export, lookup, mutate
from tagloom.plans import jobs
from tagloom.session import settle, work_dir
from tagloom.sources import files, logs, sinks

from .conftest import rows

A = "a" * 32
U = "abcdef01-2345-6789-abcd-ef0123456789"


def write_file(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f"{line}\n" for line in lines))


def test_audit_lines_agree_with_and_without_check(cells):
    table = cells((f"{A}:didmd5", "kd_1"), (f"{A}:didmd5", "bad_x"), ("dirty", "kd_1"), ("dirty", "kd_2"))
    clean = '{"did":"%s:didmd5","tags":"0171","os":0}' % A
    assert rows(jobs.audit_lines(table)) == [(clean, "clean")]
    assert rows(jobs.audit_lines(table, check=True)) == sorted(
        [(clean, "clean"), (f"{A},bad_x", "dirty_columns"), ("dirty", "dirty_rowkeys")]
    )


@pytest.mark.parametrize("folder", ["plain", "v1.2", "brand/v1.2", "a b"])
def test_audience_job(spark, cells, tmp_path, folder):
    tmp_path = tmp_path / folder
    table = cells((f"{A}:didmd5", "kd_7"), (f"{U}:ifa", "td_7"), (f"{'b' * 32}:didmd5", "kd_8"))
    write_file(tmp_path / "in" / "and" / "one.csv", A.upper(), A, "b" * 32)
    write_file(tmp_path / "in" / "ios" / "deep" / "two.part.csv", U, A)
    write_file(tmp_path / "tags.txt", "7,9,,", "8")
    out = str(tmp_path / "out")
    paths = {"ids_path": f"{tmp_path}/in", "tags_path": f"{tmp_path}/tags.txt"}
    assert jobs.audit_job(spark, table, out, "audience", **paths) == {"records": 3}
    got = spark.read.schema("value string, output string").text(out)
    one, two = "and/one_proceed.csv", "ios/deep/two_proceed.csv"
    assert rows(got) == sorted([(A, one), (A.upper(), one), (U, two)])
    write_file(tmp_path / "none.txt", ",")
    with pytest.raises(ValueError, match="empty"):
        jobs.audit_job(spark, table, out, "audience", **{**paths, "tags_path": f"{tmp_path}/none.txt"})


def test_filter_tags_come_from_one_file(spark, tmp_path):
    write_file(tmp_path / "tags" / "a.txt", "1")
    write_file(tmp_path / "tags" / "b.txt", "2")
    with pytest.raises(ValueError, match="one file"):
        files.read_filter_tags(spark, f"{tmp_path}/tags")


def test_long_tag_list_is_not_broadcast(spark, cells, tmp_path):
    write_file(tmp_path / "tags.txt", ",".join(f"t{i * 7919}" for i in range(200_000)))
    tags = settle(files.read_filter_tags(spark, f"{tmp_path}/tags.txt").distinct(), "filter-tags")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        table = cells((f"{A}:didmd5", "kd_t7919"))
        hits = lookup.keys_with_tags(table, tags)
        assert "SortMergeJoin" in hits._jdf.queryExecution().executedPlan().toString()
        assert rows(hits) == [(f"{A}:didmd5",)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_job_runs_while_a_plan_is_built(spark, cells):
    table = cells((f"{A}:didmd5", "kd_1"), (f"{U}:ifa", "td_2"))
    keys = spark.createDataFrame([(f"{A}:didmd5",)], "row_key string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "plans")
    try:
        export.clean_export(table), export.export_array(table), export.tags_as_string(table)
        lookup.lookup_vendor_tags(table, keys), aggregate.tag_to_devices(table, 3), jobs.audit_lines(table, check=True)
        assert list(tracker.getJobIdsForGroup("plans")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_first_line_of_a_file_in_many_blocks(spark, tmp_path):
    write_file(tmp_path / "tags.txt", "a,b", *["z" * 50] * 2000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert rows(files.read_filter_tags(spark, f"{tmp_path}/tags.txt")) == [("a",), ("b",)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_audit_modes(spark, cells, tmp_path):
    table = cells((f"{A}:didmd5", "kd_1", 5))
    jobs.audit_job(spark, table, f"{tmp_path}/t", "timestamp")
    assert rows(spark.read.text(f"{tmp_path}/t")) == [(f"{A},5",)]
    jobs.audit_job(spark, table, f"{tmp_path}/p", "prefix", prefix="kd")
    assert rows(spark.read.text(f"{tmp_path}/p")) == [(A,)]
    log = f"{tmp_path}/log"
    mutate.upsert_cells(mutate.puts_of(table), log)
    write_file(tmp_path / "keys.txt", f"{A}:didmd5")
    jobs.audit_job(spark, table, "", "delete", log=log, keys_path=f"{tmp_path}/keys.txt", at_ms=9)
    assert mutate.current_state(mutate.read_log(spark, log)).count() == 0
    with pytest.raises(ValueError):
        jobs.audit_job(spark, table, "", "other")
    mixed = cells((f"{A}:didmd5", "kd_1"), (f"{A}:didmd5", "bad_x"), ("dirty", "kd_1"))
    totals = jobs.audit_job(spark, mixed, f"{tmp_path}/c", "clean", check=True)
    assert totals == {"clean": 1, "dirty_rowkeys": 1, "dirty_columns": 1}
    assert jobs.audit_job(spark, table, f"{tmp_path}/j", "json") == {"records": 1}


def test_export_job_modes(spark, cells, tmp_path):
    table = cells((f"{A}:didmd5", "kd_1"), (f"{A}:didmd5", "td_2"))
    written = jobs.export_job(table, str(tmp_path / "a"), ["string", "array"])
    assert rows(spark.read.parquet(written["string"])) == [(A, "1,2")]
    assert rows(spark.read.parquet(written["array"])) == [(A, ["1", "2"])]
    assert set(jobs.export_job(table, str(tmp_path / "b"), ["string"])) == {"string"}
    assert set(jobs.export_job(table, str(tmp_path / "c"), ["update", "array"])) == {"update"}
    with pytest.raises(ValueError):
        jobs.export_job(table, str(tmp_path / "d"), ["csv"])


def test_import_job(spark, tmp_path):
    # the rows are read once: each leaves a mark when it passes
    passed = spark.sparkContext.accumulator(0)

    def mark(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    schema = "d string, o string"
    devices = spark.createDataFrame([("AB", "0"), ("C-D", "1"), ("ef", None), ("gh", "7")], schema).mapInArrow(mark, schema)
    counts = jobs.import_job(devices, f"{tmp_path}/log", 5, tag="9", did="d", os="o")
    assert counts == {"total": 4, "os_0": 1, "os_1": 1, "os_other": 2} and passed.value == 4
    lists = spark.createDataFrame([("ab:didmd5", "x,y"), ("k", "")], "did string, tags string")
    assert jobs.import_job(lists, f"{tmp_path}/log", 6) == {"total": 2}
    state = rows(mutate.current_state(mutate.read_log(spark, f"{tmp_path}/log")).select("row_key", "qualifier"))
    assert ("ab:didmd5", "x") in state and ("ab:didmd5", "ap_9") in state and ("c-d:ifa", "ap_9") in state


def test_ingest_and_save(spark, tmp_path):
    write_file(tmp_path / "ids.txt", f"x,{A.upper()}\t", f"y,{A}", f"z,{U}", "short")
    ids = jobs.ingest_id_file(spark, f"{tmp_path}/ids.txt", ",", 1)
    counts = jobs.save_audience(ids, 5, "9", path=f"{tmp_path}/out", log=f"{tmp_path}/log", files=2)
    assert counts == {"total": 2, "os_0": 1, "os_1": 1}
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == [(A, "0"), (U, "1")]
    state = mutate.current_state(mutate.read_log(spark, f"{tmp_path}/log"))
    assert rows(state.select("row_key", "qualifier")) == [(f"{A}:didmd5", "ap_9"), (f"{U}:ifa", "ap_9")]


def test_day_logs_are_pruned(spark, tmp_path):
    data = [("imp", f"202401{d:02d}", "u", 1, 2) for d in range(1, 10)] + [("clk", "20240103", "c", 1, 2)]
    table = spark.createDataFrame(data, "kind string, day string, uid string, cid bigint, creative_id bigint")
    paths = {"imp": f"{tmp_path}/imp", "clk": f"{tmp_path}/clk"}
    logs.write_day_logs(table, paths)
    some = logs.read_day_logs(spark, paths, "20240102", "20240103")
    assert rows(some.select("kind", "day")) == [("clk", "20240103"), ("imp", "20240102"), ("imp", "20240103")]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert logs.read_day_logs(spark, paths).count() == 10


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", 2)], "x string, y int")
    assert sinks.write_delimited_text(df, f"{tmp_path}/t", ";") == "x;y"
    assert rows(spark.read.text(f"{tmp_path}/t")) == [("a;null",), ("b;2",)]
    with pytest.raises(Exception, match="exists"):
        sinks.write_delimited_text(df, f"{tmp_path}/t", ";", mode="errorifexists")
    uids = spark.range(1000).selectExpr(
        "if(id % 3 = 0, null, cast(id as string)) uid", "'imp' kind", "'p' project", "'20240101' day"
    )
    sinks.write_uid_text(uids, f"{tmp_path}/u", files=5)
    assert files.read_glob_union(spark, f"{tmp_path}/u", ["imp", "clk"], ["p"]).count() == 666
    sinks.write_parquet_compact(spark.range(100).toDF("id"), f"{tmp_path}/c", files=3)
    assert len(list((tmp_path / "c").glob("*.parquet"))) == 3


def test_work_dir_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    got = work_dir(spark, "x")
    assert got != work_dir(spark, "x")
    if base:
        assert got.startswith(base)


def test_extract_job(spark, tmp_path):
    from tagloom.operators.audience import Project

    table = spark.createDataFrame(
        [("imp", "20240101", "u", 1, 2), ("clk", "20240101", None, 1, 2)],
        "kind string, day string, uid string, cid bigint, creative_id bigint",
    )
    p = Project("p", True, True, 0, ("1",), "20240101", "20240102")
    header = jobs.extract_job(table, [p, p], f"{tmp_path}/t", fmt="text", delimiter=";")
    assert header == table.columns
    got = spark.read.schema("value string, campaign string, log_kind string, log_day string").text(f"{tmp_path}/t")
    line = {"clk": "clk;20240101;null;1;2", "imp": "imp;20240101;u;1;2"}
    assert rows(got) == [(line[k], "p", k, "20240101") for k in ("clk", "clk", "imp", "imp")]
    jobs.extract_job(table, [p], f"{tmp_path}/d", ["uid", "day", "kind"])
    assert spark.read.parquet(f"{tmp_path}/d").count() == 2
    with pytest.raises(ValueError, match="names of their own"):
        jobs.extract_job(table, [p], f"{tmp_path}/e", ["uid as campaign"])
    with pytest.raises(ValueError):
        jobs.extract_job(table, [p], f"{tmp_path}/x", fmt="csv")

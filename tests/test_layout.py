"""What the scans of lookups, time ranges and audiences read, by plan and by measured rows and files."""

import pytest
from pyspark.sql import functions as F

from tagloom.operators import audience, buckets, lookup, mutate, scan
from tagloom.operators.audience import Project, campaign_filter
from tagloom.sources import cells as cell_source
from tagloom.sources import logs

from .conftest import rows


def scans(df):
    """Rows and files of each scan of the finished plan."""
    df.collect()
    out = []

    def walk(node):
        if node.nodeName().startswith("Scan parquet"):
            m = node.metrics()
            out.append({k: m.apply(k).value() for k in ("numOutputRows", "numFiles")})
        if "QueryStage" in node.nodeName():
            walk(node.plan())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    walk(plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)
    return out


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def key(n):
    return F.md5(n.cast("string"))


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """60,000 cells of 6,000 keys in order of qualifiers: every file has keys of the whole range."""
    n = F.col("id")
    base = spark.range(60_000).select(
        key(n % 6000).alias("row_key"), F.lit("cf").alias("family"), F.concat(F.lit("kd_"), n % 50).alias("qualifier"),
        (n % 1000).alias("ts"), F.lit("1").alias("value"),
    )
    path = str(tmp_path_factory.mktemp("cells"))
    cell_source.write_cells(base, path, ("qualifier", "row_key", "ts"))
    return base, cell_source.scan_cells(spark, path)


@pytest.fixture
def merge_joins(spark):
    """No broadcasts, and bloom filters for tables of any size."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1k",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_key_that_is_not_there_reads_no_row_group(spark, table, tmp_path):
    base, cells = table
    absent = F.md5(F.lit("nobody"))
    assert scans(cells.where(F.col("row_key") == absent))[0]["numOutputRows"] == 0
    # not so without the filters of the layout
    plain = str(tmp_path / "plain")
    order = ("qualifier", "row_key", "ts")
    base.repartitionByRange(*order).sortWithinPartitions(*order).write.option("parquet.enable.dictionary", "false").parquet(plain)
    assert scans(cell_source.scan_cells(spark, plain).where(F.col("row_key") == absent))[0]["numOutputRows"] > 0
    filtered = str(tmp_path / "filtered")
    writer = base.repartitionByRange(*order).sortWithinPartitions(*order).write.options(**cell_source.KEY_FILTER)
    writer.option("parquet.enable.dictionary", "false").parquet(filtered)
    assert scans(cell_source.scan_cells(spark, filtered).where(F.col("row_key") == absent))[0]["numOutputRows"] == 0


def test_held_keys_reach_the_scan(spark, table):
    base, cells = table
    held = [r[0] for r in spark.range(3).select(key(F.col("id"))).collect()]
    got = lookup.get_rows_of(cells, held)
    assert rows(got) == rows(lookup.get_rows(base, spark.createDataFrame([(k,) for k in held], "row_key string")))
    assert 0 < scans(got)[0]["numOutputRows"] < 60_000
    nobody = [f"nobody-{i}" for i in range(40)]  # more than Spark turns into equalities by itself
    assert rows(lookup.get_rows_of(cells, nobody)) == [] and scans(lookup.get_rows_of(cells, nobody))[0]["numOutputRows"] == 0
    assert lookup.get_rows_of(cells, []).count() == 0
    many = [*held, *[f"nobody-{i}" for i in range(2000)]]
    assert rows(lookup.get_rows_of(cells, many)) == rows(got)
    assert rows(lookup.vendor_tags_of(cells, held)) == rows(
        lookup.lookup_vendor_tags(cells, spark.createDataFrame([(k,) for k in held], "row_key string"))
    )


def test_frames_of_keys_filter_the_scan(spark, table, merge_joins, tmp_path):
    """Their bloom filter stands right above the scan, so that few cells are shuffled."""
    base, cells = table
    path = str(tmp_path / "asked")
    spark.range(40).select(key(F.col("id")).alias("row_key")).write.parquet(path)
    asked = spark.read.schema("row_key string").parquet(path)
    for got in (lookup.get_rows(cells, asked), lookup.lookup_vendor_tags(cells, asked)):
        assert "might_contain" in optimized(got)
        got.collect()
    got = lookup.get_rows(cells, asked)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().executedPlan().toString()
    assert "might_contain" in plan
    want = base.join(asked, "row_key", "left_semi").select("row_key", "family", "qualifier", "ts", "value")
    assert [r[:5] for r in rows(got)] == rows(cell_source.latest_cells(want, value=True))


def test_lookups_in_a_bucketed_table_read_few_folders(spark, table, tmp_path):
    base, _ = table
    b = buckets.Buckets(str(tmp_path / "table"), 32)
    buckets.fold_batch(spark, b, mutate.puts_of(base), 0, str(tmp_path / "staging"))
    assert scans(buckets.read_log(spark, b))[0]["numFiles"] >= 32
    held = [r[0] for r in spark.range(2).select(key(F.col("id"))).collect()]
    got = buckets.rows_of_keys(spark, b, held)
    want = rows(cell_source.latest_cells(base.where(F.col("row_key").isin(*held)), value=True))
    assert rows(mutate.current_state(got)) == want and scans(got)[0]["numFiles"] <= 2
    path = str(tmp_path / "asked")
    spark.createDataFrame([(k,) for k in held], "row_key string").write.parquet(path)
    asked = spark.read.schema("row_key string").parquet(path)
    frame = buckets.rows_of(spark, b, asked)
    assert "dynamicpruning" in optimized(frame)
    assert rows(mutate.current_state(frame)) == want
    assert min(s["numFiles"] for s in scans(frame) if s["numFiles"]) <= 2
    assert buckets.rows_of_keys(spark, b, []).count() == 0


def test_lower_bound_of_a_time_range_reaches_the_scan(spark, tmp_path, cells):
    n = F.col("id")
    base = spark.range(200_000).select(
        key(n % 500).alias("row_key"), F.lit("cf").alias("family"), F.lit("kd_1").alias("qualifier"), n.alias("ts"), F.lit("1").alias("value")
    )
    path = str(tmp_path / "by_time")
    cell_source.write_cells(base, path, ("ts", "row_key", "qualifier"))
    got = scan.time_range_updates(cell_source.scan_cells(spark, path), 199_000, 199_800)
    pushed = got._jdf.queryExecution().executedPlan().toString().split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(ts,199000)" in pushed and "LessThan(ts" not in pushed
    assert scans(got)[0]["numOutputRows"] < 50_000
    newest = cell_source.latest_cells(base, ts=True).where("ts >= 199000 and ts < 199800")
    assert got.count() == newest.count() == 300
    # a cell with versions before, in and after the range counts by its newest alone
    odd = cells(("a:x", "kd_1", 5), ("a:x", "kd_1", 15), ("b:x", "kd_1", 15), ("b:x", "kd_1", 25), ("c:x", "kd_1", 5), ("d:x", "kd_1", 10), ("e:x", "kd_1", 20))
    assert rows(scan.time_range_updates(odd, 10, 20)) == [("a:x", "kd_1", 15), ("d:x", "kd_1", 10)]


def test_many_ids_still_filter_the_scan(spark, merge_joins, tmp_path):
    """A hundred thousand ids: too many for literals, so their bloom filter goes to the scan."""
    n = F.col("id")
    table = spark.range(40_000).select(
        F.when(n % 2 == 0, "imp").otherwise("clk").alias("kind"), F.concat(F.lit("u"), n).alias("uid"),
        (n * 37).alias("cid"), (n % 9).alias("creative_id"), F.concat(F.lit("2024010"), n % 4 + 1).alias("day"),
    )
    paths = {k: str(tmp_path / k) for k in ("imp", "clk")}
    logs.write_day_logs(table, paths)
    stored = logs.read_day_logs(spark, paths)
    ids = tuple(str(i) for i in range(100_000))
    projects = [Project("p", True, False, 0, ids, "20240101", "20240102"), Project("q", True, True, 1, ("3",), "20240102", "20240103")]
    got = campaign_filter(stored, projects)
    assert "might_contain" in optimized(got)
    held = {p.name: set(p.ids) for p in projects}
    want = sorted(
        (slot, p.name, *r)
        for r in map(tuple, stored.collect())
        for slot, p in enumerate(projects)
        for x in [dict(zip(stored.columns, r, strict=True))]
        if x["kind"] in p.kinds and p.start <= x["day"] <= p.end and str(x[p.id_column]) in held[p.name]
    )
    assert rows(got) == want and len(want) > 100
    assert audience.FILTER_IDS < len(ids)


def test_newest_values_without_a_sort(spark, cells):
    """Ties, null values and old versions come out as by the general fold, from hash aggregates alone."""
    data = [(f"k{i % 7}:x", f"kd_{i % 5}", -(i % 11), [None, "", "b", "ba", "é", "1"][i % 6]) for i in range(500)]
    table = spark.createDataFrame([(k, "cf", q, ts, v) for k, q, ts, v in data], "row_key string, family string, qualifier string, ts bigint, value string")
    want = sorted(map(repr, cell_source.latest_cells(table, value=True).collect()))
    got = cell_source.latest_by_number(table)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert sorted(map(repr, got.collect())) == want
    # what does not fit takes the general fold
    assert sorted(map(repr, cell_source.latest_by_number(table, most_values=5).collect())) == want
    far = table.unionByName(cells(("a:x", "kd_1", 1 << 62), ("a:x", "kd_1", -(1 << 62))))
    timeless = table.unionByName(table.limit(9).withColumn("ts", F.lit(None).cast("bigint")))
    for odd in (far, timeless, table.limit(0)):
        assert sorted(map(repr, cell_source.latest_by_number(odd).collect())) == sorted(map(repr, cell_source.latest_cells(odd, value=True).collect()))
    # numbered once, folded in parts; what was not numbered is not lost silently
    numbers = cell_source.number_values(table)
    part = table.where("row_key < 'k3'")
    assert sorted(map(repr, cell_source.latest_by_number(part, numbers).collect())) == sorted(map(repr, cell_source.latest_cells(part, value=True).collect()))
    for stranger in (("a:x", "kd_1", 0, "new"), ("a:x", "kd_1", 99, "1")):
        with pytest.raises(Exception, match="not numbered"):
            cell_source.latest_by_number(table.unionByName(cells(stranger)), numbers).collect()

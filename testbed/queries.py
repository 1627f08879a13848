"""Every query with its SQL twin; both run over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagloom.functions import keys, qualifiers, text
from tagloom.operators import aggregate, audience, buckets, export, lookup, mutate, postings, quality, scan
from tagloom.plans import jobs
from tagloom.schema import NESTED, RETARGET
from tagloom.session import listed, work_dir
from tagloom.sources import cells as cell_source
from tagloom.sources import files, sinks
from tagloom.sources import logs as log_source

from . import oracle as o
from .tables import PROJECTS, Tables, device_id

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}

# Fixed times for puts and deletes, in epoch milliseconds: inside and after the events.
MIDWAY = 1705276800000
LATER = 1706745600000
FILTER_TAGS = ["001001", "012001"]
TAG = "023019"


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# ---------------------------------------------------------------- sources


@query("scan_cells", o.sql("select * from cells", o.CELLS))
def _(t: Tables):
    return t.cells()


@query("latest_cells", o.sql("select * from latest", o.CELLS, o.LATEST))
def _(t: Tables):
    return cell_source.latest_cells(t.cells(), value=True)


@query("latest_by_number", SQL["latest_cells"])
def _(t: Tables):
    return cell_source.latest_by_number(t.cells())


@query("read_parquet_ids", o.sql("select did, os from retarget", o.LINES, o.RETARGET))
def _(t: Tables):
    path = work_dir(t.spark, "ids")
    t.retarget().write.parquet(path)
    return files.read_parquet_ids(t.spark, path, RETARGET)


@query("read_json_ids", o.sql("select * from results", o.RESULTS))
def _(t: Tables):
    path = work_dir(t.spark, "nested")
    sinks.write_json_lines(t.nested(), path)
    return audience.explode_results(files.read_json_ids(t.spark, path, NESTED))


@query(
    "read_day_logs",
    o.sql("select * from logs where day between '20240105' and '20240110'", o.LOGS),
)
def _(t: Tables):
    base = work_dir(t.spark, "logs")
    paths = {kind: f"{base}/{kind}" for kind in audience.KINDS}
    log_source.write_day_logs(t.derived_logs(), paths)
    return log_source.read_day_logs(t.spark, paths, "20240105", "20240110")


@query("read_day_logs_avro", SQL["read_day_logs"])
def _(t: Tables):
    base = work_dir(t.spark, "logs")
    paths = {kind: f"{base}/{kind}" for kind in audience.KINDS}
    log_source.write_day_logs(t.derived_logs(), paths, fmt="avro")
    return log_source.read_day_logs(t.spark, paths, "20240105", "20240110", fmt="avro")


@query("read_id_lines", o.sql("select value from lines", o.LINES))
def _(t: Tables):
    path = work_dir(t.spark, "lines")
    sinks.write_lines(t.lines(), path)
    return files.read_id_lines(t.spark, path)


@query("read_glob_union", o.sql("select uid as value from campaign", o.LOGS, o.CAMPAIGN))
def _(t: Tables):
    path = work_dir(t.spark, "uids")
    sinks.write_uid_text(audience.campaign_filter(t.logs(), PROJECTS), path)
    lines = files.read_glob_union(t.spark, path, list(audience.KINDS), [p.name for p in PROJECTS])
    return lines.select("value")


def _id_folders(t: Tables, name: str, one_name: bool = False) -> str:
    """Id lines in one folder per platform, ``and`` or ``ios``; with ``one_name``, in equally named files."""
    path = work_dir(t.spark, name)
    hyphen = F.contains("id", F.lit("-"))
    ids = t.ids().select(F.col("id").alias("value"), F.when(hyphen, "ios").otherwise("and").alias("os"))
    if one_name:
        for os in ("and", "ios"):
            written = f"{path}-parts/{os}"
            ids.where(F.col("os") == os).select("value").coalesce(1).write.text(written)
            _rename_part(t, written, f"{path}/os={os}/ids.csv")
        return path
    sinks.write_lines(ids, path, partition_by=("os",))
    return path


def _rename_part(t: Tables, folder: str, to: str) -> None:
    """Give the one file of a folder a name of its own."""
    jvm = t.spark.sparkContext._jvm.org.apache.hadoop.fs
    source, target = jvm.Path(f"{folder}/part-*"), jvm.Path(to)
    store = target.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(target.getParent())
    store.rename(store.globStatus(source)[0].getPath(), target)


@query(
    "read_dir_recursive",
    o.sql("select id as value, case when contains(id,'-') then 'ifa' else 'didmd5' end as kind from ids", o.IDS),
)
def _(t: Tables):
    lines = files.read_dir_recursive(t.spark, _id_folders(t, "folders"))
    return lines.select("value", keys.kind_from_path(F.substring_index("path", "/", -2)).alias("kind"))


_TOP = "(select tag, count(distinct rowkey) as cnt from flat group by tag order by cnt desc, tag limit 200)"


def _tag_file(t: Tables) -> str:
    """All tags as a comma list in the first line of a file."""
    path = work_dir(t.spark, "tags")
    line = scan.flat_tags(t.cells()).select("tag").distinct().agg(F.array_join(F.sort_array(F.collect_list("tag")), ",").alias("value"))
    line.unionAll(t.spark.createDataFrame([("a second line, not read",)], "value string")).coalesce(1).write.text(path)
    return path


@query("read_filter_tags", o.sql("select distinct tag from flat", o.CELLS, o.LATEST, o.FLAT))
def _(t: Tables):
    return files.read_filter_tags(t.spark, _tag_file(t))


# ---------------------------------------------------------------- sinks


@query("upsert_cells", o.sql("select * from latest", o.CELLS, o.LATEST))
def _(t: Tables):
    path = work_dir(t.spark, "log")
    for _ in range(2):
        mutate.upsert_cells(mutate.puts_of(t.cells()), path)
    return mutate.current_state(mutate.read_log(t.spark, path))


@query("write_parquet_compact", o.sql("select did, os from retarget", o.LINES, o.RETARGET))
def _(t: Tables):
    path = work_dir(t.spark, "compact")
    sinks.write_parquet_compact(t.retarget(), path, files=4)
    return t.spark.read.schema(RETARGET).parquet(path)


@query(
    "write_delimited_text",
    o.sql(
        "select kind||'|'||day||'|'||uid||'|'||cid||'|'||"
        "coalesce(cast(nullif(creative_id,103) as varchar),'null') as value from logs",
        o.LOGS,
    ),
)
def _(t: Tables):
    path = work_dir(t.spark, "delimited")
    rows = t.logs().select("kind", "day", "uid", "cid", F.nullif("creative_id", F.lit(103)).alias("creative_id"))
    sinks.write_delimited_text(rows, path, "|", files=10)
    return t.spark.read.text(path)


@query("write_uid_text", o.sql("select kind, project, day, uid as value from campaign", o.LOGS, o.CAMPAIGN))
def _(t: Tables):
    path = work_dir(t.spark, "uids")
    sinks.write_uid_text(audience.campaign_filter(t.logs(), PROJECTS), path)
    return t.spark.read.schema("value string, kind string, project string, day string").text(path)


_CLEAN = f"""select {o.shown("prefix")}||case when contains(prefix,'-') then ':ifa' else ':didmd5' end as did,
 coalesce(string_agg({o.recode("qualifier")}, ',' order by qualifier) filter (where {o.exportable("qualifier")}),'') as tags,
 case when contains(prefix,'-') then 1 else 0 end as os
 from (select distinct row_key, qualifier, split_part(row_key,':',1) as prefix from cells where {o.strict("row_key")})
 group by row_key, prefix"""


@query("write_json_lines", o.sql(_CLEAN, o.CELLS))
def _(t: Tables):
    path = work_dir(t.spark, "json")
    sinks.write_json_lines(export.clean_export(t.cells()), path)
    return t.spark.read.schema("did string, tags string, os int").json(path)


_LAST = f"""select split_part(row_key,':',1) as rowkey, max(ts) as "maxTimestamp" from cells
 where {o.loose("row_key")} group by row_key"""


@query("write_csv_pairs", o.sql(f"select rowkey||','||\"maxTimestamp\" as value from ({_LAST})", o.CELLS))
def _(t: Tables):
    path = work_dir(t.spark, "pairs")
    sinks.write_csv_pairs(export.last_update(t.cells()), path)
    return t.spark.read.text(path)


@query(
    "table_lifecycle",
    o.sql(
        "select step, there, case when step='filled' then (select count(*) from cells) else 0 end as rows from "
        "(values ('before',false),('created',true),('filled',true),('dropped',false)) v(step, there)",
        o.CELLS,
    ),
)
def _(t: Tables):
    path = work_dir(t.spark, "table")
    table = f"cells_{path[-32:]}"
    steps = [("before", sinks.table_exists(t.spark, table), 0)]
    sinks.create_table(t.spark, table, path)
    steps.append(("created", sinks.table_exists(t.spark, table), t.spark.table(table).count()))
    t.cells().write.insertInto(table)
    steps.append(("filled", sinks.table_exists(t.spark, table), cell_source.scan_table(t.spark, table).count()))
    sinks.drop_table(t.spark, table)
    steps.append(("dropped", sinks.table_exists(t.spark, table), 0))
    return t.spark.createDataFrame(steps, "step string, there boolean, rows bigint")


# ---------------------------------------------------------------- functions

_KEYED = """keyed as (
 select distinct row_key from cells union select distinct row_key||':'||qualifier from cells)"""


def _keyed(t: Tables) -> DataFrame:
    """All keys, and all keys with a second colon."""
    cells = t.cells()
    long = cells.select(F.concat("row_key", F.lit(":"), "qualifier").alias("row_key"))
    return cells.select("row_key").union(long).distinct()


def _qualified(t: Tables) -> DataFrame:
    """All qualifiers, and odd shapes made from them."""
    q = F.col("qualifier")
    shapes = F.array(q, F.upper(q), F.concat(q, F.lit("_9")), F.concat(F.lit("_"), q), F.substring(q, 1, 5),
                     F.substring(q, 1, 3), F.substring(q, 1, 2), F.concat(q, F.lit("__")))
    return t.cells().select(F.explode(shapes).alias("qualifier")).distinct()


_QUALIFIED = """qualified as (
 select distinct unnest([qualifier, upper(qualifier), qualifier||'_9', '_'||qualifier, substr(qualifier,1,5),
  substr(qualifier,1,3), substr(qualifier,1,2), qualifier||'__']) as qualifier from cells)"""


def _key_query(name: str, fn, body: str):
    query(name, o.sql(f"select row_key, {body} as result from keyed", o.CELLS, _KEYED))(
        lambda t: _keyed(t).select("row_key", fn("row_key").alias("result"))
    )


def _qualifier_query(name: str, fn, body: str):
    query(name, o.sql(f"select qualifier, {body} as result from qualified", o.CELLS, _QUALIFIED))(
        lambda t: _qualified(t).select("qualifier", fn("qualifier").alias("result"))
    )


_key_query("key_prefix_first", keys.key_prefix_first, "case when contains(row_key,':') then split_part(row_key,':',1) end")
_key_query("key_prefix_last", keys.key_prefix_last, f"case when contains(row_key,':') then {o.last_prefix('row_key')} end")
_key_query("key_is_wellformed", keys.key_is_wellformed, o.strict("row_key"))
_key_query("key_is_loose_ok", keys.key_is_loose_ok, o.loose("row_key"))
_key_query("has_no_upper", keys.has_no_upper, "lower(row_key)=row_key")
_qualifier_query("is_legal_column", qualifiers.is_legal_column, o.legal("qualifier"))
_qualifier_query(
    "insert_at",
    qualifiers.insert_at,
    "case when length(qualifier)>=6 then substr(qualifier,1,6)||'0'||substr(qualifier,7) end",
)
_qualifier_query(
    "recode_qualifier",
    qualifiers.recode_qualifier,
    f"case when substr(qualifier,1,3)='mh_' and length(qualifier)<6 then null else {o.recode('qualifier')} end",
)
_qualifier_query("strip_vendor", qualifiers.strip_vendor, "substr(qualifier,4)")


@query(
    "split_vendor_code",
    o.sql(
        "select qualifier, split_part(rtrim(qualifier,'_'),'_',1) as vendor, "
        "case when contains(rtrim(qualifier,'_'),'_') then split_part(rtrim(qualifier,'_'),'_',2) end as code "
        "from qualified",
        o.CELLS,
        _QUALIFIED,
    ),
)
def _(t: Tables):
    return _qualified(t).select(
        "qualifier", qualifiers.vendor_of("qualifier").alias("vendor"), qualifiers.code_of("qualifier").alias("code")
    )


_OS = "case c_custkey%4 when 0 then '0' when 1 then '1' when 2 then '2' end"


@query(
    "build_key_by_os",
    f"select c_custkey, lower(id)||case when os='0' then ':didmd5' else ':ifa' end as row_key from "
    f"(select c_custkey, upper({o.did('c_custkey')}) as id, {_OS} as os from customer)",
)
def _(t: Tables):
    n = F.col("c_custkey")
    os = F.when(n % 4 < 3, (n % 4).cast("string"))
    key = keys.build_key_by_os(F.upper(device_id(n)), os)
    return t.raw("customer").select("c_custkey", key.alias("row_key"))


@query("build_key_by_hyphen", o.sql(f"select id, {o.key_of('upper(id)')} as row_key from ids", o.IDS))
def _(t: Tables):
    return t.ids().select("id", keys.build_key_by_hyphen(F.upper("id")).alias("row_key"))


_OS_OF = "case when contains(id,'-') then '1' else '0' end"


@query("os_of_id", o.sql(f"select id, {_OS_OF} as os from ids", o.IDS))
def _(t: Tables):
    return t.ids().select("id", keys.os_of_id("id").alias("os"))


@query("udf_os", o.sql(f"select did as id, {_OS_OF.replace('id', 'did', 1)} as os from retarget", o.LINES, o.RETARGET))
def _(t: Tables):
    return audience.with_os(t.retarget().select(F.col("did").alias("id")))


@query(
    "normalize_id",
    o.sql(
        f"select raw, {o.norm('raw')} as id from (select chr(9)||' '||uid||chr(13)||' ' as raw from logs)",
        o.LOGS,
    ),
)
def _(t: Tables):
    raw = F.concat(F.lit("\t "), "uid", F.lit("\r "))
    return t.logs().select(raw.alias("raw")).select("raw", keys.normalize_id("raw").alias("id"))


@query(
    "split_take_nth",
    o.sql(
        "select value, case when contains(value,',') then split_part(value,',',2) end as item from "
        "(select distinct value from lines)",
        o.LINES,
    ),
)
def _(t: Tables):
    return t.lines().distinct().select("value", text.split_take_nth("value", ",", 1).alias("item"))


@query("min_length_filter", o.sql("select value from lines where length(value)>=20", o.LINES))
def _(t: Tables):
    return t.lines().where(text.min_length("value"))


@query(
    "display_did",
    o.sql(
        f"select id, {o.shown('id')} as plain, {o.shown('id')}||case when contains(id,'-') then ':ifa' "
        "else ':didmd5' end as full_did from ids",
        o.IDS,
    ),
)
def _(t: Tables):
    return t.ids().select(
        "id", keys.display_did("id").alias("plain"), keys.display_did("id", with_kind=True).alias("full_did")
    )


@query("ms_to_datetime", o.sql(f"select ts, {o.datetime_of('ts')} as date from cells", o.CELLS))
def _(t: Tables):
    return t.cells().select("ts", text.ms_to_datetime("ts").alias("date"))


_ARRAY_JSON = """'["'||string_agg(qualifier,'","' order by qualifier)||'"]'"""
_RAW = f"""(select row_key, split_part(row_key,':',1) as prefix, {_ARRAY_JSON} as tags_json,
 string_agg(qualifier,',' order by qualifier) as tags
 from (select distinct row_key, qualifier from cells where {o.loose("row_key")}) group by row_key)"""


@query(
    "tags_to_json",
    o.sql("""select '{"did":"'||did||'","tags":"'||tags||'"}' as value from taglist""", o.CELLS, o.TAGLIST),
)
def _(t: Tables):
    return t.taglist().select(text.tags_to_json("did", "tags").alias("value"))


@query("parse_export_json", o.sql(f"select {o.shown('prefix')} as did, tags from {_RAW}", o.CELLS))
def _(t: Tables):
    lines = export.export_array(t.cells()).select(text.tags_to_json("did", "tags", "os").alias("value"))
    parsed = lines.select(text.parse_export_json("value").alias("line"))
    return parsed.select("line.did", F.array_join("line.tags", ",").alias("tags"))


@query(
    "date_range",
    "select o_orderkey, strftime(o_orderdate + to_days(cast(i as integer)),'%Y%m%d') as day "
    "from (select o_orderkey, o_orderdate, unnest(range(o_orderkey%5)) as i from orders)",
)
def _(t: Tables):
    day = F.to_date("o_orderdate")
    end = F.date_add(day, (F.col("o_orderkey") % 5 - 1).cast("int"))
    spans = t.raw("orders").select("o_orderkey", *[F.date_format(c, "yyyyMMdd").alias(n) for n, c in (("a", day), ("z", end))])
    return spans.select("o_orderkey", F.explode(text.date_range("a", "z")).alias("day"))


_LISTS = "case c_custkey%5 when 0 then '' when 1 then ',' when 2 then 'a,,b,,' else c_name||','||c_mktsegment||',' end"


@query(
    "split_tag_list",
    f"select c_custkey, item from (select c_custkey, unnest(case when tags<>'' and rtrim(tags,',')='' then [] "
    f"else string_split(rtrim(tags,','),',') end) as item from (select c_custkey, {_LISTS} as tags from customer))",
)
def _(t: Tables):
    n = F.col("c_custkey") % 5
    tags = F.when(n == 0, "").when(n == 1, ",").when(n == 2, "a,,b,,").otherwise(
        F.concat("c_name", F.lit(","), "c_mktsegment", F.lit(","))
    )
    return t.raw("customer").select("c_custkey", F.explode(text.split_tag_list(tags)).alias("item"))


@query(
    "kind_from_path",
    "select path, case when contains(path,'and') then 'didmd5' else 'ifa' end as kind, "
    "regexp_replace(path,'\\..*','_proceed.csv') as out from (select 'ids/'||case when c_custkey%2=0 then 'and' "
    "else 'ios' end||'/'||c_name||case when c_custkey%3=0 then '.part.csv' when c_custkey%3=1 then '.csv' else '' end "
    "as path from customer)",
)
def _(t: Tables):
    n = F.col("c_custkey")
    folder = F.when(n % 2 == 0, "and").otherwise("ios")
    ending = F.when(n % 3 == 0, ".part.csv").when(n % 3 == 1, ".csv").otherwise("")
    path = F.concat(F.lit("ids/"), folder, F.lit("/"), "c_name", ending)
    paths = t.raw("customer").select(path.alias("path"))
    return paths.select("path", keys.kind_from_path("path").alias("kind"), keys.processed_path("path").alias("out"))


# ---------------------------------------------------------------- projections and filters


@query("flat_tags", o.sql("select * from flat", o.CELLS, o.LATEST, o.FLAT))
def _(t: Tables):
    return scan.flat_tags(t.cells())


_UPDATES = 'select row_key as rowkey, qualifier as tag, ts as "timeStamp" from latest'


@query("flat_updates", o.sql(_UPDATES, o.CELLS, o.LATEST))
def _(t: Tables):
    return scan.flat_updates(t.cells())


@query(
    "vendor_updates",
    o.sql(
        f'select rowkey, tag, "timeStamp", {o.datetime_of(chr(34) + "timeStamp" + chr(34))} as date '
        f"from ({_UPDATES}) where tag like 'kd%'",
        o.CELLS,
        o.LATEST,
    ),
)
def _(t: Tables):
    return scan.vendor_updates(t.cells())


@query(
    "prefix_scan_keys",
    o.sql(
        "select split_part(row_key,':',1) as rowkey from (select distinct row_key from cells "
        f"where qualifier like 'kd\\_001%' escape '\\' and {o.loose('row_key')})",
        o.CELLS,
    ),
)
def _(t: Tables):
    return scan.prefix_scan_keys(t.cells(), "kd_001")


_CAMPAIGN_COLUMNS = "project, kind, day, uid, cid, creative_id"


@query("campaign_filter", o.sql(f"select {_CAMPAIGN_COLUMNS} from campaign", o.LOGS, o.CAMPAIGN))
def _(t: Tables):
    return audience.campaign_filter(t.logs(), PROJECTS).drop("slot")


_EXTRACT = """select project as campaign, kind as log_kind, day as log_day, upper(trim(uid)) as device, day,
 cid+creative_id as both_ids from campaign"""
_EXTRACT_FIELDS = ["upper(trim(uid)) as device", "day", "cid + creative_id as both_ids"]
_EXTRACT_FOLDERS = "campaign string, log_kind string, log_day string"


@query("campaign_extract", o.sql(_EXTRACT, o.LOGS, o.CAMPAIGN))
def _(t: Tables):
    path = work_dir(t.spark, "extract")
    jobs.extract_job(t.logs(), PROJECTS, path, _EXTRACT_FIELDS)
    return t.spark.read.schema(f"device string, day string, both_ids bigint, {_EXTRACT_FOLDERS}").parquet(path)


@query(
    "campaign_extract_text",
    o.sql(f"select campaign, log_kind, log_day, device||'|'||day||'|'||both_ids as value from ({_EXTRACT})", o.LOGS, o.CAMPAIGN),
)
def _(t: Tables):
    path = work_dir(t.spark, "extract")
    jobs.extract_job(t.logs(), PROJECTS, path, _EXTRACT_FIELDS, fmt="text", delimiter="|")
    return t.spark.read.schema(f"value string, {_EXTRACT_FOLDERS}").text(path)


@query("select_fields", o.sql("select uid, concat_ws('-', kind, day) as place, cid*2 as twice from logs", o.LOGS))
def _(t: Tables):
    return audience.select_fields(t.logs(), ["uid", "concat_ws('-', kind, day) as place", "cid * 2 as twice"])


@query(
    "explode_results",
    o.sql("select * from results where dealid='1100007' and rescode='1005'", o.RESULTS),
)
def _(t: Tables):
    return audience.explode_results(t.nested(), "1100007", "1005")


@query(
    "audience_from_results",
    o.sql(
        'select distinct "deviceId", "deviceType" from results where dealid=\'1100007\' and rescode=\'1005\'',
        o.RESULTS,
    ),
)
def _(t: Tables):
    return audience.audience_from_results(audience.explode_results(t.nested(), "1100007", "1005"))


@query(
    "time_range_updates",
    o.sql(f'select * from ({_UPDATES}) where "timeStamp">={MIDWAY} and "timeStamp"<{MIDWAY + 7 * 86400000}', o.CELLS, o.LATEST),
)
def _(t: Tables):
    return scan.time_range_updates(t.cells(), MIDWAY, MIDWAY + 7 * 86400000)


@query(
    "sample_rows",
    o.sql(
        "select * from flat where cast('0x'||substr(md5('7|'||rowkey||'|'||tag),1,8) as bigint) < 429496729",
        o.CELLS,
        o.LATEST,
        o.FLAT,
    ),
)
def _(t: Tables):
    return scan.sample_rows(scan.flat_tags(t.cells()), 0.1, ["rowkey", "tag"], seed=7)


@query(
    "named_field_import",
    o.sql("select did as did, os as os, tags as tags from "
          "(select r.did, r.os, 'kd_'||r.os as tags from retarget r)", o.LINES, o.RETARGET),
)
def _(t: Tables):
    rows = t.retarget().select(
        F.col("did").alias("device"), F.col("os").alias("system"), F.concat(F.lit("kd_"), "os").alias("labels"), F.lit(1)
    )
    return audience.named_fields(rows, did="device", os="system", tags="labels")


# ---------------------------------------------------------------- exports

_STRIPPED = f"""select {o.last_prefix("row_key")} as rowkey,
 string_agg(substr(qualifier,4),',' order by qualifier) as tags
 from latest where contains(row_key,':') group by row_key"""


@query("tags_as_string", o.sql(_STRIPPED, o.CELLS, o.LATEST))
def _(t: Tables):
    return export.tags_as_string(t.cells())


@query("tags_as_array", o.sql(_STRIPPED, o.CELLS, o.LATEST))
def _(t: Tables):
    return export.tags_as_array(t.cells()).withColumn("tags", F.array_join("tags", ","))


@query("clean_export", o.sql(_CLEAN, o.CELLS))
def clean_export(t: Tables):
    return export.clean_export(t.cells())


@query(
    "export_json_string",
    o.sql(f"""select '{{"rowkey":"'||prefix||'","value":"'||tags||'"}}' as value from {_RAW}""", o.CELLS),
)
def _(t: Tables):
    return export.export_string(t.cells()).select(text.tags_to_json("rowkey", "value").alias("value"))


_JSON_ARRAY = f"""select '{{"did":"'||{o.shown("prefix")}||'","tags":'||tags_json||',"os":'||
 case when contains(prefix,'-') then 1 else 0 end||'}}' as value from {_RAW}"""


@query("export_json_array", o.sql(_JSON_ARRAY, o.CELLS))
def _(t: Tables):
    return export.export_array(t.cells()).select(text.tags_to_json("did", "tags", "os").alias("value"))


@query(
    "export_json_array_plain",
    o.sql(f"""select '{{"did":"'||prefix||'","tags":'||tags_json||'}}' as value from {_RAW}""", o.CELLS),
)
def _(t: Tables):
    return export.export_array(t.cells(), plain=True).select(text.tags_to_json("did", "tags").alias("value"))


@query("last_update", o.sql(_LAST, o.CELLS))
def _(t: Tables):
    return export.last_update(t.cells())


@query("dump_cells", o.sql("select * from latest", o.CELLS, o.LATEST))
def _(t: Tables):
    return scan.dump_cells(t.cells())


# ---------------------------------------------------------------- quality

_DIRTY_KEYS = f"select distinct row_key from cells where not {o.strict('row_key')}"
_DIRTY_COLUMNS = (
    "select split_part(row_key,':',1) as rowkey, qualifier from latest "
    f"where {o.strict('row_key')} and not {o.exportable('qualifier')}"
)


@query("dirty_rowkeys", o.sql(_DIRTY_KEYS, o.CELLS))
def _(t: Tables):
    return quality.dirty_rowkeys(t.cells())


@query("dirty_columns", o.sql(_DIRTY_COLUMNS, o.CELLS, o.LATEST))
def _(t: Tables):
    return quality.dirty_columns(t.cells())


@query(
    "legacy_ap_audit",
    o.sql(
        "select split_part(row_key,':',1) as rowkey, qualifier from latest "
        f"where {o.loose('row_key')} and contains(lower(qualifier),'_ap_')",
        o.CELLS,
        o.LATEST,
    ),
)
def _(t: Tables):
    return quality.legacy_ap_audit(t.cells())


@query("legacy_key_audit", o.sql(f"select distinct row_key from cells where not {o.loose('row_key')}", o.CELLS))
def _(t: Tables):
    return quality.legacy_key_audit(t.cells())


@query(
    "dirty_summary",
    o.sql(
        f"select count(distinct row_key) filter (where {o.strict('row_key')}) as clean_rows, "
        f"count(distinct row_key) filter (where not {o.strict('row_key')}) as dirty_rowkeys, "
        f"count(*) filter (where {o.strict('row_key')} and not {o.exportable('qualifier')}) as dirty_columns from latest",
        o.CELLS,
        o.LATEST,
    ),
)
def _(t: Tables):
    return quality.dirty_summary(t.cells())


_LIST_SIZES = {
    "projects": "case when c_custkey%3=0 then 3 else 2 end",
    "imp": "case when c_custkey%3=0 or c_custkey%5=0 then 3 else 2 end",
    "ids": "case when c_custkey%3=0 then 3 else 2 end",
}
_LIST_ERROR = "||', '||".join(f"'{name} '||{size}" for name, size in _LIST_SIZES.items())


@query(
    "validate_projects",
    "select c_custkey, case when c_custkey%3<>0 and c_custkey%5=0 "
    f"then 'the parallel lists differ in length: '||{_LIST_ERROR} end as error from customer",
)
def _(t: Tables):
    return quality.validate_projects(_config(t), _LIST_ENDS).select("c_custkey", "error")


_LIST_ENDS = {"projects": ",", "imp": ",", "ids": ";"}


def _config(t: Tables) -> DataFrame:
    n = F.col("c_custkey")
    return t.raw("customer").select(
        n,
        F.concat(F.lit("p"), n, F.lit(",q"), n, F.when(n % 3 == 0, ",r").otherwise("")).alias("projects"),
        F.when((n % 3 == 0) | (n % 5 == 0), "1,0,1").otherwise("1,0").alias("imp"),
        F.when(n % 3 == 0, "1,2;3;4").otherwise("1;103,104;").alias("ids"),
    )


@query("lists_align", "select c_custkey, c_custkey%3=0 or c_custkey%5<>0 as aligned from customer")
def _(t: Tables):
    return _config(t).select("c_custkey", quality.lists_align(_LIST_ENDS).alias("aligned"))


# ---------------------------------------------------------------- lookups

_REQUESTED = f"requested as (select distinct {o.key_of('id')} as row_key from ids)"


def _requested(t: Tables) -> DataFrame:
    return t.ids().select(keys.build_key_by_hyphen("id").alias("row_key"))


@query(
    "get_row",
    o.sql(
        "select latest.*, cast(strlen(row_key) as integer) as key_bytes from latest join requested using (row_key)",
        o.CELLS,
        o.LATEST,
        o.IDS,
        _REQUESTED,
    ),
)
def _(t: Tables):
    return lookup.get_rows(t.cells(), _requested(t))


def _vendor_columns(condition: str = "true") -> str:
    columns = [
        f"coalesce(string_agg(split_part(qualifier,'_',2),',' order by qualifier) "
        f"filter (where split_part(qualifier,'_',1)='{vendor}' and {condition}),'') as {name}"
        for vendor, _, name in qualifiers.VENDORS
    ]
    return f"select row_key, {', '.join(columns)} from requested left join latest using (row_key) group by row_key"


def _vendor_lists(tags: DataFrame) -> DataFrame:
    return tags.select(
        "row_key", *[F.array_join(F.col("tags")[name], ",").alias(name) for _, _, name in qualifiers.VENDORS]
    )


@query("lookup_vendor_tags", o.sql(_vendor_columns(), o.CELLS, o.LATEST, o.IDS, _REQUESTED))
def _(t: Tables):
    return _vendor_lists(lookup.lookup_vendor_tags(t.cells(), _requested(t)))


@query(
    "lookup_one_qualifier",
    o.sql(_vendor_columns("qualifier='kd_006001'"), o.CELLS, o.LATEST, o.IDS, _REQUESTED),
)
def _(t: Tables):
    return _vendor_lists(lookup.lookup_vendor_tags(t.cells(), _requested(t), qualifier="kd_006001"))


_HITS = "hits as (select distinct row_key from cells where substr(qualifier,4) in ('001001','012001'))"
_HIT_IDS = f"select id as value, {o.key_of('id')} as row_key from ids where {o.key_of('id')} in (select row_key from hits)"


@query("audience_filter", o.sql(_HIT_IDS, o.CELLS, o.IDS, _HITS))
def _(t: Tables):
    ids = t.ids().select(F.col("id").alias("value"), keys.build_key_by_hyphen("id").alias("row_key"))
    return lookup.audience_filter(ids, t.cells(), listed(t.spark, FILTER_TAGS, "tag"))


@query(
    "tags_intersect",
    o.sql(
        f"select {o.last_prefix('row_key')} as rowkey, bool_or(substr(qualifier,4) in ('001001','012001')) as hit "
        "from latest where contains(row_key,':') group by row_key",
        o.CELLS,
        o.LATEST,
    ),
)
def _(t: Tables):
    devices = export.tags_as_array(t.cells())
    return devices.select("rowkey", lookup.tags_intersect("tags", FILTER_TAGS).alias("hit"))


@query(
    "build_request_keys",
    o.sql(
        f"select {o.key_of('value')} as row_key, true as with_kind from lines where length(value)>3 "
        "union all select lower(value) as row_key, false as with_kind from lines where length(value)>3",
        o.LINES,
    ),
)
def _(t: Tables):
    return (
        lookup.request_keys(t.lines())
        .withColumn("with_kind", F.lit(True))
        .union(lookup.request_keys(t.lines(), with_kind=False).withColumn("with_kind", F.lit(False)))
    )


# ---------------------------------------------------------------- mutations

_CELL_COLUMNS = "row_key, family, qualifier, ts, value"
_NEWEST = (
    "select row_key, family, qualifier, max(ts) as ts, arg_max(value, {{ts: ts, value: value}}) as value "
    "from ({}) group by all"
)


@query(
    "put_cell",
    o.sql(
        f"select {_CELL_COLUMNS} from latest union all select 'new-device:ifa','cf','ap_{TAG}',{LATER},'1'",
        o.CELLS,
        o.LATEST,
    ),
)
def _(t: Tables):
    put = mutate.put_cell(t.spark, "new-device:ifa", f"ap_{TAG}", LATER)
    return mutate.apply_mutations(t.cells(), put)


_RETARGET_PUTS = (
    "select lower(did)||case when os='0' then ':didmd5' else ':ifa' end as row_key, 'cf' as family, "
    f"'ap_{TAG}' as qualifier, {LATER} as ts, '1' as value from retarget"
)
_TAGLIST_PUTS = (
    "select lower(did) as row_key, 'cf' as family, unnest(string_split(tags,',')) as qualifier, "
    f"{LATER} as ts, '1' as value from taglist"
)


@query("retarget_puts", o.sql(f"select 'put' as op, *, cast(null as bigint) as marked_at from ({_RETARGET_PUTS})", o.LINES, o.RETARGET))
def _(t: Tables):
    return mutate.retarget_puts(t.retarget(), TAG, LATER)


@query("taglist_puts", o.sql(f"select 'put' as op, *, cast(null as bigint) as marked_at from ({_TAGLIST_PUTS})", o.CELLS, o.TAGLIST))
def _(t: Tables):
    return mutate.taglist_puts(t.taglist(), LATER)


@query(
    "delete_rows",
    o.sql(
        _NEWEST.format(f"select * from cells where ts>{MIDWAY} or row_key not in (select row_key from debtors)"),
        o.CELLS,
        o.DEBTORS,
    ),
)
def _(t: Tables):
    return mutate.apply_mutations(t.cells(), mutate.delete_rows(t.debtors(), MIDWAY))


_COLUMN = "ap_010001"
_TARGETED = f"(qualifier='{_COLUMN}' and row_key in (select row_key from requested))"


@query(
    "delete_column",
    o.sql(
        _NEWEST.format(
            f"select c.* from cells c join (select row_key, qualifier, max(ts) as top from cells group by all) n "
            f"using (row_key, qualifier) where not ({_TARGETED} and ts=top)"
        ),
        o.CELLS,
        o.IDS,
        _REQUESTED,
    ),
)
def _(t: Tables):
    log = mutate.puts_of(t.cells())
    return mutate.apply_mutations(t.cells(), mutate.delete_column(log, t.ids(), _COLUMN, LATER))


@query("delete_column_twice", SQL["delete_column"])
def _(t: Tables):
    log = mutate.puts_of(t.cells())
    once = mutate.delete_column(log, t.ids(), _COLUMN, LATER)
    again = mutate.delete_column(log.unionByName(once), t.ids(), _COLUMN, LATER)
    return mutate.apply_mutations(t.cells(), once, again)


@query(
    "delete_column_all",
    o.sql(_NEWEST.format(f"select * from cells where ts>{MIDWAY} or not {_TARGETED}"), o.CELLS, o.IDS, _REQUESTED),
)
def _(t: Tables):
    log = mutate.puts_of(t.cells())
    return mutate.apply_mutations(t.cells(), mutate.delete_column(log, t.ids(), _COLUMN, MIDWAY, mode="all"))


@query(
    "apply_mutations",
    o.sql(
        _NEWEST.format(
            f"select * from (select * from cells union all {_RETARGET_PUTS} union all {_TAGLIST_PUTS}) "
            f"where (ts>{MIDWAY} or row_key not in (select row_key from debtors)) "
            f"and (ts>{LATER} or not {_TARGETED})"
        ),
        o.CELLS,
        o.LINES,
        o.RETARGET,
        o.TAGLIST,
        o.DEBTORS,
        o.IDS,
        _REQUESTED,
    ),
)
def _(t: Tables):
    puts = mutate.retarget_puts(t.retarget(), TAG, LATER), mutate.taglist_puts(t.taglist(), LATER)
    rows = mutate.delete_rows(t.debtors(), MIDWAY)
    column = mutate.delete_column(mutate.puts_of(t.cells()), t.ids(), _COLUMN, LATER, mode="all")
    return mutate.apply_mutations(t.cells(), *puts, rows, column)


def _batches(t: Tables) -> list[DataFrame]:
    """The mutations of ``apply_mutations``."""
    column = mutate.delete_column(mutate.puts_of(t.cells()), t.ids(), _COLUMN, LATER, mode="all")
    puts = mutate.retarget_puts(t.retarget(), TAG, LATER), mutate.taglist_puts(t.taglist(), LATER)
    return [column, *puts, mutate.delete_rows(t.debtors(), MIDWAY)]


@query("fold_batches", SQL["apply_mutations"])
def _(t: Tables):
    table = buckets.Buckets(work_dir(t.spark, "buckets"), 16)
    staging = work_dir(t.spark, "staging")
    for number, batch in enumerate([mutate.puts_of(t.cells()), *_batches(t)]):
        buckets.fold_batch(t.spark, table, batch, number, staging)
    return mutate.current_state(buckets.read_log(t.spark, table))


@query("watermarks", o.sql(f"select count(distinct row_key) as keys, 1 as batch from cells where row_key in (select row_key from debtors)",
                           o.CELLS, o.DEBTORS))
def _(t: Tables):
    """Keys of the debtors that have cells, counted in the buckets a batch on them rewrote."""
    table = buckets.Buckets(work_dir(t.spark, "buckets"), 64)
    staging = work_dir(t.spark, "staging")
    buckets.fold_batch(t.spark, table, mutate.puts_of(t.cells()), 0, staging)
    buckets.fold_batch(t.spark, table, mutate.delete_rows(t.debtors(), 0), 1, staging)
    stored = buckets.read_stored(t.spark, table).where((F.col("op") == mutate.PUT) & (F.col("batch") == 1))
    found = stored.join(t.debtors(), "row_key", "left_semi")
    return found.agg(F.count_distinct("row_key").alias("keys"), F.max("batch").cast("int").alias("batch"))


# ---------------------------------------------------------------- aggregates


@query("count_by_os", o.sql('select os, count(*) as "count" from retarget group by os', o.LINES, o.RETARGET))
def _(t: Tables):
    return aggregate.count_by_os(t.retarget())


@query("count_ids", o.sql('select count(*) as "count" from retarget', o.LINES, o.RETARGET))
def _(t: Tables):
    return aggregate.count_ids(t.retarget())


@query("distinct_ids", o.sql(f"select distinct {o.norm('uid')} as id from logs", o.LOGS))
def _(t: Tables):
    return audience.audience_ids(t.logs().select("uid")).select("id")


@query("tag_reach_top200", o.sql(f"select tag, cnt from {_TOP}", o.CELLS, o.LATEST, o.FLAT))
def _(t: Tables):
    return aggregate.tag_reach(t.cells())


@query("tag_index", o.sql("select distinct tag, rowkey from flat", o.CELLS, o.LATEST, o.FLAT))
def _(t: Tables):
    return aggregate.tag_index(t.cells())


_TAG_LISTS = (
    "select tag, 0 as part, string_agg(rowkey,',' order by rowkey) as rowkeys from "
    "(select distinct tag, rowkey from flat) group by tag"
)


@query("tag_to_devices_set", o.sql(_TAG_LISTS, o.CELLS, o.LATEST, o.FLAT))
def _(t: Tables):
    return aggregate.tag_to_devices(t.cells()).withColumn("rowkeys", F.array_join("rowkeys", ","))


@query("tag_to_devices_str", o.sql(_TAG_LISTS, o.CELLS, o.LATEST, o.FLAT))
def _(t: Tables):
    return aggregate.tag_to_devices_text(t.cells())


@query(
    "tag_to_devices_parts",
    o.sql(
        "select tag, cast(cast('0x'||substr(md5(rowkey),1,8) as bigint)%4 as integer) as part, "
        "string_agg(rowkey,',' order by rowkey) as rowkeys from (select distinct tag, rowkey from flat) group by all",
        o.CELLS,
        o.LATEST,
        o.FLAT,
    ),
)
def _(t: Tables):
    return aggregate.tag_to_devices_text(t.cells(), parts=4)


def _postings(t: Tables, whole_keys: bool = False) -> postings.Postings:
    """Bitmaps of the tags, written and read again."""
    index = aggregate.tag_index(t.cells()).withColumnRenamed("rowkey", "device")
    path = work_dir(t.spark, "postings")
    postings.write_postings(postings.key_tags(t.cells()) if whole_keys else index, path, 4)
    return postings.read_postings(t.spark, path)


_PAGES = (
    "select tag, bucket+4*(place//32768) as page, count(*) as devices from (select tag, bucket, "
    "dense_rank() over (partition by bucket order by rowkey)-1 as place from (select distinct tag, rowkey, "
    "cast('0x'||substr(md5(rowkey),1,8) as bigint)%4 as bucket from flat)) group by all"
)


@query("bitmap_pages", o.sql(_PAGES, o.CELLS, o.LATEST, o.FLAT))
def _(t: Tables):
    return _postings(t).tags.select("tag", "page", F.bitmap_count("bits").alias("devices"))


@query("bitmap_reach", o.sql("select tag, count(distinct rowkey) as cnt from flat group by tag", o.CELLS, o.LATEST, o.FLAT))
def _(t: Tables):
    return postings.reach(_postings(t).tags)


@query("bitmap_devices", o.sql("select distinct tag, rowkey as device from flat", o.CELLS, o.LATEST, o.FLAT))
def _(t: Tables):
    found = _postings(t)
    return postings.members(found.devices, found.tags)


@query("bitmap_audience_any", SQL["audience_filter"])
def _(t: Tables):
    """The audience filter, by bitmaps of whole keys."""
    found = _postings(t, whole_keys=True)
    hits = postings.members(found.devices, postings.any_of(found.tags, FILTER_TAGS)).withColumnRenamed("device", "row_key")
    ids = t.ids().select(F.col("id").alias("value"), keys.build_key_by_hyphen("id").alias("row_key"))
    return ids.join(hits, "row_key", "left_semi")


_MANY_TAGS = "'001001','012001','023001'"


@query(
    "bitmap_audience_all",
    o.sql(
        f"select rowkey as device from flat where tag in ({_MANY_TAGS}) group by rowkey having count(distinct tag)=3 "
        f"union all select 'size '||count(*) from (select rowkey from flat where tag in ({_MANY_TAGS}) group by rowkey "
        "having count(distinct tag)=3)",
        o.CELLS,
        o.LATEST,
        o.FLAT,
    ),
)
def _(t: Tables):
    """Devices with all of three tags, and how many they are."""
    found = _postings(t)
    hits = postings.all_of(found.tags, ["001001", "012001", "023001"])
    total = postings.size(hits).select(F.concat(F.lit("size "), "count").alias("device"))
    return postings.members(found.devices, hits).unionByName(total)


@query("sort_by_time_desc", o.sql(_UPDATES, o.CELLS, o.LATEST))
def _(t: Tables):
    return scan.sort_by_time_desc(scan.flat_updates(t.cells()))


@query("preview", o.sql("select did, os from retarget order by did, os limit 20", o.LINES, o.RETARGET))
def _(t: Tables):
    return scan.preview(t.retarget().orderBy("did", "os"))


# ---------------------------------------------------------------- jobs


@query("ingest_id_file", o.sql("select did as id, os from retarget", o.LINES, o.RETARGET))
def _(t: Tables):
    path = work_dir(t.spark, "lines")
    sinks.write_lines(t.lines(), path)
    ids = jobs.ingest_id_file(t.spark, path, ",", 1)
    out = work_dir(t.spark, "audience")
    jobs.save_audience(ids, LATER, TAG, path=out, files=20)
    return t.spark.read.schema("id string, os string").parquet(out)


_AUDIENCE = f"select id, {_OS_OF} as os from (select distinct {o.norm('uid')} as id from campaign)"


@query("ingest_campaign_audience", o.sql(_AUDIENCE, o.LOGS, o.CAMPAIGN))
def _(t: Tables):
    return jobs.ingest_campaign_audience(t.logs(), PROJECTS)


@query(
    "ingest_campaign_puts",
    o.sql(
        f"select {o.key_of('id')} as row_key, 'cf' as family, 'ap_{TAG}' as qualifier, {LATER} as ts, '1' as value "
        f"from ({_AUDIENCE})",
        o.LOGS,
        o.CAMPAIGN,
    ),
)
def _(t: Tables):
    log = work_dir(t.spark, "log")
    ids = jobs.ingest_campaign_audience(t.logs(), PROJECTS)
    jobs.save_audience(ids, LATER, TAG, path=work_dir(t.spark, "audience"), log=log)
    return mutate.current_state(mutate.read_log(t.spark, log))


@query("union_imp_clk", o.sql("select kind, project, uid from campaign", o.LOGS, o.CAMPAIGN))
def _(t: Tables):
    rows = [audience.campaign_filter(t.logs().where(F.col("kind") == kind), PROJECTS) for kind in audience.KINDS]
    return rows[0].unionByName(rows[1]).select("kind", "project", "uid")


@query(
    "export_job",
    o.sql(
        f"select * from (select 'string' as mode, * from ({_STRIPPED}) union all select 'array' as mode, * from ({_STRIPPED}))",
        o.CELLS,
        o.LATEST,
    ),
)
def _(t: Tables):
    written = jobs.export_job(t.cells(), work_dir(t.spark, "export"), ["string", "array"], files=4)
    string = t.spark.read.parquet(written["string"])
    array = t.spark.read.parquet(written["array"]).withColumn("tags", F.array_join("tags", ","))
    return string.withColumn("mode", F.lit("string")).unionByName(array.withColumn("mode", F.lit("array")))


@query("export_job_update", SQL["vendor_updates"])
def _(t: Tables):
    written = jobs.export_job(t.cells(), work_dir(t.spark, "export"), ["update", "string"])
    return t.spark.read.parquet(written["update"])


@query("audit_job_json", o.sql(_JSON_ARRAY, o.CELLS))
def _(t: Tables):
    path = work_dir(t.spark, "audit")
    jobs.audit_job(t.spark, t.cells(), path, "json")
    return t.spark.read.text(path)


@query("audit_job_timestamp", SQL["write_csv_pairs"])
def _(t: Tables):
    path = work_dir(t.spark, "audit")
    jobs.audit_job(t.spark, t.cells(), path, "timestamp")
    return t.spark.read.text(path)


@query(
    "audit_job_prefix",
    o.sql(
        "select split_part(row_key,':',1) as value from (select distinct row_key from cells "
        f"where substr(qualifier,1,2)='kd' and {o.loose('row_key')})",
        o.CELLS,
    ),
)
def _(t: Tables):
    path = work_dir(t.spark, "audit")
    jobs.audit_job(t.spark, t.cells(), path, "prefix", prefix="kd")
    return t.spark.read.text(path)


_CLEAN_JSON = """select '{"did":"'||did||'","tags":"'||tags||'","os":'||os||'}' as value, 'clean' as output"""


@query(
    "audit_job",
    o.sql(
        f"{_CLEAN_JSON} from ({_CLEAN}) union all select row_key, 'dirty_rowkeys' from ({_DIRTY_KEYS}) "
        f"union all select rowkey||','||qualifier, 'dirty_columns' from ({_DIRTY_COLUMNS})",
        o.CELLS,
        o.LATEST,
    ),
)
def _(t: Tables):
    path = work_dir(t.spark, "audit")
    jobs.audit_job(t.spark, t.cells(), path, "clean", check=True)
    return t.spark.read.schema("value string, output string").text(path)


@query("audit_job_delete", SQL["delete_rows"])
def _(t: Tables):
    log, keys_path = work_dir(t.spark, "log"), work_dir(t.spark, "keys")
    sinks.write_lines(t.debtors().select(F.col("row_key").alias("value")), keys_path)
    mutate.upsert_cells(mutate.puts_of(t.cells()), log)
    jobs.audit_job(t.spark, t.cells(), "", "delete", log=log, keys_path=keys_path, at_ms=MIDWAY)
    return mutate.current_state(mutate.read_log(t.spark, log))


@query(
    "audit_job_audience",
    o.sql(
        "select id as value, case when contains(id,'-') then 'os=ios' else 'os=and' end||'/ids_proceed.csv' as output "
        f"from ids where {o.key_of('id')} in (select row_key from cells where "
        "substr(qualifier,4) in (select tag from flat))",
        o.CELLS,
        o.LATEST,
        o.FLAT,
        o.IDS,
    ),
)
def _(t: Tables):
    path = work_dir(t.spark, "audit")
    ids_path, tags_path = _id_folders(t, "folders", one_name=True), _tag_file(t)
    jobs.audit_job(t.spark, t.cells(), path, "audience", ids_path=ids_path, tags_path=tags_path)
    return t.spark.read.schema("value string, output string").text(path)


@query("import_job", o.sql(_RETARGET_PUTS, o.LINES, o.RETARGET))
def _(t: Tables):
    ids, log = work_dir(t.spark, "ids"), work_dir(t.spark, "log")
    t.retarget().write.parquet(ids)
    jobs.import_job(files.read_parquet_ids(t.spark, ids, RETARGET), log, LATER, TAG)
    return mutate.current_state(mutate.read_log(t.spark, log))


@query("import_job_taglist", o.sql(f"select distinct * from ({_TAGLIST_PUTS})", o.CELLS, o.TAGLIST))
def _(t: Tables):
    ids, log = work_dir(t.spark, "ids"), work_dir(t.spark, "log")
    sinks.write_json_lines(t.taglist().select(F.col("did").alias("device"), F.col("tags").alias("labels")), ids)
    rows = files.read_json_ids(t.spark, ids, StructType.fromDDL("device string, labels string"))
    jobs.import_job(rows, log, LATER, did="device", tags="labels")
    return mutate.current_state(mutate.read_log(t.spark, log))

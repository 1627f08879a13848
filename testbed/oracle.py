"""DuckDB fragments: the derived tables and the row-level rules, written independently of the library."""

from __future__ import annotations


def did(n: str) -> str:
    m = f"md5(cast({n} as varchar))"
    uuid = f"substr({m},1,8)||'-'||substr({m},9,4)||'-'||substr({m},13,4)||'-'||substr({m},17,4)||'-'||substr({m},21,12)"
    return f"(case when ({n})%2=1 then {uuid} else {m} end)"


def loose(k: str) -> str:
    return f"(contains({k},':') and length(split_part({k},':',1)) in (32,36))"


def strict(k: str) -> str:
    return f"(length({k}) in (39,40) and lower({k})={k} and {loose(k)})"


def legal(q: str) -> str:
    return f"(length(regexp_replace({q},'[0-9_]','','g'))=2)"


def exportable(q: str) -> str:
    return f"({legal(q)} and not ({q} like 'mh\\_%' escape '\\' and length({q})<6))"


def recode(q: str) -> str:
    swaps = {"td": "011", "up": "012", "ap": "015", "kd": "017", "am": "018", "qx": "019", "sz": "021"}
    arms = " ".join(f"when substr({q},1,3)='{v}_' then '{n}'||substr({q},4)" for v, n in swaps.items())
    return f"(case when substr({q},1,3)='mh_' then '010'||substr({q},4,3)||'0'||substr({q},7) {arms} else {q} end)"


def key_of(x: str) -> str:
    return f"(lower({x})||case when contains({x},'-') then ':ifa' else ':didmd5' end)"


def shown(x: str) -> str:
    return f"(case when contains({x},'-') then upper({x}) else {x} end)"


def norm(x: str) -> str:
    return f"regexp_replace(lower({x}),'^[\\x00-\\x20]+|[\\x00-\\x20]+$','','g')"


def last_prefix(k: str) -> str:
    return f"regexp_extract({k},'^(.*):',1)"


def datetime_of(ms: str) -> str:
    return f"strftime(make_timestamp({ms}//1000*1000000),'%Y-%m-%d %H:%M:%S')"


CELLS = f"""cells as (
 select case when user_id%29=3 then upper(did)||':'||sfx when user_id%31=1 then did||sfx
   when user_id%37=2 then substr(did,1,20)||':'||sfx else did||':'||sfx end as row_key,
  'cf' as family,
  case when event_id%97=0 then 'mh_1' when event_id%41=0 then 'x_ap_'||code else vendor||'_'||code end as qualifier,
  ts_ms as ts, cast(event_id%10 as varchar) as value
 from (select event_id, user_id, {did("user_id")} as did,
   case when user_id%2=1 then 'ifa' else 'didmd5' end as sfx,
   case event_id%8 when 0 then 'mh' when 1 then 'td' when 2 then 'up' when 3 then 'ap' when 4 then 'kd'
     when 5 then 'am' when 6 then 'qx' else 'sz' end as vendor,
   lpad(cast((event_id*7+user_id)%40 as varchar),3,'0')||'001' as code,
   epoch_us(ts)//1000 as ts_ms from events) t)"""

LATEST = """latest as (
 select row_key, family, qualifier, max(ts) as ts, arg_max(value, {ts: ts, value: value}) as value
 from cells group by all)"""

LOGS = f"""logs as (
 select case when event_type in ('click','purchase') then 'clk' else 'imp' end as kind, strftime(ts,'%Y%m%d') as day,
  case when event_id%3=0 then upper({did("user_id")}) when event_id%3=1 then ' '||{did("user_id")}
   else {did("user_id")} end as uid,
  event_id%5 as cid, 100+event_id%7 as creative_id
 from events)"""

LINES = f"""lines as (
 select case when c_custkey%50=7 then 'short,line' when c_custkey%50=8 then c_name||c_mktsegment
  when c_custkey%50=9 then c_name||','||upper(did)||chr(9)||','||c_mktsegment
  else c_name||','||did||','||c_mktsegment end as value
 from (select *, {did("(c_custkey%400)")} as did from customer) t)"""

RESULTS = """results as (
 select md5(cast(o_custkey as varchar)) as "deviceId", cast(o_custkey%2 as varchar) as "deviceType",
  cast(1100000+l_partkey%50 as varchar) as dealid,
  case l_returnflag when 'A' then '1005' when 'N' then '1006' else '1007' end as rescode,
  epoch_us(o_orderdate)//1000 as "timestamp"
 from orders join lineitem on o_orderkey=l_orderkey where o_orderkey%11<>0 and o_orderkey%13<>0)"""

IDS = f"ids as (select {did('c_custkey')} as id from customer)"

DEBTORS = f"debtors as (select {key_of(did('c_custkey'))} as row_key from customer where c_acctbal<0)"

RETARGET = f"""retarget as (
 select id as did, case when contains(id,'-') then '1' else '0' end as os
 from (select distinct {norm("split_part(value,',',2)")} as id from lines
  where length(value)>=20 and contains(value,',')))"""

TAGLIST = """taglist as (
 select row_key as did, string_agg(qualifier,',' order by qualifier) as tags
 from (select distinct row_key, qualifier from cells) group by row_key)"""

CAMPAIGN = """campaign as (
 select 'p1' as project, * from logs where kind='imp' and cid in (1,2) and day between '20240105' and '20240110'
 union all
 select 'p2' as project, * from logs where creative_id=103 and day between '20240108' and '20240115')"""

FLAT = f"""flat as (
 select {last_prefix("row_key")} as rowkey, substr(qualifier,4) as tag
 from latest where contains(row_key,':') and length(qualifier)>3)"""


def sql(body: str, *ctes: str) -> str:
    return f"with {', '.join(ctes)} {body}" if ctes else body

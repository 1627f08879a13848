"""DuckDB twins of the queries that SQL can express, written independently of the operators."""

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = f"""
with recursive d as (select doc_id, {WORDS.format(LOWER)} as w from documents),
s as (select doc_id, list_distinct(case when len(w)=0 then [] when len(w)<5 then [array_to_string(w,' ')]
  else [array_to_string(list_slice(w,i,i+4),' ') for i in range(1,len(w)-3)] end) as sh from d),
n as (select doc_id, len(sh) as n from s),
u as (select doc_id, unnest(sh) as x from s),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from u a join u b on a.x=b.x and a.doc_id<b.doc_id group by all),
l as (select a, b from p join n na on na.doc_id=a join n nb on nb.doc_id=b where 100*k>=85*(na.n+nb.n-k)),
e as (select a, b from l union all select b, a from l),
r as (select doc_id as id, doc_id as reach from n union select r.id, e.b from r join e on r.reach=e.a)
select doc_id, cast(n as bigint) as n_shingles, min(reach) as component_id, doc_id=min(reach) as kept
from n join r on doc_id=id group by doc_id, n"""

PASSAGES = f"""
with d as (select doc_id, {WORDS.format("coalesce(text,'')")} as w from documents),
starts as (select doc_id, w, unnest(range(1,len(w)-18)) as i from d),
windows as (select doc_id, i, row_number() over (partition by array_to_string(list_slice(w,i,i+19),' ') order by doc_id, i) as k
  from starts),
gone as (select distinct doc_id, i+j as p from windows, (select unnest(range(20)) as j) where k>1),
words as (select doc_id, unnest(range(1,len(w)+1)) as p, unnest(w) as word from d),
kept as (select words.doc_id, count(gone.p) as n, string_agg(word,' ' order by words.p) filter (where gone.p is null) as kept
  from words left join gone on words.doc_id=gone.doc_id and words.p=gone.p group by words.doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n,0) as n_removed, sha256(coalesce(kept,'')) as kept_sha256
from d left join kept using (doc_id)"""

_RULES = (("example.org", "/en/1", "block"), ("example.org", "/es/", "block"), ("com", "/de/", "block"),
          ("com", "/fr/", "allow"), ("org", "/", "allow"))
_FITS = [f"when (host='{h}' or ends_with(host,'.{h}')) and starts_with(path,'{p}') then" for h, p, _ in _RULES]
_RULE = "case " + " ".join(f"{fit} '{h + p}'" for fit, (h, p, _) in zip(_FITS, _RULES, strict=True)) + " end"
_RULED = "case " + " ".join(f"{fit} '{v}'" for fit, (_, _, v) in zip(_FITS, _RULES, strict=True)) + " end"

# Wildcards: 20 values at a place, 2 % of the host's urls there; siblings by chi-square; prior of 10 labels.
URL_FILTER = f"""
with rest as (select page_id, case when contains(url,'://') then substr(url, strpos(url,'://')+3) else '' end as r
  from (select page_id, coalesce(url,'') as url from pages)),
split as (select page_id, r, regexp_extract(r,'^[^/?#]*') as h from rest),
parts as (select page_id, translate(h,'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(substr(r,length(h)+1),'^[^?#]*') as path from split),
masked as (select page_id, host, path, {_RULE} as rule, {_RULED} as ruled,
  [regexp_replace(x,'[0-9]+','#','g') for x in string_split(path,'/') if x<>''] as m from parts),
urls as (select *, m as segs from masked),
shapes as (select host, segs, count(*) as n, count(ruled) as labelled, count(*) filter (where ruled='block') as bad
  from urls group by host, segs),
places as (select host, n, unnest(segs) as v, unnest(range(1,len(segs)+1)) as i from shapes),
vals as (select host, i, v, sum(n) as n from places group by all),
kept as (select host, i, v from vals join (select host, i, sum(n) as total, count(*) as kinds from vals group by host, i)
  using (host, i) where kinds<20 or n>=0.02*total),
long as (select host, segs, s.i, case when kept.v is null then '*' else s.v end as v from
  (select host, segs, unnest(segs) as v, unnest(range(1,len(segs)+1)) as i from shapes) s left join kept using (host, i, v)),
template as (select host, segs, list(v order by i) as t from long group by host, segs
  union all select host, segs, [] from shapes where len(segs)=0),
branch as (select host, t, sum(n) as n, sum(labelled) as labelled, sum(bad) as bad
  from shapes join template using (host, segs) group by host, t),
siblings as (select *, list_slice(t,1,len(t)-1) as parent, len(t) as depth, labelled>0 as seen,
  bad::double as b, labelled::double as k from branch),
pairs as (select *, lag(b) over o as b0, lag(k) over o as k0 from siblings
  window o as (partition by host, parent, depth, seen order by b/nullif(k,0), k, t)),
banded as (select *, sum(case when (b*k0-b0*k)*(b*k0-b0*k)*(k+k0) > 3.84::double*(k*k0*(b+b0)*((k+k0)-(b+b0))) then 1 else 0 end) over
  (partition by host, parent, depth, seen order by b/nullif(k,0), k, t rows unbounded preceding) as band from pairs),
merged as (select host, t, sum(labelled) over g as labelled, sum(bad) over g as bad from banded
  window g as (partition by host, parent, depth, seen, band)),
prior as (select t, (sum(bad)+10*(select (sum(bad)+1)/(sum(labelled)+2) from branch))/(sum(labelled)+10) as prior from branch group by t),
share as (select host, t, (bad+10*prior)/(labelled+10) as share from merged join prior using (t))
select page_id, host, path, rule, coalesce(ruled, case when share>0.5 then 'block' else 'allow' end) as verdict,
 '/'||array_to_string(t,'/') as template, round(share,9) as share
from urls left join template using (host, segs) left join share using (host, t)"""

# CRC-32 a byte at a time, by a table made from its polynomial.
SHARDING = """
with crc as (select list(list_reduce(list_prepend(i::bigint, range(8)::bigint[]),
  lambda x, k: case when x % 2 = 1 then xor(x >> 1, 3988292384) else x >> 1 end) order by i) as t
  from (select unnest(range(256)) as i)),
d as (select doc_id, coalesce(text,'') as text, hex(encode(coalesce(text,''))) as h from documents),
r as (select doc_id, cast(octet_length(encode(text))+8 as bigint) as size, ('0x'||substr(md5(text),1,15))::bigint as key,
  cast(xor(list_reduce(list_prepend(4294967295::bigint, list_transform(regexp_extract_all(h,'..'), lambda b: ('0x'||b)::bigint)),
  lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) as bigint) as text_crc32 from d, crc),
o as (select *, sum(size) over () as total, row_number() over w as rank, sum(size) over w - size as start
  from r window w as (order by key, doc_id nulls first rows unbounded preceding)),
g as (select *, sum(size) over (partition by key) as copies, min(start) over (partition by key) as first from o),
s as (select *, case when copies*24*100<=total then 24*(2*first+copies)//(2*total) else 24*(2*start+size)//(2*total) end as shard from g)
select doc_id, size, text_crc32, 'bytes' as law, cast(shard as int) as shard,
  cast(rank - min(rank) over (partition by shard) as bigint) as slot, cast(null as int) as grown_shard from s"""

PHRASES = f"""
with p as (select coalesce(lang,'und') as lang, unnest(string_split_regex({LOWER},'[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece,'[^\x20\x09]+') as w from p),
total as (select lang, cast(sum(len(w)) as bigint) as n from w group by lang),
heads as (select lang, w, unnest(range(1,len(w)+1)) as i from w),
runs as (select lang, w, i, unnest(range(1,least(4,len(w)-i+1)+1)) as k from heads),
f as (select lang, array_to_string(list_slice(w,i,i+k-1),' ') as phrase, k, count(*) as f from runs group by all having count(*)>=30),
c as (select lang, phrase, string_split(phrase,' ') as w, k, f from f where k>1),
cuts as (select lang, phrase, f as a, unnest(range(1,k)) as j, w, k from c),
scored as (select c.lang, c.phrase, j, a, l.f as l, r.f as r, cast(2000000*a::hugeint//(l.f+r.f) as bigint) as score from cuts c
  join f l on l.lang=c.lang and l.phrase=array_to_string(list_slice(w,1,j),' ')
  join f r on r.lang=c.lang and r.phrase=array_to_string(list_slice(w,j+1,c.k),' ')),
weakest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, j)=1),
inside as (select distinct a.lang, a.phrase from c a join c b on a.lang=b.lang and b.k>a.k
  and contains(' '||b.phrase||' ', ' '||a.phrase||' ') and 100*b.f>=80*a.f),
best as (select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, score
  from weakest anti join inside using (lang, phrase) qualify rank<=2000)
select lang, rank, phrase, a, l, r, n, score from best join total using (lang)"""

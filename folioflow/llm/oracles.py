"""DuckDB SQL with the rows of the queries that SQL can express."""

from __future__ import annotations

_SIZES = r"""
sized as (
  select doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, 'null' || md5(coalesce(text, ''))) || ':mix'), 1, 15))::bigint as at
  from documents)"""

OP3 = f"""
with {_SIZES},
per_source as (select source, sum(size)::bigint as source_size from sized group by source),
weighted as (
  select source, source_size, 2.0::double * source_size as most,
         [5, 2, 1][(row_number() over (order by source is null, source) - 1) % 3 + 1]::double as w
  from per_source),
filled as (
  select *, most / w as ratio,
         (1.5::double * sum(source_size) over ()
          - coalesce(sum(most) over (order by most / w, source is null, source rows between unbounded preceding and 1 preceding), 0))
         / sum(w) over (order by most / w, source is null, source rows between current row and unbounded following) as level
  from weighted),
targets as (
  select source, source_size, 1.5::double * sum(source_size) over () as wanted,
         coalesce(least(most, w * (select min_by(level, ratio) from filled where level <= ratio)), most)::double as target
  from filled),
bounds as (
  select *, round(sum(target) over (order by source is null, source) / wanted * 281474976710656.0)::bigint as hi,
         row_number() over (order by source is null desc, source desc) = 1 as is_last
  from targets),
intervals as (
  select source, source_size, target, case when is_last then 281474976710656 else hi end as hi,
         coalesce(lag(hi) over (order by source is null, source), 0) as lo
  from bounds),
slots as (
  select k, list_sum([((k >> i) & 1) << (47 - i) for i in range(48)])::bigint as v
  from (select unnest(range((select ceil(max(wanted) / 64)::bigint from targets))) as k)),
scheduled as (select source, source_size, target, count(k) * 64 as words from intervals left join slots on v >= lo and v < hi group by all),
placed as (
  select s.doc_id, s.size, t.source_size, t.target, t.words,
         coalesce(sum(s.size) over (partition by s.source order by s.at, s.doc_id nulls first, s.size
                                    rows between unbounded preceding and 1 preceding), 0)::bigint as first
  from sized s join scheduled t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (greatest(0, least(size, words - first)) + greatest(0, least(size, words - source_size - first)))::bigint as taken
from placed"""

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP4 = f"""
with w as (select doc_id, {_WORDS.format("coalesce(text, '')")} as ws from documents),
starts as (select doc_id, ws, unnest(range(1, len(ws) - 18)) as i from w where len(ws) >= 20),
keyed as (select doc_id, i, array_to_string(ws[i:i + 19], ' ') as k from starts),
firsts as (select k, min((doc_id, i)) as first from keyed group by 1),
later as (select doc_id, i from keyed join firsts using (k) where (doc_id, i) <> first),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as pos from later),
each as (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as pos from w),
kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by pos) as text
  from each where not exists (select 1 from gone g where g.doc_id = each.doc_id and g.pos = each.pos) group by 1)
select w.doc_id, len(w.ws)::bigint as n_words, (len(w.ws) - coalesce(kept.n, 0))::bigint as n_removed,
       sha256(coalesce(kept.text, '')) as kept_sha256
from w left join kept using (doc_id)"""

OP5 = f"""
with recursive w as (
  select doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as ws from documents),
s as (
  select distinct doc_id, k from (
    select doc_id, array_to_string(ws[i:i + 4], ' ') as k from (select doc_id, ws, unnest(range(1, len(ws) - 3)) as i from w where len(ws) >= 5)
    union all
    select doc_id, len(ws) || ' ' || array_to_string(ws, ' ') from w where len(ws) between 1 and 4)),
n as (select w.doc_id, count(s.k) as n from w left join s using (doc_id) group by 1),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.k = b.k and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
twoway as (select a, b from links union all select b, a from links),
reach as (select doc_id, doc_id as other from n union select reach.doc_id, twoway.b from reach join twoway on twoway.a = reach.other)
select n.doc_id, n.n as n_shingles, min(reach.other) as component_id from n join reach using (doc_id) group by 1, 2"""

OP9 = r"""
with l as (
  select doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
bad as (
  select trim(line, ' ') as key from l where regexp_matches(line, '[^\x20\x09-\x0D]')
  group by 1 having count(distinct coalesce('=' || source, 'null')) >= 10),
marked as (select l.*, bad.key is not null and regexp_matches(line, '[^\x20\x09-\x0D]') as gone from l left join bad on bad.key = trim(line, ' '))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_removed,
       coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '') as text
from marked group by 1"""

ORACLES: dict[str, str] = {
    "op3_mixing_schedule": OP3,
    "op4_count_min_substrings": OP4,
    "op5_adaptive_prefix_join": OP5,
    "op9_site_spread_lines": OP9,
}

"""DuckDB SQL of the queries that SQL can express, over the same whole tables."""

from __future__ import annotations

_HOST = r"nullif(lower(regexp_extract({0}, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)', 1)), '')"
_DOMAIN = r"coalesce(nullif(lower(regexp_replace(domain, '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g')), ''), " + _HOST.format("url") + ")"

_P1 = f"""
with items as (
  select 'url' as attr, url as item from crawl_records
  union all
  select 'domain' as attr, {_DOMAIN} as item from crawl_records
), counts as (
  select attr, item, count(*) as n from items where item is not null group by attr, item
), shares as (
  select *, sum(n) over (partition by attr)::bigint as total from counts
)
select @columns from shares where n * case attr when 'url' then 200 else 100 end >= total
"""

_P3 = """
with known as (select distinct seen_key as key from seen_keys where seen_key is not null),
elements as (
  select request_id, unnest(elements) as key, unnest(range(len(elements))) as pos from check_requests
), events as (
  select 'crawl_records' as tbl, record_id as id, 0::bigint as pos, url as key from crawl_records where url is not null
  union all
  select 'check_requests', request_id, pos::bigint, key from elements where key is not null
), firsts as (
  select tbl, key, min((id, pos)) as first from events group by tbl, key
)
"""
_P3_SEEN = """
select e.tbl, e.id, e.pos from events e join firsts f on e.tbl = f.tbl and e.key = f.key
where (e.id, e.pos) > f.first or e.key in (select key from known)
"""
_P3_COUNTS = """
select e.tbl as stream, count(*) as asked, count_if((e.id, e.pos) > f.first or e.key in (select key from known))::bigint as seen, true as in_bound
from events e join firsts f on e.tbl = f.tbl and e.key = f.key group by e.tbl
"""

_P4_CUTS = f"""
with valid as (
  select distinct pred_id, coalesce({_DOMAIN}, '') as domain, prob from predictions
  where pred_id is not null and not isnan(prob) and prob between 0 and 1.0001
), sized as (
  select v.*, count(*) over (partition by v.domain) as n from valid v
), aimed as (
  select s.*, (coalesce(t.keep_pct, d.keep_pct, 0) * n + 99) // 100 as target
  from sized s left join (select * from keep_targets where domain <> '*') t on t.domain = s.domain
  left join (select * from keep_targets where domain = '*') d on true
), placed as (
  select *, row_number() over (partition by domain order by prob desc, pred_id) as place from aimed
), cuts as (
  select domain, n, target::bigint as target, min(prob) filter (place <= target) as cutoff from placed group by domain, n, target
)
"""

_BLANK = r"[\x09\x0B-\x0D \x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_LINES = f"""
with docs as (
  select doc_id, text, fetched_at::date as day, case when url is null then source else regexp_replace({_HOST.format("url")}, '^(?:www\\.|m\\.)', '') end as site from documents
), raw as (
  select doc_id, site, day, text, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as line_no
  from docs where text is not null and site is not null
), lines as (
  select doc_id, site, line_no, day, text, regexp_replace(trim(regexp_replace(lower(line), '{_BLANK}+', ' ', 'g')), '[0-9]+', '0', 'g') as line from raw
), found as (
  select doc_id, line_no from lines
  where line <> '' and (site, line) in (select (site, line) from lines where line <> '' group by site, line having count(distinct doc_id) >= 5)
)
"""

_COUNTED = """
, counted as (
  select site, line, count(distinct doc_id) as docs, count(distinct text) as clusters, count(distinct day) as days
  from lines where line <> '' group by site, line having count(distinct doc_id) >= 5
)
"""

_P9 = r"""
with texts as (
  select 'd' as kind, doc_id as id, list_transform(regexp_extract_all(text, '[\pL\pN]+'), lambda w: lower(w)) as w from documents where text is not null
  union all
  select 'i', item_id, list_transform(regexp_extract_all(text, '[\pL\pN]+'), lambda w: lower(w)) from benchmark where text is not null
), grams as (
  select distinct kind, id, array_to_string(list_slice(w, i, i + 11), ' ') as gram from (select kind, id, w, unnest(range(1, len(w) - 10)) as i from texts where len(w) >= 12)
), found as (
  select distinct d.id as doc_id, i.id as item_id from grams d join grams i on d.gram = i.gram where d.kind = 'd' and i.kind = 'i'
)
"""
# white space, then what may stand behind the stop of a line
_SPACE = r"\t-\r\x1C-\x20\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_CLOSING = r" \t\r\x0B\x0C\x{00A0}\"''”»)\]"
_P7_SUMS = f"""
with cut as (select doc_id, text, string_split(text, chr(10)) as ls from documents where text is not null)
select doc_id, length(text) as chars, len(regexp_extract_all(text, '[^\\pL\\pN{_SPACE}]')) as symbols,
  len(list_filter(ls, lambda x: regexp_matches(x, '[^{_CLOSING}]'))) as lines, len(list_filter(ls, lambda x: regexp_matches(x, '[.!?。！？…][{_CLOSING}]*$'))) as ended_lines
from cut
"""

SQL: dict[str, str] = {
    "p1_found": _P1.replace("@columns", "attr, item"),
    "p1_counts": _P1.replace("@columns", "attr, item, n, total"),
    "p3_found": _P3 + _P3_SEEN,
    "p3_counts": _P3 + _P3_COUNTS,
    "p4_found": _P4_CUTS + "select distinct v.pred_id from valid v join cuts c on v.domain = c.domain where v.prob >= c.cutoff",
    "p4_cutoffs": _P4_CUTS
    + "select c.domain, c.n, c.target, c.cutoff, count(v.prob) as kept from cuts c left join valid v on v.domain = c.domain and v.prob >= c.cutoff group by c.domain, c.n, c.target, c.cutoff",
    "p5_found": _LINES + "select * from found",
    "p5_lines": _LINES + _COUNTED + "select * from counted",
    "p5_boilerplate": _LINES + _COUNTED + "select doc_id, line_no from lines join counted using (site, line) where clusters >= 5 and days >= 2",
    "p5_clean": _LINES
    + """
, kept as (
  select r.doc_id, string_agg(r.line, chr(10) order by r.line_no) as text from raw r
  where not exists (select 1 from found f where f.doc_id = r.doc_id and f.line_no = r.line_no) group by r.doc_id
)
select d.doc_id, case when d.text is null or d.site is null then d.text else coalesce(k.text, '') end as text from docs d left join kept k using (doc_id)
""",
    "p7_sums": _P7_SUMS,
    "p9_found": _P9 + "select * from found",
    "p9_items": _P9 + "select item_id, count(*) as docs from found group by item_id",
    "p8_decoded": "select doc_id, coalesce(text, '') as text from documents",
}

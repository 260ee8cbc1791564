"""SQL for the queries that SQL can express on whole tables. The others are tested against brute force."""

_LINES = (
    "l as (select id, source_id, unnest(range(1, len(s) + 1)) as line_no, unnest(s) as raw from (select id, source_id, string_split(raw_markdown, chr(10)) as s from articles where raw_markdown is not null and source_id is not null)),"
    " k as (select id, source_id, line_no, trim(regexp_replace(raw, '[ \\t\\r]+', ' ', 'g')) as line from l),"
    " n as (select id, source_id, line_no, regexp_replace(lower(line), '[0-9]+', '0', 'g') as normal from k where length(line) >= 20)"
)

_WINDOWS = "w as (select doc_id, p::int as p, md5(substr(text, p, 200)) as h from (select doc_id, text, unnest(range(1, length(text) - 198)) as p from documents where length(text) >= 200)), k as (select h from w group by h having count(distinct doc_id) > 1)"

ORACLES: dict[str, str] = {
    "p2_found": f"with {_LINES}, o as (select source_id, normal from n group by all having count(distinct id) >= 8) select n.id as article_id, n.line_no::int as line_no from n join o on o.source_id = n.source_id and o.normal = n.normal",
    "p2_body": f"with {_LINES}, o as (select source_id, normal from n group by all having count(distinct id) >= 8), bad as (select n.id, n.line_no from n join o on o.source_id = n.source_id and o.normal = n.normal),"
    " kept as (select l.id, string_agg(l.raw, chr(10) order by l.line_no) as body from l where not exists (select 1 from bad where bad.id = l.id and bad.line_no = l.line_no) group by 1)"
    " select a.id as article_id, case when a.raw_markdown is null then null else coalesce(k.body, case when a.source_id is null then a.raw_markdown else '' end) end as body from articles a left join kept k on k.id = a.id",
    "p2_rebuilt": f"with {_LINES}, y as (select id, coalesce(year(created_at), 0) as y from articles), m as (select max(y) as y from y),"
    " c as (select source_id, normal, count(distinct id) as n, count(distinct id) filter (where y.y < m.y) as old from n join y using (id) cross join m group by all),"
    " o as (select source_id, normal, old < 8 as crossed from c where n >= 8), bad as (select n.id, n.line_no, o.crossed from n join o on o.source_id = n.source_id and o.normal = n.normal),"
    " changed as (select bad.id from bad join y using (id) cross join m group by bad.id having bool_or(bad.crossed or y.y = m.y))"
    " select l.id as article_id, coalesce(string_agg(l.raw, chr(10) order by l.line_no) filter (where not exists (select 1 from bad where bad.id = l.id and bad.line_no = l.line_no)), '') as body from l join changed using (id) group by 1",
    "p9_found": f"with {_WINDOWS}, r as (select distinct doc_id, h from w join k using (h)) select distinct a.doc_id as doc_id_a, b.doc_id as doc_id_b from r a join r b on a.h = b.h and a.doc_id < b.doc_id",
    "p9_shared": f"with {_WINDOWS}, r as (select doc_id, p, lead(p) over (partition by doc_id order by p) as following from w join k using (h)), c as (select doc_id, sum(least(200, coalesce(following - p, 200)))::bigint as n from r group by 1)"
    " select d.doc_id, length(text)::bigint as chars, coalesce(c.n, 0) as shared_chars, case when length(text) > 0 then round(coalesce(c.n, 0) / length(text), 6) else 0.0 end as shared_share from documents d left join c using (doc_id)",
    "p9_places": f"with {_WINDOWS}, r as (select doc_id, p, case when p > coalesce(lag(p) over (partition by doc_id order by p), -1000) + 200 then 1 else 0 end as new from w join k using (h)), g as (select *, sum(new) over (partition by doc_id order by p) as region from r)"
    " select doc_id, min(p)::int as start, (max(p) - min(p) + 200)::int as length from g group by doc_id, region",
    "p8_sources": "select source, count(*) as records, count(*) filter (where coalesce(text, '') <> '') as with_text, sum(length(text))::bigint as chars from documents where source in (select source from mixture_targets) group by 1",
}

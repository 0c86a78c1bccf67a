"""DuckDB SQL of the queries that SQL can express; meant for small tables."""

SQL = {}

SQL["op1_warc_dictionary"] = """
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), r as (
  select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as least from p
)
select page_id, payload_bytes, payload_digest,
  case when least <> page_id then 'revisit' else 'response' end as record_type,
  case when least <> page_id then least end as refers_to
from r
"""

SQL["op3_url_redirects"] = r"""
with recursive base as (
  select page_id, url, html,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), judged as (
  select *, case
    when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/en/1') then 'example.org/en/1'
    when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/es/') then 'example.org/es/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/fr/') then 'com/fr/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/de/') then 'com/de/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/') then 'org/'
    end as rule
  from base
), links as (
  select url, url as target from judged where contains(url, '://')
  union all
  select url, case when starts_with(found, '/') and not starts_with(found, '//') then 'http://' || host || found
                   when contains(found, '://') then found end as target
  from (
    select url, host, unnest([
      regexp_extract(html, '(?i)<link[^>]*rel=["'']canonical["''][^>]*href=["'']([^"'']+)["'']', 1),
      regexp_extract(html, '(?i)<meta[^>]*http-equiv=["'']refresh["''][^>]*content=["''][^"'';]*;\s*url=([^"'']+)["'']', 1)
    ]) as found
    from judged where contains(url, '://')
  )
), edges as (
  select distinct url as a, 'canonical ' ||
    regexp_replace(translate(regexp_extract(target, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^www\.', '') ||
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      regexp_extract(target, '://[^/?#]*([^#]*)', 1),
      '([?&])(utm_[a-z]*|ref)=[^&]*', '\1', 'g'), '&&+', '&', 'g'), '\?&+', '?', 'g'), '[?&]+$', '', 'g'), '/+(\?|$)', '\1', 'g') as b
  from links where target is not null
), links_both_ways as (
  select a, b from edges union select b, a from edges
), reach as (
  select a, a as b from links_both_ways
  union
  select r.a, n.b from reach r join links_both_ways n on r.b = n.a
), said as (
  select r.a as url, min(case when j.rule in ('org/', 'com/fr/') then 'allow' else 'block' end) as verdict
  from reach r join judged j on j.url = r.b
  where j.rule is not null
  group by r.a
)
select j.page_id, j.host, j.path, j.rule,
  case when j.rule is not null then case when j.rule in ('org/', 'com/fr/') then 'allow' else 'block' end
       else coalesce(s.verdict, 'allow') end as verdict
from judged j left join said s on s.url = j.url
"""

SQL["op4_line_dedup"] = r"""
with lines as (
  select doc_id, unnest(list) as line, generate_subscripts(list, 1) - 1 as place
  from (select doc_id, string_split(text, chr(10)) as list from documents where text is not null)
), worded as (
  select doc_id, place, line, doc_id * 10000000 + place as spot,
    list_filter(string_split_regex(line, '[ \t\r\x0b\x0c]+'), lambda x: x <> '') as words
  from lines
), keyed as (
  select *, len(words) as n, array_to_string(words, ' ') as code from worded
), firsts as (
  select code, any_value(words) as words, any_value(n) as n, min(spot) as spot from keyed where n > 0 group by code
), variants as (
  select spot, n, i as cut, array_to_string(list_concat(words[1:i - 1], words[i + 1:]), ' ') as rest
  from (select *, unnest(range(1, n + 1)) as i from firsts where n >= 5)
), replaced as (
  select spot from (select spot, min(spot) over (partition by rest, cut, n) as low from variants) where low < spot
), added as (
  select greatest(v.spot, f.spot) as spot from variants v join firsts f on f.code = v.rest and f.n = v.n - 1
), gone as (
  select spot from replaced union select spot from added
), kept as (
  select k.doc_id, string_agg(k.line, chr(10) order by k.place) as text
  from keyed k left join firsts f on f.code = k.code and k.n > 0
  where k.n = 0 or (f.spot = k.spot and k.spot not in (select spot from gone))
  group by k.doc_id
)
select d.doc_id, case when d.text is null then null else coalesce(k.text, '') end as text
from documents d left join kept k using (doc_id)
"""

SQL["op5_suffix_dedup"] = r"""
with w as (
  select doc_id, list_filter(string_split_regex(text, '[ \t\n\r\x0b\x0c]+'), lambda x: x <> '') as words
  from documents where doc_id is not null
), windows as (
  select doc_id, i - 1 as pos, md5(array_to_string(words[i:i + 49], ' ')) as code
  from (select *, unnest(range(1, len(words) - 48)) as i from w where len(words) >= 50)
), held as (
  select code, min(doc_id) as low from windows group by code having min(doc_id) <> max(doc_id)
), starts as (
  select distinct doc_id, pos, low <> doc_id as late from windows join held using (code)
), marked as (
  select *, case when pos <= lag(pos) over (partition by doc_id order by pos) + 50 then 0 else 1 end as fresh from starts
), grouped as (
  select *, sum(fresh) over (partition by doc_id order by pos) as island from marked
), ranges as (
  select doc_id, island, min(pos) as first_word, max(pos) + 50 as end_word from grouped group by doc_id, island
), late as (
  select doc_id, island, count(distinct p) as n
  from (select doc_id, island, unnest(range(pos, pos + 50)) as p from grouped where late)
  group by doc_id, island
)
select r.doc_id, cast(r.first_word as int) as first_word, cast(r.end_word as int) as end_word,
  cast(coalesce(l.n, 0) as bigint) as later_words
from ranges r left join late l using (doc_id, island)
"""

SQL["op7_jaccard_join"] = r"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\r\x0b\x0c]+'), lambda x: x <> '') as words
  from documents where doc_id is not null
), shingles as (
  select distinct doc_id, array_to_string(words[i:i + 4], ' ') as s
  from (select *, unnest(range(1, greatest(len(words) - 3, 2))) as i from w where len(words) > 0)
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select x.doc_id as a, y.doc_id as b, count(*) as n_shared
  from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id group by all
), links as (
  select a, b from shared join sizes p on p.doc_id = a join sizes q on q.doc_id = b
  where 5 * n_shared >= 4 * (p.n + q.n - n_shared)
), reach as (
  select a, b from links
  union
  select r.a, l.b from reach r join links l on r.b = l.a
), classes as (
  select a, min(b) as low from reach group by a
), counted as (
  select a, count(*) as n from links group by a
)
select w.doc_id, least(w.doc_id, coalesce(c.low, w.doc_id)) as class_id, cast(coalesce(k.n, 0) as bigint) as n_links
from w left join classes c on c.a = w.doc_id left join counted k on k.a = w.doc_id
"""

SQL["op13_fill_in_middle"] = r"""
with d as (
  select doc_id, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as u,
         sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h
  from documents),
k as (
  select *, len(u) as n, cast('0x' || h[1:8] as bigint) % (len(u) + 1) as x,
         cast('0x' || h[9:16] as bigint) % (len(u) + 1) as y, cast('0x' || h[25:32] as bigint) % 100 < 50 as spm,
         t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') as plain
  from d),
c as (
  select *, array_to_string(u[1:least(x, y)], '') as p, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') as m,
         array_to_string(u[greatest(x, y) + 1:], '') as s
  from k)
select doc_id, n, case when plain then 'plain' when spm then 'spm' else 'psm' end as form,
       case when not plain then length(p) end as prefix_chars, case when not plain then length(m) end as middle_chars,
       sha256(case when plain then t when spm then '<S>' || s || '<P>' || p || '<M>' || m
                   else '<P>' || p || '<S>' || s || '<M>' || m end) as output_sha256,
       sha256(t) as restored_sha256
from c
"""

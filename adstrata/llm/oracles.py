"""DuckDB SQL for those of these queries that SQL expresses."""

from __future__ import annotations

_SQL: dict[str, str] = {
    "op6_source_mixing": r"""
with numbered as (
  select doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) size,
    cast('0x' || left(md5(concat_ws('|', 'mix', cast(doc_id as varchar), md5(text))), 15) as bigint) place
  from documents),
placed as (select *, place % 4096 slice from numbered),
sources as (
  select source, cast(sum(size) as bigint) source_size, [5.0, 2.0, 1.0][(row_number() over (order by source nulls last) - 1) % 3 + 1]::double weight,
    3 * sum(size)::double cap
  from placed group by source),
filled as (  -- those up to each source, by how soon they are full, are full; the others share the rest by weight
  select *, (sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight, source rows between unbounded preceding and 1 preceding), 0))::double
    / sum(weight) over (order by cap / weight, source rows between current row and unbounded following) rate,
    row_number() over (order by cap / weight, source) k
  from sources),
targets as (
  select source, source_size, least(cap, weight * (select rate from filled where cap > weight * rate order by k limit 1)) target
  from sources),
plan as (select *, case when source_size > 0 then floor(target / source_size) else 0 end whole, target - whole * source_size rest from targets),
slices as (
  select source, slice, sum(sum(size)) over (partition by source order by slice) - sum(size) "before"
  from placed group by source, slice),
ends as (
  select p.source, max(s.slice) "end", max(s."before") "before" from slices s join plan p on s.source is not distinct from p.source
  where s."before" < p.rest group by p.source),
joined as (
  select d.*, p.source_size, p.target, p.whole, p.rest, e."end", e."before",
    sum(d.size) over (partition by d.source, d.slice order by d.place rows unbounded preceding) - d.size / 2.0 upto
  from placed d join plan p on d.source is not distinct from p.source left join ends e on d.source is not distinct from e.source)
select doc_id, size, source_size, target, cast(size * least(3, whole + case when "end" is null or slice > "end" then 0 when slice < "end" then 1
  when "before" + upto < rest then 1 else 0 end) as bigint) taken
from joined""",
    "op7_ngram_jaccard_join": r"""
with recursive words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') w
  from documents),
sets as (
  select doc_id, case when len(w) = 0 then cast([] as varchar[]) when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end s
  from words),
shingles as (select doc_id, len(s) n, unnest(s) x from sets),
links as (
  select a.doc_id a, b.doc_id b from shingles a join shingles b on a.x = b.x and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached as (select a, b from links union select r.a, l.b from reached r join links l on r.b = l.a)
select doc_id, len(s) n_shingles, least(doc_id, (select min(b) from reached where a = doc_id)) component_id
from sets""",
    "op8_url_filter": r"""
with parts as (
  select page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path,
    regexp_replace(regexp_replace(coalesce(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), ''), '(^|&)(utm_[a-z]+|gclid|fbclid|ref)=[^&]*', '', 'g'), '^&', '') query
  from pages),
named as (
  select *, case when host <> '' then regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/$', '')
    || case when query <> '' then '?' || query else '' end end canonical
  from parts),
ruled as (
  select *, case when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/en/1') then 'example.org/en/1'
    when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/es/') then 'example.org/es/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/fr/') then 'com/fr/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/de/') then 'com/de/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/') then 'org/' end "rule"
  from named)
select page_id, host, path, "rule", case when "rule" in ('org/', 'com/fr/') then 'allow' when "rule" is not null then 'block'
  when canonical in (select canonical from named where canonical is not null and regexp_matches(host, '(^|[.-])(casino|bets|pills)([.-]|$)')) then 'block'
  else 'allow' end verdict
from ruled""",
    "op11_hard_negatives": """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end l,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
positives as (
  select a.vec_id anchor_id, a.l, a.v, p.vec_id positive_id, cast(list_inner_product(a.v, p.v) as bigint) positive_score
  from vectors a join vectors p on a.l = p.l and a.vec_id <> p.vec_id
  where a.vec_id % 100 = 0
  qualify row_number() over (partition by a.vec_id order by positive_score desc, p.vec_id) <= 5),
negatives as (
  select a.vec_id anchor_id, n.vec_id negative_id, cast(list_inner_product(a.v, n.v) as bigint) negative_score
  from vectors a join vectors n on a.l <> n.l
  where a.vec_id % 100 = 0)
select anchor_id, positive_id,
  cast(row_number() over (partition by anchor_id, positive_id order by negative_score desc, negative_id) as integer) "rank",
  negative_id, positive_score, negative_score
from positives join negatives using (anchor_id)
where 80 * positive_score <= 100 * negative_score and 100 * negative_score <= 100 * positive_score
qualify "rank" <= 5""",
}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)

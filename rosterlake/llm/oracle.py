"""DuckDB twins of the corpus queries that SQL can express."""

ORACLE = {}

ORACLE["op2_source_mix"] = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    md5(concat_ws(':', '20240315', doc_id::varchar)) as h
  from documents),
classed as (select *, length(bin(size)) as bits, substr(h, 1, 2) as block from sized),
placed as (
  select doc_id, source, size,
    row_number() over (partition by source
      order by 16 * bits + (size >> greatest(bits - 4, 0)), block, size, h, doc_id) as place
  from classed),
sources as (
  select source, sum(size)::bigint as source_size,
    case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0 when 1 then 2.0 else 1.0 end::double as w,
    (3 * sum(size))::double as cap
  from sized group by source),
leveled as (
  select *, (sum(source_size) over ()::double - coalesce(sum(cap) over (order by cap / w, source nulls last
      rows between unbounded preceding and 1 preceding), 0))
    / sum(w) over (order by cap / w, source nulls last rows between current row and unbounded following) as level
  from sources),
shared as (select min_by(level, cap / w) as shared from leveled where w * level < cap),
rated as (
  select source, source_size, least(cap, coalesce(w * shared, cap)) as target,
    ('0x' || substr(md5(concat_ws(':', 'offset-20240315', source)), 1, 5))::bigint::double / 1048576 as u
  from leveled cross join shared),
counted as (
  select doc_id, size, source_size, target,
    coalesce(target / nullif(source_size, 0), 0) as rate, place, u
  from placed join rated on placed.source is not distinct from rated.source)
select doc_id, size, source_size, target,
  least(floor(place * rate + u) - floor((place - 1) * rate + u), 3)::bigint as copies,
  least(floor(place * rate + u) - floor((place - 1) * rate + u), 3)::bigint * size as taken
from counted
"""

ORACLE["op9_near_duplicates"] = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
sets as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] end) as s
  from words),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from sets a join sets b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c >= 75 * (x.n + y.n - c)),
sym as (select a, b from links union all select b, a from links),
reach as (
  select doc_id as a, doc_id as r from documents
  union
  select sym.b, reach.r from reach join sym on sym.a = reach.a)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept
from documents left join sizes using (doc_id)
join (select a as doc_id, min(r) as component_id from reach group by a) using (doc_id)
"""

ORACLE["op10_warc_archives"] = r"""
with payloads as (
  select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as h
  from pages),
firsts as (select html, min(page_id) as first from payloads group by html)
select page_id, payload_bytes::bigint as payload_bytes,
  translate(
    lpad(to_base(('0x' || substr(h, 1, 10))::bigint, 32), 8, '0') || lpad(to_base(('0x' || substr(h, 11, 10))::bigint, 32), 8, '0')
      || lpad(to_base(('0x' || substr(h, 21, 10))::bigint, 32), 8, '0') || lpad(to_base(('0x' || substr(h, 31, 10))::bigint, 32), 8, '0'),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from payloads join firsts using (html)
"""

ORACLE["op11_conversation_trie"] = r"""
with said as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first,
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as place,
    coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null),
drawn as (
  select conv_id, xor(list_reduce(
      list_prepend(4294967295::bigint, [ord(c)::bigint for c in string_split(conv_id::varchar, '')]),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295::bigint) % 9 as h
  from (select distinct conv_id from said)),
rebuilt as (
  select d.conv_id, 0 as part, s.place, s.role, s.text
  from drawn d join said s on s.conv_id = d.conv_id - d.conv_id % 5 and s.place <= d.h
  union all
  select d.conv_id, 1, s.place, s.role, s.text from drawn d join said s on s.conv_id = d.conv_id and s.place > d.h),
path as (
  select conv_id, row_number() over (partition by conv_id order by part, place) as depth,
    {'r': role, 't': text} as turn from rebuilt),
whole as (
  select d.conv_id, coalesce(list(turn order by depth) filter (turn is not null), []) as turns
  from drawn d left join path using (conv_id) group by d.conv_id),
members as (
  select conv_id, unnest(range(len(turns) + 1)) as depth, turns from whole),
keyed as (
  select conv_id, depth, md5(turns[1:depth]::varchar) as node, md5(turns[1:depth - 1]::varchar) as parent,
    case when depth > 0 then strlen(turns[depth].t) else 0 end as bytes, len(turns) = depth as ended
  from members),
nodes as (
  select depth, node, any_value(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs, any_value(bytes) as bytes,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ended), '')) as ends_sha256
  from keyed group by depth, node),
children as (select depth - 1 as depth, parent as node, count(*) as n from nodes where depth > 0 group by all),
below as (
  select distinct a.depth, a.node, b.depth as low_depth, b.node as low
  from keyed a join keyed b on a.conv_id = b.conv_id and a.depth <= b.depth),
sums as (
  select below.depth, below.node, count(*) filter (children.n is null) as n_leaves,
    sum((low.n_convs - 1) * low.bytes) as saved_tokens
  from below join nodes low on low.depth = low_depth and low.node = below.low
  left join children on children.depth = low_depth and children.node = below.low
  group by all)
select x.conv_id, x.depth::bigint as depth, p.conv_id as parent_conv_id, x.n_convs::bigint as n_convs,
  coalesce(c.n, 0)::bigint as n_children, n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, x.ends_sha256
from nodes x join sums s on s.depth = x.depth and s.node = x.node
left join children c on c.depth = x.depth and c.node = x.node
left join nodes p on p.depth = x.depth - 1 and p.node = x.parent and x.depth > 0
"""

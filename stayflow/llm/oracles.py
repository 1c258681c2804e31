"""The text queries that DuckDB can run, as SQL over the same tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_SPACED = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op1_mix_sources"] = rf"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{_SPACED}')), 0)::bigint as size, text,
    md5('mix:' || coalesce(doc_id::varchar, '')) as mix_key from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end::bigint as weight,
  sum(source_size) over ()::bigint as words from s),
f as (select *,
  coalesce(sum(source_size) over (order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding), 0)::bigint as held,
  sum(weight) over (order by source_size / weight, source nulls last rows between current row and unbounded following)::bigint as rest_weight from w),
r as (select *, 150 * words - 200 * held as rest from f),
o as (select rest, rest_weight from r where not weight * rest::double > 200.0 * source_size * rest_weight order by source_size / weight, source nulls last limit 1),
t as (select source, source_size, case when o.rest is null then source_size * 2.0::double
    else least(source_size * 2.0::double, (weight * o.rest)::double / (100 * o.rest_weight)::double) end as target
  from r left join o on true),
p as (select d.doc_id, d.size, t.source_size, t.target,
    case when t.source_size > 0 then floor(t.target / t.source_size) else 0 end::bigint as rounds,
    coalesce(sum(d.size) over (partition by d.source order by mix_key, d.doc_id nulls first, d.size, d.text rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
  (rounds * size + greatest(0, least(size, floor(target)::bigint - rounds * source_size - start)))::bigint as taken from p
"""

ORACLES["op2_decontaminate"] = r"""
with dw as (select doc_id, row_number() over () as rid, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
bw as (select coalesce(item_id::varchar, '') as item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where text is not null),
bn as (select item, w, least(len(w), 13) as n from bw where len(w) > 0),
win as (select distinct item, n, array_to_string(w[i:i + n - 1], ' ') as key from (select item, w, n, unnest(range(1, len(w) - n + 2)) as i from bn)),
ns as (select distinct n from win),
occ as (select rid, i, n, array_to_string(w[i:i + n - 1], ' ') as key from (select rid, w, n, unnest(range(1, len(w) - n + 2)) as i from dw, ns)),
met as (select occ.rid, occ.i, occ.n, win.item from occ join win on occ.n = win.n and occ.key = win.key),
hit as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + n)) as p from met) group by rid),
its as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct rid, item from met) group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from dw left join hit using (rid) left join its using (rid)
"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = " || ".join(f"substr('{_BASE32}', ((('0x' || substr(h, {1 + 10 * g}, 10))::bigint >> {35 - 5 * n}) & 31)::int + 1, 1)" for g in range(4) for n in range(8))
ORACLES["op3_warc"] = f"""
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
f as (select h, max(page_id) as first from p group by h)
select page_id, octet_length(encode(html))::bigint as payload_bytes, {_DIGITS} as payload_digest,
  case when page_id is not distinct from first then 'response' else 'revisit' end as record_type,
  case when page_id is distinct from first then first end as refers_to
from p join f using (h)
"""

_OPENING = "case when role = 'assistant' then '<s>' else '[INST]' end"
_CLOSING = "case when role = 'assistant' then '</s>' else '[/INST]' end"
ORACLES["op4_format_chat"] = rf"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f as (select *, length({_OPENING}) + length(replace(replace(role, '\', '\\'), chr(10), '\n')) + 1
  + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) + length({_CLOSING}) as chars from c)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(chars)::bigint as formatted_chars
from f group by conv_id
"""

ORACLES["op7_quality_rules"] = rf"""
with d as (select row_number() over () as rid, doc_id, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{_SPACED}') as w from documents),
l as (select rid, doc_id, source, text, line, lower(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')) as normal from (select rid, doc_id, source, text, unnest(string_split(text, chr(10))) as line from d) where regexp_matches(line, '{_SPACED}')),
hs as (select source, count(*) as n from documents group by source),
fl as (select f.source, f.normal from (select source, normal, count(distinct (doc_id, text)) as n from l group by source, normal) f join hs on hs.source is not distinct from f.source where f.n > 50 and f.n > 0.001 * hs.n),
lost as (select rid, sum(length(line)) as lost from l join fl on l.source is not distinct from fl.source and l.normal = fl.normal group by rid),
dup as (select rid, count(*) - count(distinct line) as n from l group by rid),
win as (select rid, i, w[i:i + 2] as k from (select rid, w, unnest(range(1, len(w) - 1)) as i from d)),
again as (select rid, i from (select *, count(*) over (partition by rid, k) as c from win) where c > 1),
rep as (select rid, count(distinct p) as n from (select rid, unnest([i, i + 1, i + 2]) as p from again) group by rid),
m as (select d.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint as n_symbols, coalesce(dup.n, 0)::bigint as n_dup_lines,
    coalesce(rep.n, 0)::bigint as n_repeat_words, coalesce(lost.lost, 0) as lost, length(text) as n_chars
  from d left join dup using (rid) left join rep using (rid) left join lost using (rid))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and not 100 * lost > 50 * n_chars as kept
from m
"""

ORACLES["op11_turn_repair"] = r"""
with recursive damaged as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ascii(c)::bigint)),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda v, i: case when v % 2 = 1 then xor(v // 2, 3988292384::bigint) else v // 2 end)), 4294967295::bigint) % 20 as fault
    from conversations
), rows as (
    select conv_id, turn, case when fault = 4 then 'user' else role end as role,
        case when fault = 1 then '' when fault = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
        unnest(range(case when fault = 3 then 2 else 1 end)) as copy
    from damaged where fault <> 0
), numbered as (
    select *, row_number() over () as rid from rows
), placed as (
    select *, row_number() over w as k, row_number() over (partition by conv_id, role, text order by turn nulls first, rid) as said,
        lag(left(role, 1)) over w as before, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare
    from numbered window w as (partition by conv_id order by turn nulls first, role, text, rid)
), marked as (
    select *, left(role, 1) as initial, bare = '' as blank, bare <> '' and said > 1 as duplicate,
        bare <> '' and said = 1 and right(bare, 1) not in ('.', '!', '?') as truncated
    from placed
), report as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) as n,
        count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate, count(*) filter (truncated) as truncated,
        count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
    from marked group by conv_id
), closure(p, put, said, here) as (
    -- pattern states 0 start, 1 system, 2 user, 3 assistant; insertions in front of a row
    values (0, '', [], 0), (0, 'I', ['user:'], 2), (0, 'II', ['user:', 'assistant:'], 3), (1, '', [], 1), (1, 'I', ['user:'], 2), (1, 'II', ['user:', 'assistant:'], 3),
        (2, '', [], 2), (2, 'I', ['assistant:'], 3), (2, 'II', ['assistant:', 'user:'], 2), (3, '', [], 3), (3, 'I', ['user:'], 2), (3, 'II', ['user:', 'assistant:'], 3)
), steps(p, q, edit, initial, put, said, paid) as (
    select p, p, 'D', null, '', [], 4 from (values (0), (1), (2), (3)) t(p)
    union all select p, case when here = 2 then 3 else 2 end, 'R', null, put, said, 3 * length(put) + 3 from closure
    union all select p, case when here = 2 then 3 else 2 end, 'K', case when here = 2 then 'a' else 'u' end, put, said, 3 * length(put) from closure
    union all select p, 1, 'K', 's', put, said, 3 * length(put) from closure where here = 0
), parsed(conv_id, k, state, cost, audit, repaired) as (
    select conv_id, 0::bigint, 0, 0::bigint, '', []::varchar[] from report
    union all
    select conv_id, k, state, cost, audit, repaired from (
        select a.conv_id, a.k + 1 as k, s.q as state, a.cost + s.paid + case when m.truncated and s.edit <> 'D' then 3 else 0 end as cost, a.audit || s.put || s.edit as audit,
            a.repaired || s.said || case s.edit when 'K' then [m.role || ':' || m.text] when 'R' then [case s.q when 2 then 'user:' else 'assistant:' end || m.text] else []::varchar[] end as repaired
        from parsed a join marked m on m.conv_id is not distinct from a.conv_id and m.k = a.k + 1
        join steps s on s.p = a.state and (s.edit = 'D' or not (m.blank or m.duplicate)) and (s.initial is null or s.initial = m.initial)
    ) qualify row_number() over (partition by conv_id, state order by cost, audit) = 1
), ended as (
    select a.conv_id, a.cost + 3 * length(c.put) as cost, a.audit || c.put as audit, a.repaired || c.said as repaired
    from parsed a join report r on r.conv_id is not distinct from a.conv_id and r.n = a.k
    join closure c on c.p = a.state and (c.here = 3 or c.here = 0)
    qualify row_number() over (partition by a.conv_id order by a.cost + 3 * length(c.put), a.audit || c.put) = 1
)
select i.conv_id, coalesce(r.gaps, 0)::bigint as gaps, coalesce(r.blank, 0)::bigint as blank, coalesce(r.duplicate, 0)::bigint as duplicate, coalesce(r.truncated, 0)::bigint as truncated,
    coalesce(r.illegal, 0)::bigint as illegal, coalesce(e.cost, 0)::bigint as cost, coalesce(e.audit, '') as audit, sha256(coalesce(array_to_string(e.repaired, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) i
left join report r on r.conv_id is not distinct from i.conv_id
left join ended e on e.conv_id is not distinct from i.conv_id
"""

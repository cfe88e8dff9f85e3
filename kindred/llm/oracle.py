"""DuckDB SQL with the rows of registered queries.

The others need a seeded XXH64, a tokenizer, a parser or a model, which DuckDB lacks; tests hold them against brute force.
"""

from __future__ import annotations

# CRC-32 of ASCII text, bit by bit: all ones, then for each byte xor and eight shifts with the reversed polynomial, then inverted
CRC = """list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(1, length({0}) + 1), lambda i: unicode(substr({0}, i, 1))::bigint)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda c, step: xor(c >> 1, (c & 1) * 3988292384))
)"""

REPAIR = f"""
with recursive keyed as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key
    from conversations
), dealt as (
    select *, xor({CRC.format("key")}, 4294967295) % 20 as fault from keyed
), turns as (
    select conv_id, turn, case when fault = 4 then 'user' else role end as role,
        case when fault = 1 then '' when fault = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
    from dealt, range(case when fault = 3 then 2 else 1 end) where fault <> 0
), numbered as (
    select *, substr(role, 1, 1) as initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body,
        row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as n
    from turns
), repeated as (
    select *, row_number() over (partition by conv_id, role, text order by n) as seen from numbered
), faulty as (
    select *, lead(initial) over (partition by conv_id order by n) as after,
        case when body = '' then 1 when seen > 1 then 2 when right(body, 1) not in ('.', '!', '?') then 3 else 0 end as first_fault
    from repeated
), sums as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (first_fault = 1) as blank,
        count(*) filter (first_fault = 2) as duplicate, count(*) filter (first_fault = 3) as truncated,
        count(*) filter (initial || after not in ('su', 'ua', 'au')) as illegal, count(*) as size
    from faulty group by conv_id
), inserts(p, q, cost, audit, said) as (
    values (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
        (0, 2, 3, 'I', ['user:']), (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 2, 3, 'I', ['user:']),
        (1, 3, 6, 'II', ['user:', 'assistant:']), (2, 3, 3, 'I', ['assistant:']), (3, 2, 3, 'I', ['user:'])
), steps(p, initial, q, name) as (
    values (0, 's', 1, null), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (2, 'a', 3, 'assistant'), (3, 'u', 2, 'user')
), edits as (
    select conv_id, n, s.p, s.q, case when first_fault = 3 then 3 else 0 end as cost, 'K' as audit, [role || ':' || text] as said
    from faulty join steps s using (initial) where first_fault not in (1, 2)
    union all
    select conv_id, n, s.p, s.q, case when first_fault = 3 then 6 else 3 end, 'R', [s.name || ':' || text]
    from faulty, steps s where first_fault not in (1, 2) and s.name is not null
    union all
    select conv_id, n, p, p, 4, 'D', [] from faulty, (values (0), (1), (2), (3)) points(p)
), paths as (
    select conv_id, 0::bigint as n, q, i.cost::bigint as cost, i.audit, i.said::varchar[] as said from sums, inserts i where i.p = 0
    union all
    select conv_id, n, q, cost, audit, said from (
        select paths.conv_id, e.n, i.q, paths.cost + e.cost + i.cost as cost, paths.audit || e.audit || i.audit as audit,
            list_concat(list_concat(paths.said, e.said), i.said)::varchar[] as said
        from paths join edits e on e.conv_id is not distinct from paths.conv_id and e.n = paths.n + 1 and e.p = paths.q
        join inserts i on i.p = e.q
    ) qualify row_number() over (partition by conv_id, q order by cost, audit) = 1
), best as (
    select paths.conv_id, paths.cost, paths.audit, said from paths join sums on sums.conv_id is not distinct from paths.conv_id and size = n
    where q in (0, 3) qualify row_number() over (partition by paths.conv_id order by cost, audit) = 1
)
select every.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
    coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.cost, 0) as cost, coalesce(audit, '') as audit,
    sha256(coalesce(array_to_string(said, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) every
left join sums on sums.conv_id is not distinct from every.conv_id
left join best on best.conv_id is not distinct from every.conv_id
"""

FIM = r"""
with cut as (
    select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(doc_id::varchar, '')) as h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as tokens
    from documents
), drawn as (
    select *, len(tokens)::bigint as n, ('0x' || substr(h, 1, 8))::bigint % (len(tokens) + 1) as c1, ('0x' || substr(h, 9, 8))::bigint % (len(tokens) + 1) as c2,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or ('0x' || substr(h, 17, 8))::bigint % 100 >= 50 then 'plain'
            when ('0x' || substr(h, 25, 8))::bigint % 100 < 80 then 'spm' else 'psm' end as form
    from cut
), parts as (
    select *, array_to_string(tokens[1:least(c1, c2)], '') as prefix, array_to_string(tokens[least(c1, c2) + 1:greatest(c1, c2)], '') as middle,
        array_to_string(tokens[greatest(c1, c2) + 1:], '') as suffix
    from drawn
)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
    sha256(text) as restored_sha256
from parts
"""

CHAT = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), escaped as (
    select *, regexp_replace(text, '(<)(\\*/?s>)|(\[)(\\*/?(?:SYS|INST|ROLE)\])', '\1\3\\\2\4', 'g') as body,
        regexp_replace(role, '(<)(\\*/?s>)|(\[)(\\*/?(?:SYS|INST|ROLE)\])', '\1\3\\\2\4', 'g') as name
    from turns
), formatted as (
    select *, case role when 'system' then '[SYS]' || body || '[/SYS]' when 'user' then '[INST]' || body || '[/INST]'
        when 'assistant' then body || '</s>' else '[ROLE]' || name || '[/ROLE]' || body || '</s>' end as formatted
    from escaped
), sums as (
    select conv_id, count(*) as n_turns, sum(length(formatted))::bigint as formatted_chars, coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
        string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, formatted) as said,
        coalesce(string_agg(text, '' order by turn nulls first, formatted) filter (role = 'assistant'), '') as learned
    from formatted group by conv_id
)
select conv_id, n_turns, sha256(said) as turns_sha256, loss_chars, sha256(learned) as loss_sha256, formatted_chars from sums
"""

ORACLE_SQL: dict[str, str] = {"op11_repair": REPAIR, "op12_fim": FIM, "op13_chat": CHAT}

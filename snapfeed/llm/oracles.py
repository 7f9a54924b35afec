"""The same questions in SQL for DuckDB, where SQL can express them."""

OP4 = r"""
with recursive docs as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') as words
    from documents
),
shingles as (
    select distinct doc_id, unnest(case when len(words) = 0 then []
        else list_transform(range(1, greatest(len(words) - 4, 1) + 1), lambda i: array_to_string(words[i:i+4], ' ')) end) as shingle
    from docs
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
links as (
    select a.doc_id as a, b.doc_id as b
    from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id
         join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
    group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 75 * (x.n + y.n - count(*))
),
both_ways as (select a, b from links union all select b, a from links),
reached as (
    select a, b from both_ways
    union
    select r.a, l.b from reached r join both_ways l on l.a = r.b
),
least_ids as (select a, min(b) as b from reached group by a)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) as component_id,
       d.doc_id = least(d.doc_id, coalesce(l.b, d.doc_id)) as kept
from docs d left join sizes s on s.doc_id = d.doc_id left join least_ids l on l.a = d.doc_id
"""

OP5 = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select * from (values (-7, 0, 'user', '\### Assistant: </turn> ok'),
                          (-7, 1, 'assistant', '\### Assistant: </turn> ok')) as t(conv_id, turn, role, text)
),
sized as (
    select *, role || chr(10) || text || chr(10) as said,
           case when role = 'assistant' then text else '' end as loss,
           length('<turn role="">' || chr(10) || '</turn>' || chr(10)) + length(role) + length(text)
           + list_sum([(length(x.s) - length(replace(x.s, x.c, ''))) // length(x.c) for x in [
               {'s': role, 'c': '\'}, {'s': role, 'c': '<turn'}, {'s': role, 'c': '</turn'}, {'s': role, 'c': '">'},
               {'s': text, 'c': '\'}, {'s': text, 'c': '<turn'}, {'s': text, 'c': '</turn'}, {'s': text, 'c': '">'}
             ]]) as chars
    from turns
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(said, '' order by turn nulls first, role, text)) as turns_sha256,
       sum(length(loss))::bigint as loss_chars,
       sha256(string_agg(loss, '' order by turn nulls first, role, text)) as loss_sha256,
       sum(chars)::bigint as formatted_chars
from sized group by conv_id
"""

OP6 = r"""
with parts as (
    select page_id, url,
           case when instr(url, '://') > 0
                then translate(regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*'),
                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                else '' end as host,
           case when instr(url, '://') > 0
                then regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1)
                else '' end as path
    from pages
),
rules(action, r_host, r_path) as (
    values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
),
judged as (
    select page_id, host, path,
           (select {'rule': r_host || r_path, 'action': action} from rules
            where (host = r_host or ends_with(host, '.' || r_host)) and starts_with(path, r_path)
            order by length(r_host) + length(r_path) desc limit 1) as best
    from parts
)
select page_id, host, path, best.rule as rule, coalesce(best.action, 'allow') as verdict from judged
"""

OP9 = r"""
with texts as (select doc_id, encode(coalesce(text, '')) as data, octet_length(encode(coalesce(text, ''))) as n_bytes from documents),
strings as (select doc_id, s, data[s:s+49] as string from texts, lateral unnest(range(1, n_bytes - 48)) as t(s)),
firsts as (select string, min(doc_id) as first_id from strings group by string having min(doc_id) < max(doc_id)),
hits as (select doc_id, s from strings join firsts using (string) where first_id < doc_id),
begun as (
    select doc_id, s, case when s - lag(s) over (partition by doc_id order by s) <= 50 then 0 else 1 end as begins from hits
),
numbered as (select doc_id, s, sum(begins) over (partition by doc_id order by s) as run from begun),
runs as (select doc_id, min(s) as a, max(s) + 49 as z from numbered group by doc_id, run),
stays as (  -- the bytes before each run, and those after the last one
    select doc_id, a as place, lag(z, 1, 0) over (partition by doc_id order by a) + 1 as low, a - 1 as high, z - a + 1 as removed from runs
    union all
    select t.doc_id, t.n_bytes + 1, coalesce(max(r.z), 0) + 1, t.n_bytes, 0
    from texts t left join runs r on r.doc_id = t.doc_id group by t.doc_id, t.n_bytes
)
select t.doc_id, t.n_bytes::bigint as n_bytes, sum(removed)::bigint as n_removed, (count(*) - 1)::bigint as n_spans,
       sha256(unhex(string_agg(case when low <= high then hex(data[low:high]) else '' end, '' order by place))) as kept_sha256
from texts t join stays s on s.doc_id = t.doc_id group by t.doc_id, t.n_bytes
"""

OP11 = r"""
with docs as (
    select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from documents where text is not null
),
totals as (select count(*) as n_docs, sum(len(terms))::bigint as all_terms from docs where len(terms) > 0),
found as (select doc_id, len(terms) as n, unnest(terms) as term from docs),
postings as (select doc_id, n, term, count(*) as tf from found group by all),
items as (
    select distinct item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
),
weights as (
    select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint as w
    from postings, totals group by term, n_docs
),
scored as (
    select item_id, doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // all_terms))))::bigint as score
    from items join postings using (term) join weights using (term), totals group by item_id, doc_id
),
ranked as (
    select item_id, row_number() over (partition by item_id order by score desc, doc_id)::integer as rank, doc_id, score
    from scored where score > 0
)
select * from ranked where rank <= 50
"""

OP12 = r"""
with recursive crc_table as (
    select list(value order by byte) as crcs from (
        select byte, list_reduce(list_prepend(byte, range(8)::bigint[]),
                                 lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) as value
        from range(256) as t(byte)
    )
),
found as (
    select doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) as run
    from documents where text is not null
),
counted as (select doc_id, run, count(*) as n from found group by all),
hashed as (
    select run, n, length(run) as len,
           xor(4294967295, list_reduce(
               list_prepend(4294967295::bigint, list_transform(
                   regexp_extract_all(hex(encode(doc_id || ':' || run)), '..'),
                   lambda b: ('0x' || b)::bigint)),
               lambda c, b: xor(crcs[(xor(c, b) & 255) + 1], c >> 8))) as h
    from counted, crc_table
),
changed as (
    select case when h % 97 = 0 then substr(run, 1, (h % len)::bigint) || substr(run, (h % len)::bigint + 2) else run end as word, n
    from hashed
),
words as (select word, sum(n)::bigint as n from changed where length(word) >= 5 group by word having sum(n) >= 3),
less as (select word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) as rest
         from words, lateral unnest(range(1, length(word) + 1)) as t(k)),
pairs as (
    select a.word, b.word as near, b.n as near_n from less a join less b on a.k = b.k and a.rest = b.rest and a.word <> b.word
    union select a.word, b.word, b.n from less a join words b on a.rest = b.word
    union select b.word, a.word, a.n from less a join words b on a.rest = b.word
),
best as (select word, count(*) as n_near, min({'less': -near_n, 'near': near}) as best from pairs group by word),
formed as (
    select w.word, w.n, coalesce(n_near, 0) as n_near,
           case when -best.less >= 2 * w.n then best.near end as form,
           case when -best.less >= 2 * w.n then -best.less end as form_n
    from words w left join best b on w.word = b.word
),
led as (
    select word, form, word as root, form as next from formed
    union all
    select led.word, led.form, f.word, f.form from led join formed f on f.word = led.next
)
select f.word, f.form, l.root, f.n, f.n_near, f.form_n from formed f join led l on l.word = f.word and l.next is null
"""

OP13 = r"""
with vectors as (
    select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
    from vectors q join vectors c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
),
ranked as (
    select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score
    from scored
)
select * from ranked where rank <= 20
"""

ORACLES = {
    "op4_neardup": OP4,
    "op5_chat": OP5,
    "op6_urls": OP6,
    "op9_repeats": OP9,
    "op11_search": OP11,
    "op12_spelling": OP12,
    "op13_topk": OP13,
}

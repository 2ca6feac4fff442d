"""The contracts of operators as DuckDB SQL, where SQL can say them; written from the contracts, not from the operators."""

OP7 = r"""
with recursive texts as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), sets as (
    select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) end as s from texts
), classes as (
    select min(doc_id) as c, s, len(s) as n from sets where len(s) > 0 group by s
), rows as (
    select c, n, unnest(s) as x from classes
), pairs as (
    select a.c as a, b.c as b from rows a join rows b on a.x = b.x and a.c < b.c and least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 75
    group by a.c, b.c, a.n, b.n having count(*) * 100 >= (a.n + b.n - count(*)) * 75
), edges as (
    select a, b from pairs union select b, a from pairs
), reach as (
    select c as id, c as r from classes union select e.b, reach.r from reach join edges e on e.a = reach.id
), found as (
    select id, min(r) as component from reach group by id
)
select sets.doc_id, cast(len(sets.s) as bigint) as n_shingles, coalesce(found.component, sets.doc_id) as component_id,
    sets.doc_id = coalesce(found.component, sets.doc_id) as kept
from sets left join classes on sets.s = classes.s left join found on found.id = classes.c
"""

OP9 = """
with recursive vectors as (
    select vec_id, cast(embedding as double[]) as v from embeddings
    where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
), edges as (
    select a.vec_id as a, b.vec_id as b from vectors a join vectors b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    where list_cosine_similarity(a.v, b.v) >= 0.95
), reach as (
    select vec_id as id, vec_id as r from embeddings union select e.b, reach.r from reach join edges e on e.a = reach.id
), found as (
    select id, min(r) as component_id from reach group by id
), links as (
    select a as id, count(*) as n from edges group by a
)
select found.id as vec_id, cast(coalesce(links.n, 0) as bigint) as n_links, found.component_id, found.id = found.component_id as kept
from found left join links using (id)
"""

OP10 = """
with payloads as (
    select page_id, coalesce(html, '') as payload from pages
), digests as (
    select page_id, cast(octet_length(encode(payload)) as bigint) as payload_bytes, sha1(payload) as h,
        row_number() over (partition by payload order by page_id desc nulls last) as k, max(page_id) over (partition by payload) as top
    from payloads
)
select page_id, payload_bytes,
    array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((cast('0x' || substr(h, 1 + 5 * (k // 4), 5) as bigint) >> (5 * (3 - k % 4))) & 31), 1)), '') as payload_digest,
    case when k = 1 then 'response' else 'revisit' end as record_type, case when k > 1 then top end as refers_to
from digests
"""

ORACLES = {"op7_minhash_near_dedup": OP7, "op9_embedding_near_dedup": OP9, "op10_warc": OP10}

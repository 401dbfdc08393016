"""The queries as SQL, where SQL can state their results.

Fingerprints, tokens, learnt models and packings are beyond it; tests hold those queries
against brute force instead.
"""

from __future__ import annotations

_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

VECTORS = """with recursive
    fine as materialized (
        select row_number() over () as rid, vec_id, cast(embedding as double[]) as e,
            coalesce(len(embedding) > 0
                and len([x for x in embedding if x is null or not isfinite(x)]) = 0
                and len([x for x in embedding if x <> 0]) > 0, false) as fine
        from embeddings),
    links as materialized (
        select a.rid as u, b.rid as v from fine a join fine b
        on a.fine and b.fine and a.rid <> b.rid and len(a.e) = len(b.e)
            and list_cosine_similarity(a.e, b.e) >= 0.95),
    reach as (select rid as u, rid as v from fine
        union select r.u, l.v from reach r join links l on r.v = l.u),
    found as (select r.u, min(f.vec_id) as component_id from reach r join fine f on f.rid = r.v
        group by r.u),
    counted as (select u, count(*) as n from links group by u)
    select f.vec_id, coalesce(c.n, 0) as n_links, found.component_id,
        coalesce(f.vec_id = found.component_id, false) as kept
    from fine f join found on found.u = f.rid left join counted c on c.u = f.rid"""

OVERLAPS = f"""with
    docs as (select row_number() over () as rid, doc_id, coalesce({_PLAIN}, []) as w from documents),
    items as (select cast(item_id as varchar) as item, {_PLAIN} as w from benchmark),
    windows as (select distinct item, size, array_to_string(w[i : i + size - 1], ' ') as run
        from (select item, w, least(10, len(w)) as size,
            unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from items where len(w) > 0)),
    sizes as (select distinct size from windows),
    places as (select rid, size, i, array_to_string(w[i : i + size - 1], ' ') as run
        from (select rid, w, size, unnest(range(1, len(w) - size + 2)) as i
            from docs, sizes where len(w) >= size)),
    matches as (select rid, i, size, item from places join windows using (size, run)),
    hit as (select rid, count(distinct p) as n from (
        select rid, unnest(range(i, i + size)) as p from matches) group by rid),
    listed as (select rid, list_sort(list(distinct item) filter (item is not null)) as items
        from matches group by rid)
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(hit.n, 0) as n_hit,
        cast(coalesce(len(items), 0) as bigint) as n_items,
        sha256(coalesce(array_to_string(items, ','), '')) as items_sha256,
        coalesce(hit.n, 0) > 0 as contaminated
    from docs left join hit using (rid) left join listed using (rid)"""

REPEATS = r"""with
    docs as (select row_number() over () as rid, doc_id,
        coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
    starts as (select rid, i, row_number() over (partition by run order by doc_id, rid, i) as nth
        from (select rid, doc_id, i, array_to_string(w[i : i + 19], ' ') as run
            from (select rid, doc_id, w, unnest(range(1, len(w) - 18)) as i from docs where len(w) >= 20))),
    gone as (select distinct rid, p from (
        select rid, unnest(range(i, i + 20)) as p from starts where nth > 1)),
    words as (select rid, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from docs),
    kept as (select rid, string_agg(word, ' ' order by p) as body, count(*) as n
        from words anti join gone using (rid, p) group by rid)
    select doc_id, cast(len(w) as bigint) as n_words,
        cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
        sha256(coalesce(body, '')) as kept_sha256
    from docs left join kept using (rid)"""

ORACLES: dict[str, str] = {
    "op3_embedding_near_dedup": VECTORS,
    "op5_decontamination": OVERLAPS,
    "op6_substring_dedup": REPEATS,
}

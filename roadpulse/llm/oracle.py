"""DuckDB SQL that the queries must agree with."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op1_mixing"] = r"""
with sized as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
    from documents
), sums as (
    select source, sum(size)::bigint as source_size from sized group by source
), weighted as (
    select *, ([5, 2, 1])[1 + (row_number() over (order by source nulls last) - 1) % 3] as weight from sums
), needed as (
    select *, sum(source_size) over () * 150 as total, source_size * 200 as cap,
        sum(source_size * 200) over before - source_size * 200 as capped_before,
        sum(weight) over () - sum(weight) over before + weight as weight_left
    from weighted
    window before as (order by source_size / weight, source nulls last rows unbounded preceding)
), judged as (
    select *, total - capped_before as rest, (total - capped_before) * weight > cap * weight_left as capped
    from needed
), shared as (
    select *, max(rest) filter (not capped) over () as free_rest,
        max(weight_left) filter (not capped) over () as free_weight
    from judged
), targets as (
    select source, source_size,
        case when capped then (source_size * 2)::double
            else (free_rest * weight)::double / (free_weight * 100)::double end as target,
        ('0x' || substr(md5('offset:' || coalesce(source, '')), 1, 8))::bigint::double / 4294967296.0::double as draw
    from shared
), placed as (
    select *, row_number() over (partition by source order by size, doc_id) as place
    from sized
)
select p.doc_id, p.size, t.source_size, t.target,
    ((floor(p.place::double * (case when t.source_size > 0 then t.target / t.source_size else 0 end) + t.draw)
      - floor((p.place - 1)::double * (case when t.source_size > 0 then t.target / t.source_size else 0 end) + t.draw))::bigint
     * p.size)::bigint as taken
from placed p join targets t on p.source is not distinct from t.source
"""

ORACLE["op3_odd_sketch_dedup"] = r"""
with recursive words as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as w
    from documents
), shingles as (
    select distinct doc_id, unnest(
        case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
            else [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] end) as s
    from words
), sizes as (
    select doc_id, count(*) as n from shingles group by doc_id
), links as (
    select a.doc_id as a, b.doc_id as b
    from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id
    group by a.doc_id, b.doc_id
    having 100 * count(*) >= 85 * ((select n from sizes where doc_id = a.doc_id)
        + (select n from sizes where doc_id = b.doc_id) - count(*))
), both_ways as (
    select a, b from links union all select b, a from links
), reach as (
    select doc_id as a, doc_id as b from documents
    union
    select r.a, l.b from reach r join both_ways l on r.b = l.a
), smallest as (
    select a as doc_id, min(b) as component_id from reach group by a
)
select d.doc_id, coalesce(z.n, 0)::bigint as n_shingles, s.component_id, s.component_id = d.doc_id as kept
from documents d join smallest s using (doc_id) left join sizes z using (doc_id)
"""

_IMATCH_PRINT = r"""
    list_concat(
        [case when len(w) > 0 then substr(md5(array_to_string([x.term for x in w], ' ')), 1, 16)
            else 'x' || substr(md5(body), 1, 15) end],
        [case when len([x for x in w if x.h1 % 32 = i]) > 0
            then substr(md5(array_to_string([x.term for x in w if x.h1 % 32 = i], ' ')), 1, 16) else '' end
            for i in range(0, 16)],
        [case when len([x for x in w if x.h2 % 128 = i]) > 0
            then substr(md5(array_to_string([x.term for x in w if x.h2 % 128 = i], ' ')), 1, 16) else '' end
            for i in range(0, 16)],
        [case when len([x for x in w if x.h3 % 512 = i]) > 0
            then substr(md5(array_to_string([x.term for x in w if x.h3 % 512 = i], ' ')), 1, 16) else '' end
            for i in range(0, 16)])
"""
_IMATCH_TERMS = r"""list_distinct(regexp_extract_all(
    translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'))"""
ORACLE["op5_imatch"] = f"""
with docs as (
    select doc_id, coalesce(text, '') as text from documents
), edited as (
    select doc_id, text, length(text) as n,
        coalesce(lead(text) over (order by doc_id), first_value(text) over (order by doc_id)) as next_text,
        coalesce(lead(doc_id) over (order by doc_id), first_value(doc_id) over (order by doc_id)) as next_id
    from docs
), often as (
    select md5(text) as hash from docs group by text
    having count(*) > greatest(1, (select count(*) // 10000 from docs))
), bodies as (
    select doc_id, 0 as kind, text as body from edited
    union all
    select doc_id, 1, left(text, n - n // 4) || left(next_text, n // 4) from edited
), spread as (
    select doc_id, kind, if(kind = 0, md5(body), null) as hash, unnest({_IMATCH_TERMS.format('body')}) as term from bodies
), texts as (
    select count(*) filter (o.hash is null) + count(distinct o.hash) as n
    from docs left join often o on o.hash = md5(text)
), lexicon as (
    select term, ('0x' || substr(md5(term), 1, 4))::bigint as h1, ('0x' || substr(md5(term), 5, 4))::bigint as h2,
        ('0x' || substr(md5(term), 9, 4))::bigint as h3
    from spread left join often using (hash) where kind = 0 group by term
    having count(*) >= greatest(2, (select ceil(count(*) / 1000) from docs))
        and count(*) filter (often.hash is null) + count(distinct often.hash) <= greatest(2, (select n // 5 from texts))
), kept as (
    select doc_id, kind, list(struct_pack(term := term, h1 := h1, h2 := h2, h3 := h3) order by term) as w
    from spread join lexicon using (term) group by doc_id, kind
), prints as (
    select b.doc_id, b.kind, b.body, coalesce(k.w, []) as w
    from bodies b left join kept k on k.doc_id = b.doc_id and k.kind = b.kind
), hashed as (
    select doc_id, kind, body, {_IMATCH_PRINT} as p from prints
), lined as (
    select e.doc_id, e.n, x.body as edited, a.p as p, x.p as q, c.p as r
    from edited e join hashed a on a.doc_id = e.doc_id and a.kind = 0
    join hashed x on x.doc_id = e.doc_id and x.kind = 1
    join hashed c on c.doc_id = e.next_id and c.kind = 0
)
select doc_id, n::bigint as n_chars, sha256(edited) as edited_sha256,
    array_to_string(p, '-') as fingerprint, array_to_string(q, '-') as edited_fingerprint,
    len([i for i in range(1, 50) if p[i] != '' and p[i] = q[i]])::double
        / len([i for i in range(1, 50) if p[i] != '' or q[i] != ''])::double as near_edited,
    len([i for i in range(1, 50) if p[i] != '' and p[i] = r[i]])::double
        / len([i for i in range(1, 50) if p[i] != '' or r[i] != ''])::double as near_next
from lined
"""

ORACLE["op6_substring_dedup"] = r"""
with words as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), starts as (
    select doc_id, unnest(range(1, len(w) - 11)) as spot, unnest([array_to_string(w[i:i + 12], ' ')
        for i in range(1, len(w) - 11)]) as passage
    from words where len(w) >= 13
), repeated as (
    select doc_id, spot from (
        select doc_id, spot, min(doc_id) over (partition by passage) as first_id from starts
    ) where doc_id > first_id
), covered as (
    select distinct doc_id, unnest(range(spot, spot + 13)) as spot from repeated
), gone as (
    select doc_id, list(spot) as places, count(*) as n from covered group by doc_id
)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(g.n, 0)::bigint as n_removed,
    sha256(array_to_string(case when g.n is null then d.w
        else [x for x, i in d.w if not list_contains(g.places, i)] end, ' ')) as kept_sha256
from words d left join gone g using (doc_id)
"""

ORACLE["op2_voronoi_knn"] = r"""
with vectors as (
    select vec_id, [floor(256 * x::double)::bigint for x in embedding] as v
    from embeddings
    where vec_id is not null and embedding is not null
        and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, list_sum([q.v[i] * c.v[i] for i in range(1, len(q.v) + 1)])::bigint as score
    from vectors q join vectors c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id
)
select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score
from scored qualify rank <= 5
"""

# The CRC-32 of every byte, by eight steps of its polynomial.
_CRC_TABLE = """
step(b, c, k) as (
    select i::bigint, i::bigint, 0 from range(256) t(i)
    union all
    select b, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from step where k < 8
), crc_table as (
    select list(c order by b) as t from step where k = 8
),"""

ORACLE["op12_ngram_resampling"] = (
    "with recursive " + _CRC_TABLE + r"""
words as (
    select 's' as side, row_number() over () as row, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
    union all
    select 't', row_number() over (), null, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
    from benchmark
), grams as (
    select side, row, gram, count(*) as n from (
        select side, row, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as gram
        from words, range(1, 4) r(k) where len(w) >= k)
    group by all
), buckets as (
    select gram, xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
        list_transform(range(1, strlen(gram) + 1), lambda i: ('0x' || substr(h, 2 * i - 1, 2))::bigint)),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) % 10000 as bucket
    from (select gram, hex(encode(gram)) as h from (select distinct gram from grams)), crc_table
), counts as (
    select bucket, coalesce(sum(n) filter (side = 's'), 0)::double as s, coalesce(sum(n) filter (side = 't'), 0)::double as t
    from grams join buckets using (gram) group by bucket
), gains as (
    select bucket, floor(1000 * ln((t + 1) * (sum(s) over () + 10000) / ((s + 1) * (sum(t) over () + 10000))))::bigint as gain
    from counts
), weights as (
    select row, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight
    from grams join buckets using (gram) join gains using (bucket) where side = 's' group by row
), scored as (
    select doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((
            ('0x' || substr(sha256('42:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double)
            / 4294967296::double)))::bigint as score
    from words left join weights using (row) where side = 's'
), placed as (
    select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls last, n_features) as place,
        count(*) filter (n_words >= 20) over () as n
    from scored
)
select doc_id, n_features, weight, score, case when n_words >= 20 and place <= 5 * n // 100 then place end as rank
from placed
"""
)

ORACLE["op13_burst_trie"] = (
    "with recursive " + _CRC_TABLE + r"""
turns as (
    select conv_id, row_number() over (partition by conv_id order by turn nulls first, id) as place, id, chars
    from (select conv_id, turn, length(coalesce(text, ''))::bigint as chars,
            substr(sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) as id
        from conversations where conv_id is not null)
), convs as (
    select conv_id, conv_id - conv_id % 100 as hundred,
        xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
            list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
            lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) % 6 as h
    from (select distinct conv_id from turns), crc_table
), rebuilt as (
    select c.conv_id, t.place, t.id, t.chars from convs c join turns t on t.conv_id = c.hundred and t.place <= c.h
    union all
    select c.conv_id, t.place + 1000000000, t.id, t.chars from convs c join turns t on t.conv_id = c.conv_id and t.place > c.h
), placed as (
    select conv_id, chars, row_number() over w as depth, list(id) over w as prefix
    from rebuilt window w as (partition by conv_id order by place rows unbounded preceding)
), members as (
    select conv_id, depth, chars, prefix from placed
    union all
    select conv_id, 0, 0, [] from convs
), ends as (
    select conv_id, max(depth) as depth from members group by conv_id
), nodes as (
    select depth, prefix, min(m.conv_id) as conv_id, max(chars) as chars, count(*) as n_convs,
        sha256(coalesce(string_agg(e.conv_id::varchar, ',' order by e.conv_id), '')) as ends_sha256
    from members m left join ends e using (conv_id, depth)
    group by depth, prefix
), placement as (
    select m.conv_id as member, m.depth, n.conv_id from members m join nodes n using (depth, prefix)
), linked as (
    select n.*, p.conv_id as parent_conv_id
    from nodes n left join placement p on p.member = n.conv_id and p.depth = n.depth - 1
), counted as (
    select l.*, coalesce(k.n_children, 0) as n_children
    from linked l left join (select parent_conv_id, depth - 1 as depth, count(*) as n_children
        from linked where depth > 0 group by all) k
        on k.parent_conv_id = l.conv_id and k.depth = l.depth
), sums as (
    select a.conv_id, a.depth, count(*) filter (c.n_children = 0) as n_leaves,
        sum((c.n_convs - 1) * c.chars)::bigint as saved_tokens
    from counted c join placement a on a.member = c.conv_id and a.depth <= c.depth
    group by a.conv_id, a.depth
)
select c.conv_id, c.depth, c.parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, c.ends_sha256
from counted c join sums s using (conv_id, depth)
"""
)

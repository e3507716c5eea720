"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES: dict[str, str] = {
    "op4_line_dedup": f"""
with line as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as no
    from documents),
keyed as (select *, translate(trim(line, {_BLANKS}), '{_UPPER}', '{_LOWER}') as key from line),
frequent as (
    select key, max(doc_id) as last_doc from keyed where length(key) >= 40
    group by key having count(distinct doc_id) >= 5),
judged as (
    select k.doc_id, k.line, k.no, coalesce(k.doc_id <> f.last_doc, false) as gone
    from keyed k left join frequent f on k.key = f.key)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by no) filter (where not gone), '')) as kept_sha256
from judged group by doc_id""",
    "op10_minhash_near_dedup": f"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') as w
    from documents),
shingles as (
    select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
links as (
    select x.doc_id as a, y.doc_id as b from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id
    join sizes p on p.doc_id = x.doc_id join sizes q on q.doc_id = y.doc_id
    group by x.doc_id, y.doc_id having 100 * count(*) >= 75 * (any_value(p.n) + any_value(q.n) - count(*))),
reach(doc_id, other) as (
    select doc_id, doc_id from documents
    union select reach.doc_id, links.b from reach join links on reach.other = links.a)
select d.doc_id, coalesce(any_value(s.n), 0) as n_shingles, min(r.other) as component_id, min(r.other) = d.doc_id as kept
from documents d join reach r on r.doc_id = d.doc_id left join sizes s on s.doc_id = d.doc_id group by d.doc_id""",
    "op2_embedding_near_dedup": """
with recursive usable as (
    select vec_id, embedding::double[] as v from embeddings
    where embedding is not null and len(embedding) > 0
      and list_aggregate(embedding, 'count') = len(embedding) and isfinite(list_sum(embedding::double[]))
      and (list_max(embedding) <> 0 or list_min(embedding) <> 0)),
links as (
    select a.vec_id as a, b.vec_id as b from usable a join usable b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    where list_cosine_similarity(a.v, b.v) >= 0.95),
reach(vec_id, other) as (
    select vec_id, vec_id from embeddings
    union select reach.vec_id, links.b from reach join links on reach.other = links.a),
counts as (select a, count(*) as n from links group by a)
select e.vec_id, coalesce(any_value(c.n), 0) as n_links, min(r.other) as component_id, min(r.other) = e.vec_id as kept
from embeddings e join reach r on r.vec_id = e.vec_id left join counts c on c.a = e.vec_id group by e.vec_id""",
}

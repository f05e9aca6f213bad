"""DuckDB SQL for the queries of this subpackage that SQL can express."""

LINE_DEDUP = r"""
with docs as (
  select doc_id, text, string_split(coalesce(text, ''), chr(10)) as lines from documents
), windows as (
  select doc_id, p as pos, lines[p + 1] as a, lines[p + 2] as b, lines[p + 3] as c
  from docs, unnest(range(0, len(lines) - 2)) as t(p)
), placed as (
  select doc_id, pos, row_number() over (partition by a, b, c order by doc_id, pos) as nth
  from windows
  where regexp_matches(a || b || c, '[^\x20\x09-\x0D]')
), gone as (
  select distinct doc_id, pos + k as line
  from placed, unnest([0, 1, 2]) as t(k) where nth > 1
), kept as (
  select doc_id, string_agg(lines[i + 1], chr(10) order by i) as text
  from docs, unnest(range(0, len(lines))) as t(i)
  where not exists (select 1 from gone where gone.doc_id = docs.doc_id and gone.line = i)
  group by doc_id
), removed as (select doc_id, count(*) as n from gone group by doc_id)
select docs.doc_id, coalesce(kept.text, '') as text, len(docs.lines) as n_lines,
       coalesce(removed.n, 0) as n_removed
from docs left join kept using (doc_id) left join removed using (doc_id)
"""

RANKED_SEARCH = r"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '(?:[0-9a-z]|[^\x00-\x7F])+')) as term
  from documents
), asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '(?:[0-9a-z]|[^\x00-\x7F])+')) as term
  from benchmark
), sizes as (select doc_id, count(*) as n from words group by doc_id),
totals as (select count(*) as docs, sum(n)::bigint as len from sizes),
held as (
  select doc_id, term, count(*) as tf from words
  where term in (select term from asked) group by doc_id, term
), weights as (
  select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w
  from held, totals group by term, docs
), scores as (
  select item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // len)))))::bigint
           as score
  from asked join held using (term) join weights using (term) join sizes using (doc_id), totals
  group by item_id, doc_id
), ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as nth
  from scores where score > 0
)
select item_id, nth::integer as rank, doc_id, score from ranked where nth <= 10
"""

SUBSTRING_DEDUP = r"""
with docs as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents
), windows as (
  select doc_id, p, array_to_string(words[p + 1:p + 13], ' ') as w
  from docs, unnest(range(0, len(words) - 12)) as t(p)
), homes as (select w, min(doc_id) as home from windows group by w having min(doc_id) < max(doc_id)),
gone as (
  select distinct doc_id, p + k as place
  from windows join homes using (w), unnest(range(0, 13)) as t(k) where doc_id > home
), removed as (
  select doc_id, count(*) as n, list(place) as places from gone group by doc_id
)
select doc_id, len(words)::bigint as n_words, coalesce(n, 0) as n_removed,
       sha256(coalesce(case when n is null then array_to_string(words, ' ')
         else (select string_agg(words[i + 1], ' ' order by i)
               from unnest(range(0, len(words))) as t(i)
               where not list_contains(places, i)) end, '')) as kept_sha256
from docs left join removed using (doc_id)
"""

HARD_NEGATIVES = r"""
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::bigint as score
  from vectors a join vectors b on a.vec_id <> b.vec_id
  where a.vec_id % 100 = 0
), positives as (
  select * from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other) <= 5
), found as (
  select p.anchor_id, p.other as positive_id, n.other as negative_id,
         p.score as positive_score, n.score as negative_score,
         row_number() over (partition by p.anchor_id, p.other order by n.score desc, n.other) as nth
  from positives p join scored n on p.anchor_id = n.anchor_id and not n.same
    and 80 * p.score <= 100 * n.score and n.score <= p.score
)
select anchor_id, positive_id, nth::integer as rank, negative_id, positive_score, negative_score
from found where nth <= 5
"""

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": LINE_DEDUP,
    "op11_ranked_search": RANKED_SEARCH,
    "op12_substring_dedup": SUBSTRING_DEDUP,
    "op13_hard_negatives": HARD_NEGATIVES,
}

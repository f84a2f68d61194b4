"""DuckDB definitions of the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIXING = f"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as size,
         md5(concat('17|', coalesce(cast(doc_id as varchar), ''), '|', coalesce(md5(text), ''))) as key
  from documents
), sources as (
  select source, cast(sum(size) as bigint) as source_size,
         (case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end)::double as weight
  from sized group by source
), levels as (
  select *, 2.0::double * source_size as cap,
         (1.5::double * sum(source_size) over () - coalesce(sum(2.0::double * source_size) over earlier, 0))
           / sum(weight) over later as level
  from sources
  window earlier as (order by 2.0::double * source_size / weight, source rows between unbounded preceding and 1 preceding),
         later as (order by 2.0::double * source_size / weight, source rows between current row and unbounded following)
), targets as (
  select source, source_size, least(cap, max(level) over () * weight) as target from levels
), plan as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole from targets
), placed as (
  select s.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size as extra,
         coalesce(sum(size) over (partition by s.source order by key rows between unbounded preceding and 1 preceding), 0) as before
  from sized s join plan p on s.source is not distinct from p.source
)
select doc_id, cast(size as bigint) as size, source_size, target,
       cast(size * (whole + case when 2 * before + size <= 2 * extra then 1 else 0 end) as bigint) as taken
from placed
"""

LINE_QUALITY = f"""
with docs as (
  select row_number() over () as row, doc_id, source, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') as words
  from documents
), threes as (
  select row, i, words[i:i + 2] as three from (select row, words, unnest(range(1, len(words) - 1)) as i from docs)
), repeated as (
  select row, i from (select row, i, count(*) over (partition by row, three) as n from threes) where n > 1
), repeats as (
  select row, count(distinct p) as n_repeat_words from (select row, unnest([i, i + 1, i + 2]) as p from repeated) group by row
), lines as (
  select row, doc_id, source, text, line, regexp_extract_all(translate(line, '{UPPER}', '{LOWER}'), '{WORD}') as words
  from (select row, doc_id, source, text, unnest(string_split(text, chr(10))) as line from docs)
), carried as (
  select row, doc_id, source, text, array_to_string(words, ' ') as normal, len(words) as n from lines where len(words) > 0
), duplicates as (
  select row, count(*) - count(distinct line) as n_dup_lines from lines where len(words) > 0 group by row
), frequent as (
  select source, normal, min(doc_id) as first_doc from carried group by source, normal having count(distinct concat(cast(doc_id as varchar), '|', text)) > 20
), lost as (
  select row, sum(n) as lost
  from carried c join frequent f on c.source is not distinct from f.source and c.normal = f.normal
  where c.doc_id is distinct from f.first_doc group by row
), figures as (
  select doc_id, len(words) as n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
         len(words) - coalesce(lost, 0) as words_left
  from docs left join repeats using (row) left join duplicates using (row) left join lost using (row)
)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
       cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 100 * words_left >= 30 * n_words as kept,
       cast(words_left as bigint) as words_left
from figures
"""

EMBEDDINGS = """
with recursive vectors as (
  select row_number() over () as row, vec_id, cast(embedding as double[]) as v from embeddings
), good as (
  select row, vec_id, v from vectors
  where len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(v, lambda x: x <> 0)) > 0
), links as materialized (
  select a.row, b.row as other, b.vec_id as other_id from good a join good b on a.row <> b.row and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.95
), reach(row, other) as (
  select row, row from good
  union
  select r.row, l.other from reach r join links l on r.other = l.row
), components as (
  select r.row, min(g.vec_id) as component_id from reach r join good g on g.row = r.other group by r.row
), counts as (
  select row, count(*) as n_links from links group by row
)
select vec_id, cast(coalesce(n_links, 0) as bigint) as n_links, coalesce(component_id, vec_id) as component_id,
       vec_id is not distinct from coalesce(component_id, vec_id) as kept
from vectors left join counts using (row) left join components using (row)
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SEARCH = f"""
with asked as (
  select item, item_id, term, count(*) as repeats from (
    select row_number() over () as item, item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) as term
    from benchmark
  ) group by item, item_id, term
), read as (
  select row_number() over () as row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') as terms
  from documents
), sized as (
  select row, doc_id, cast(len(terms) as bigint) as n, terms from read where len(terms) > 0
), totals as (
  select cast(count(*) as bigint) as documents, cast(sum(n) as bigint) as all_terms from sized
), held as (
  select row, term, cast(count(*) as bigint) as tf from (select row, unnest(terms) as term from sized)
  where term in (select term from asked) group by row, term
), weights as (
  select term, cast(floor(1000 * ln((2 * any_value(documents) + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w
  from held cross join totals group by term
), scored as (
  select a.item, a.item_id, s.row, s.doc_id,
         cast(sum(a.repeats * w.w * ((1000000000 * h.tf) // (1000 * h.tf + 8 * (100 - 75 + (75 * s.n * t.documents) // t.all_terms)))) as bigint) as score
  from asked a join held h using (term) join weights w using (term) join sized s using (row) cross join totals t
  group by a.item, a.item_id, s.row, s.doc_id
), ranked as (
  select item_id, doc_id, score, cast(row_number() over (partition by item order by score desc, doc_id nulls last) as integer) as rank
  from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""

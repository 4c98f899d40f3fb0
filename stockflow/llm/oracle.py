"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_DISTANCE = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"


def _lloyd(rounds: int) -> str:
    """Rounds of Lloyd's method as common table expressions book0 to book{rounds}: p, e, c (a list)."""
    out = []
    for r in range(rounds):
        out.append(f"""
near{r} as materialized (
  select v, p, min(coalesce({_DISTANCE}, 0) * 16 + e) % 16 as e
  from parts join book{r} using (p) group by v, p),
sums{r} as (
  select p, e, i, sum(x[i])::hugeint as s, count(*) as n
  from near{r} join parts using (v, p), (select unnest(range(1, 65)) as i) where i <= len(x) group by p, e, i),
means{r} as (
  select p, e, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as m from sums{r} group by p, e),
book{r + 1} as materialized (
  select p, e, coalesce(m, c) as c from book{r} left join means{r} using (p, e)),""")
    return "".join(out)


ORACLE: dict[str, str] = {
    "op4_minhash_near_dedup": rf"""
with recursive
words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as w from documents),
shingles as (
  select distinct doc_id, s from (
    select doc_id, unnest(case when len(w) = 0 then []
      when len(w) < 4 then [array_to_string(w, ' ')]
      else [array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)] end) as s from words)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * shared >= 80 * (x.n + y.n - shared)),
ways as (select a, b from links union all select b, a from links),
reach as (
  select doc_id as a, doc_id as b from documents
  union select reach.a, ways.b from reach join ways on ways.a = reach.b),
least as (select a as doc_id, min(b) as component_id from reach group by a)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept
from least left join sizes using (doc_id)
""",
    "op5_warc_round_trip": """
with plain as (
  select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest
  from pages),
first as (
  select payload_digest, min(page_id) as first from plain where payload_bytes >= 100 group by payload_digest)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id > first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id > first then first end as refers_to
from plain left join first using (payload_digest)
""",
    "op8_quality_cascade": rf"""
with
words as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents),
windows as (
  select doc_id, unnest(range(1, len(w) - 1)) as i, w from words where len(w) >= 3),
grams as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from windows),
again as (select doc_id, i, count(*) over (partition by doc_id, g) as c from grams),
repeated as (
  select doc_id, count(distinct place) as n from (
    select doc_id, unnest([i, i + 1, i + 2]) as place from again where c > 1) group by doc_id),
lines as (select doc_id, unnest(string_split(text, chr(10))) as line from words),
line_counts as (
  select doc_id, count(*) as n, count(*) - count(distinct line) as dup from lines
  where regexp_matches(line, '{_WORD}') group by doc_id),
counts as (
  select doc_id, len(w)::bigint as n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    coalesce(dup, 0)::bigint as n_dup_lines, coalesce(repeated.n, 0)::bigint as n_repeat_words,
    coalesce(line_counts.n, 0) as n_lines,
    length(regexp_replace(text, '[^!?]', '', 'g')) as n_shouts,
    length(regexp_replace(text, '[^A-Za-z]', '', 'g')) as n_letters,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_capitals
  from words left join line_counts using (doc_id) left join repeated using (doc_id)),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    100 * n_symbols > 8 * word_chars or 2 * n_dup_lines > n_lines or 100 * n_shouts > 5 * word_chars
    or (n_letters >= 100 and 2 * n_capitals > n_letters)
    or word_chars < 2 * n_words or word_chars > 25 * n_words as rejected
  from counts)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not rejected as kept
from judged
""",
    "op11_vector_codes": f"""
with
kept as (
  select row_number() over (order by vec_id, embedding) as v, vec_id, label,
    list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as x
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as materialized (
  select v, p, x[p * len(x) // 8 + 1:(p + 1) * len(x) // 8] as x from kept, (select unnest(range(8)) as p)),
book0 as (select p, v - 1 as e, x as c from parts where v <= 16),{_lloyd(6)}
near as (
  select v, p, min(coalesce({_DISTANCE}, 0) * 16 + e) as least from parts join book6 using (p) group by v, p),
coded as (
  select v, string_agg(lpad(lower(hex(least % 16)), 2, '0'), '' order by p) as code, sum(least // 16)::bigint as error
  from near group by v),
flat as (
  select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) as codebooks_sha256 from book6)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
from coded join kept using (v), flat
""",
    "op13_ranked_search": rf"""
with
words as (
  select row_number() over () as nr, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}') as w from documents),
terms as (select nr, unnest(w) as term from words),
counts as (select nr, term, count(*) as tf from terms group by all),
lengths as (select nr, doc_id, len(w)::bigint as n from words),
whole as (select count(*) filter (n > 0) as docs, sum(n)::bigint as terms from lengths),
norms as (select nr, doc_id, 100 - 50 + ((50 * n * docs) // terms) as m from lengths, whole),
weights as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from counts, whole group by term, docs),
asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')) as term from benchmark),
scores as (
  select item_id, nr, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
  from asked join weights using (term) join counts using (term) join norms using (nr) group by all),
places as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last)::int as rank, doc_id, score
  from scores where score > 0)
select item_id, rank, doc_id, score from places where rank <= 50
""",
}

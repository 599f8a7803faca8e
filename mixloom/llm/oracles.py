"""SQL of the numbered queries that SQL can express on whole tables."""

from mixloom.llm.quality import LEVELS

RISK, ERROR = 0.02, 0.1
SQL: dict[str, str] = {}

LEVELS_SQL = ", ".join(f"({j}, {a}, {b}, {c}, {d})" for j, (a, b, c, d) in enumerate(LEVELS))

#: The rows of ``docs`` (doc_id, text, lang), judged; ``{docs}`` names them.
QUALITY_CTE = rf"""
q_text as (select row_number() over () as r, doc_id, lang, coalesce(text, '') as t from {{docs}}),
q_words as (
  select r, doc_id, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from q_text),
q_windows as (
  select r, unnest(range(1, len(w) - 3)) as i, w from q_words where len(w) >= 5),
q_grams as (select r, i, count(*) over (partition by r, w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) as n from q_windows),
q_covered as (select r, count(distinct i + k)::bigint as n_repeat_words from q_grams, range(5) as s(k) where n > 1 group by r),
q_measured as (
  select r, doc_id, lang, len(w) as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
    len(lines) as n_lines, length(t) - length(regexp_replace(t, '\p{{{{Lu}}}}', '', 'g')) as n_capitals
  from q_words left join q_covered using (r)),
q_levels(j, a, b, c, d) as (values {LEVELS_SQL}),
q_judged as (
  select m.*, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    (select count(*) from q_levels where 100 * n_symbols <= a * word_chars and 100 * n_capitals <= b * word_chars
      and 100 * n_dup_lines <= c * n_lines and 100 * n_repeat_words <= d * n_words) as level
  from q_measured m),
q_good as (select doc_id from labels group by doc_id having min(quality) = 1),
q_strata as (
  select lang, j, count(*) as n, count(*) filter (level <= j) as k
  from q_judged, q_levels where not base_failed and doc_id in (select doc_id from q_good) group by lang, j),
q_tested as (
  select lang, j, case when k < n * {RISK} then list_sum(list_transform(range(k + 1), lambda i:
    exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK}) + (n - i) * ln(1 - {RISK})))) else 1 end as p
  from q_strata),
q_certified as (
  select lang, coalesce(min(j) filter (p > {ERROR} / (select count(distinct coalesce('=' || lang, '')) from q_tested)), {len(LEVELS)}) as certified
  from q_tested group by lang),
q_result as (
  select q_judged.*, not base_failed and level >= coalesce(certified, 0) as kept
  from q_judged left join q_certified on q_judged.lang is not distinct from q_certified.lang)
"""

SQL["op1_quality_rules"] = f"""
with {QUALITY_CTE.format(docs="documents")}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept from q_result
"""

SQL["op2_warc_archive"] = """
with stored as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), held as (select *, min(page_id) over (partition by payload_digest) as holder from stored)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id is distinct from holder and holder is not null then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id is distinct from holder then holder end as refers_to
from held
"""

SQL["op4_chat_round_trip"] = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), formatted as (
  select *, 24 + length(role) + length(case when regexp_matches(text, '<\|im_start\|>|<\|im_end\|>|<\\+\|')
    then regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') else text end) as chars from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(chars)::bigint as formatted_chars
from formatted group by conv_id
"""

SQL["op6_substring_dedup"] = r"""
with texts as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
starts as (select doc_id, w, unnest(range(1, len(w) - 11)) as i from texts where len(w) >= 13),
firsts as (select doc_id, i, min(doc_id) over (partition by array_to_string(w[i : i + 12], ' ')) as holder from starts),
covered as (select distinct doc_id, i + k as p from firsts, range(13) as s(k) where holder < doc_id),
words as (select doc_id, w, unnest(range(1, len(w) + 1)) as p from texts),
kept as (select doc_id, string_agg(w[p], ' ' order by p) as t, count(*) as n from words anti join covered using (doc_id, p) group by doc_id)
select doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from texts left join kept using (doc_id)
"""

#: Sets of ``{words}``-word shingles of ``{docs}`` (doc_id, text), their links at ``{percent}`` and components.
NGRAM_CTE = r"""
n_words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from {docs}),
n_sets as (
  select doc_id, list_distinct(list_transform(range(1, greatest(len(w) - ({words} - 1), 1) + 1), lambda i: array_to_string(w[i : i + ({words} - 1)], ' '))) as s
  from n_words where len(w) > 0),
n_grams as (select doc_id, unnest(s) as g from n_sets),
n_common as (select x.doc_id as a, y.doc_id as b, count(*) as n from n_grams x join n_grams y on x.g = y.g and x.doc_id < y.doc_id group by all),
n_links as (
  select a, b from n_common join n_sets x on x.doc_id = a join n_sets y on y.doc_id = b
  where 100 * n >= {percent} * (len(x.s) + len(y.s) - n)),
n_both as (select a, b from n_links union all select b, a from n_links),
n_reach as (select doc_id as a, doc_id as b from {docs} union select r.a, l.b from n_reach r join n_both l on r.b = l.a),
n_result as (
  select d.doc_id, coalesce(len(s), 0) as n_shingles, (select min(b) from n_reach where a = d.doc_id) as component_id
  from {docs} d left join n_sets using (doc_id))
"""

SQL["op7_ngram_join"] = f"with recursive {NGRAM_CTE.format(docs='documents', words=5, percent=80)} select * from n_result"

SQL["op10_exact_topk"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as x from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.x, c.x)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.x) = len(c.x) where q.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

SQL["op12_lsh_forest"] = f"""
with recursive {NGRAM_CTE.format(docs="documents", words=3, percent=85)} select *, doc_id = component_id as kept from n_result
"""

SQL["op13_periodic_runs"] = r"""
with texts as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
      lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda y, k: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) as h
  from documents),
placed as (select r, doc_id, w, h % 10 = 0 and len(w) > 0 as changed, (h // 10) % greatest(len(w), 1) as a, 3 + (h // 10) % 8 as parts from texts),
words as (
  select r, doc_id, len(w) as n, case when changed then list_transform(range(len(w)), lambda i:
    case when i < a then w[i + 1] else w[a + (i - a) % (1 + (len(w) - a) // parts) + 1] end) else w end as w
  from placed),
tokens as (select r, n, unnest(w) as word, unnest(range(n)) as i from words),
equal as (select x.r, x.i, y.i - x.i as q from tokens x join tokens y on x.r = y.r and x.word = y.word and x.i < y.i and 3 * (y.i - x.i) <= x.n),
islands as (select r, q, i, i - row_number() over (partition by r, q order by i) as island from equal),
periodic as (select r, min(i) as start, count(*) + q as length, q as period from islands group by r, q, island having count(*) + q >= greatest(24, 3 * q)),
runs as (
  select * from periodic p where not exists (
    select 1 from periodic s where s.r = p.r and s.period < p.period and s.start <= p.start and s.start + s.length >= p.start + p.length)),
covered as (select distinct r, unnest(range(start + period, start + length)) as i from runs),
kept as (select r, string_agg(word, ' ' order by i) as t from tokens anti join covered using (r, i) group by r),
listed as (
  select r, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines,
    arg_min(struct_pack(start, length, period), struct_pack(o := -length / period, s := start, p := period)) as best
  from runs group by r)
select doc_id, coalesce(n_runs, 0) as n_runs, best.start as start, best.length as length, best.period as period,
  1000 * best.length // best.period as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(t, '')) as collapsed_sha256
from words left join listed using (r) left join kept using (r)
"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

"""The queries that SQL can express, in DuckDB SQL over the same tables: whole tables, no shortcuts of the operators."""

from __future__ import annotations

from .quality import MAX_REPEATED_PERCENT, MIN_WORDS

WORD = r"[^\x20\x09-\x0D]+"

#: All pairs of documents that share a run of five words, by the overlap of their multisets of runs; classes by closing over the links.
NEAR = rf"""
with recursive words as (
  select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i, len(w) as n from (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents)
), runs as (
  select doc_id, i, n, string_agg(word, ' ') over (partition by doc_id order by i rows between current row and 4 following) as g from words
), bags as (select doc_id, g, count(*) as k from runs where i <= greatest(n - 4, 1) group by doc_id, g),
sizes as (select doc_id, sum(k) as total from bags group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, sum(least(a.k, b.k)) as common from bags a join bags b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where common / (x.total + y.total - common) >= 0.8),
both_ways as (select a, b from links union all select b, a from links),
reached as (select doc_id, doc_id as other from documents union select r.doc_id, l.b from reached r join both_ways l on r.other = l.a),
classes as (select doc_id, min(other) as class_id from reached group by doc_id)
select doc_id, class_id, count(*) over (partition by class_id) as class_size, doc_id = class_id as stays from classes
"""

#: Every string of 200 bytes, taken from blocks of the text in hexadecimal digits.
SUFFIX = """
with docs as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
blocks as (select doc_id, b, substr(x, (2 * b + 1)::bigint, 1422) as part, len(x) // 2 - 199 - b as left_ from (select doc_id, x, unnest(range(0, greatest(len(x) // 2 - 199, 0), 512)) as b from docs)),
starts as (select doc_id, b, part, unnest(range(0, least(512, left_))) as o from blocks),
strings as (select doc_id, b + o as p, md5(substr(part, (2 * o + 1)::bigint, 400)) as k from starts),
repeated as (select doc_id, p from strings where k in (select k from strings group by k having count(*) > 1)),
edges as (select doc_id, p, case when p <= lag(p) over (partition by doc_id order by p) + 200 then 0 else 1 end as fresh from repeated),
runs as (select doc_id, min(p) as s, max(p) + 200 as e from (select doc_id, p, sum(fresh) over (partition by doc_id order by p) as run from edges) group by doc_id, run),
gaps as (
  select doc_id, coalesce(lag(e) over (partition by doc_id order by s), 0) as s, s as e from runs
  union all select d.doc_id, coalesce(max(r.e), 0), len(any_value(d.x)) // 2 from docs d left join runs r on r.doc_id = d.doc_id group by d.doc_id
),
kept as (select g.doc_id, string_agg(substr(d.x, (2 * s + 1)::bigint, 2 * (e - s)), '' order by s) as x from gaps g join docs d on d.doc_id = g.doc_id group by g.doc_id),
counts as (select doc_id, sum(e - s) as n, count(*) as k from runs group by doc_id)
select k.doc_id, coalesce(c.n, 0)::bigint as n_removed, coalesce(c.k, 0)::bigint as n_spans, sha256(unhex(k.x)) as kept_sha256 from kept k left join counts c on c.doc_id = k.doc_id
"""

#: Neighbouring lines that an earlier place has, by the lines themselves.
LINES = r"""
with lines as (
  select doc_id, unnest(l) as line, generate_subscripts(l, 1) as i, len(l) as n from (select doc_id, string_split(text, chr(10)) as l from documents where text is not null)
), placed as (select *, sum(length(line) + 1) over (partition by doc_id order by i) - length(line) - 1 as at, lead(line) over (partition by doc_id order by i) as line2 from lines),
pairs as (select doc_id, i, line, line2 from placed where line2 is not null and (regexp_matches(line, '[^\x20\x09-\x0D]') or regexp_matches(line2, '[^\x20\x09-\x0D]'))),
firsts as (select doc_id, i, first_value(doc_id) over w as d0, first_value(i) over w as i0 from pairs window w as (partition by line, line2 order by doc_id, i)),
hits as (select doc_id, i from firsts where doc_id <> d0 or i >= i0 + 2),
gone as (select doc_id, i from hits union select doc_id, i + 1 from hits),
runs as (select doc_id, min(i) as a, max(i) as b from (select doc_id, i, i - row_number() over (partition by doc_id order by i) as g from gone) group by doc_id, g),
spans as (select r.doc_id, x.at as s, y.at + length(y.line) + case when y.i < y.n then 1 else 0 end as e from runs r join placed x on x.doc_id = r.doc_id and x.i = r.a join placed y on y.doc_id = r.doc_id and y.i = r.b),
listed as (select doc_id, count(*) as k, string_agg(s::varchar || '-' || e::varchar, ' ' order by s) as spans from spans group by doc_id),
kept as (select p.doc_id, string_agg(line || case when p.i < n then chr(10) else '' end, '' order by p.i) as t from placed p left join gone g on g.doc_id = p.doc_id and g.i = p.i where g.i is null group by p.doc_id)
select d.doc_id, case when d.text is null then 0 else len(string_split(d.text, chr(10))) end::bigint as n_lines, coalesce(l.k, 0)::bigint as n_removed_runs, coalesce(length(d.text), 0)::bigint as n_chars,
  coalesce(length(k.t), 0)::bigint as n_kept_chars, sha256(coalesce(k.t, '')) as kept_sha256, coalesce(l.spans, '') as removed_spans
from documents d left join listed l on l.doc_id = d.doc_id left join kept k on k.doc_id = d.doc_id
"""

ARCHIVE = """
with pages_ as (select page_id, coalesce(html, '') as h from pages),
sized as (select page_id, h, octet_length(encode(h)) as n from pages_),
keepers as (select h, max(page_id) as k from sized where n >= 1000 group by h having count(*) > 1)
select page_id, n::bigint as payload_bytes, sha1(s.h) as payload_digest, case when k is not null and page_id is distinct from k then 'revisit' else 'response' end as record_type,
  case when k is not null and page_id is distinct from k then k end as refers_to
from sized s left join keepers k on k.h = s.h and s.n >= 1000
"""

QUALITY = rf"""
with docs as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{WORD}') as w, string_split(coalesce(text, ''), chr(10)) as l from documents),
words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i, len(w) as n from docs),
windows as (select doc_id, i, n, string_agg(word, ' ') over (partition by doc_id order by i rows between current row and 7 following) as x from words),
again as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, x) as k from windows where i <= n - 7) where k > 1),
covered as (select doc_id, count(distinct i + k) as n from again, range(8) as r(k) group by doc_id),
facts as (
  select d.doc_id, t, l, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(list_filter(l, lambda x: regexp_matches(x, '{WORD}'))) - len(list_distinct(list_filter(l, lambda x: regexp_matches(x, '{WORD}')))))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words
  from docs d left join covered c on c.doc_id = d.doc_id
), based as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words as base_failed from facts)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not (
  word_chars < 1.5 * n_words or word_chars > 40 * n_words or 2 * n_symbols > 3 * n_words or 2 * n_dup_lines > len(l)
  or 10 * len(list_filter(regexp_extract_all(t, '{WORD}'), lambda x: regexp_matches(x, '\p{{L}}'))) < 3 * n_words or regexp_matches(t, '[^\x20\x09-\x0D]{{1000}}')
  or 10 * len(regexp_extract_all(t, '[0-9]')) > 7 * word_chars or 10 * len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t\r]*$'))) > 6 * len(l)) as kept
from based
"""

#: Targets of a mix with weights 5, 2, 1 and a cap of three: with the sources that fill up first taken out one by one, the level is the highest that is met.
TARGETS = rf"""
with sizes as (select source, sum(len(regexp_extract_all(coalesce(text, ''), '{WORD}')))::double as n from documents group by source),
weighed as (select *, [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as w from sizes),
levels as (
  select *, (sum(n) over () - coalesce(sum(3 * n) over before, 0)) / (sum(w) over () - coalesce(sum(w) over before, 0)) as level
  from weighed window before as (order by n / w, source nulls last rows between unbounded preceding and 1 preceding)
)
select source, n::bigint as source_size, round(least(3 * n, max(level) over () * w), 4) as target from levels
"""

EDITED = """
with docs as (select doc_id, coalesce(text, '') as t from documents),
placed as (select *, coalesce(lead(t) over (order by doc_id desc), first_value(t) over (order by doc_id desc)) as other from docs)
select doc_id, length(t)::bigint as n_chars, sha256(t) as text_sha256, sha256(substring(t, 1, length(t) - length(t) // 3) || substring(other, 1, length(t) // 3)) as edited_sha256 from placed
"""

SQL = {"op1_near_dedup": NEAR, "op3_suffix_dedup": SUFFIX, "op4_line_dedup": LINES, "op5_warc": ARCHIVE, "op7_quality_rules": QUALITY, "mix_targets": TARGETS, "edited_texts": EDITED}

"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from ..operators.dedup import permutations
from .queries import BUDGET, COLLECTED

W = r"[\p{L}\p{N}_]"
S = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
TOKENS = rf"cast(round_even(len(regexp_extract_all(text, '{W}+|[^\p{{L}}\p{{N}}_{S}]')) * 1.3, 0) as bigint)"
FORM = rf"trim(regexp_replace(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}_{S}]', ' ', 'g'), '[{S}]+', ' ', 'g'))"
HASH = f"sha256({FORM})"


def stripped(x: str) -> str:
    return rf"regexp_replace({x}, '^[{S}]+|[{S}]+$', '', 'g')"


def collapsed(x: str) -> str:
    return stripped(rf"regexp_replace({x}, '\n{{3,}}', chr(10) || chr(10), 'g')")


HEAD = "substr(text, 1, 8000)"
LICENSE = f"""case when regexp_matches({HEAD}, '(?i)GNU LESSER GENERAL PUBLIC LICENSE') then 'LGPL' when regexp_matches({HEAD}, '(?i)GNU GENERAL PUBLIC LICENSE') then 'GPL'
    when regexp_matches({HEAD}, '(?i)Apache License[\\s,]*Version 2\\.0') then 'Apache-2.0' when regexp_matches({HEAD}, '(?i)MIT License|Permission is hereby granted, free of charge') then 'MIT'
    when regexp_matches({HEAD}, '(?i)Creative Commons Attribution 4\\.0') then 'CC-BY-4.0' when regexp_matches({HEAD}, '(?i)Creative Commons Attribution 3\\.0') then 'CC-BY-3.0'
    when regexp_matches({HEAD}, '(?i)NVIDIA (Source Code )?License') then 'NVIDIA-Proprietary' when regexp_matches({HEAD}, '(?i)Mozilla Public License') then 'MPL'
    when regexp_matches({HEAD}, '(?i)Redistribution and use in source and binary forms') then case when regexp_matches({HEAD}, '(?i)Neither the name') then 'BSD-3-Clause' else 'BSD-2-Clause' end end"""
STATUS = f"case when coalesce({LICENSE}, '') = '' then 'no-license' when regexp_matches({LICENSE}, '^(MIT|BSD-[0-9]-Clause|Apache-2\\.0|CC-BY-[0-9]\\.[0-9])$') then {LICENSE} else 'flagged:' || {LICENSE} end"
DOCS = f"(select doc_id, source as source_id, lang as grp, doc_id as ord, text, {TOKENS} as n_tokens from documents)"


def quota(rows: str, source: str = "source_id") -> str:
    return f"""(select *, coalesce(sum(n_tokens) over (partition by {source} order by rank, grp, ord rows between unbounded preceding and 1 preceding), 0)::bigint as tokens_before
      from (select *, row_number() over (partition by {source}, grp order by ord) as rank from {rows}))"""


PLAIN = rf"regexp_replace(lower(strip_accents(text)), '[{S}]+', ' ', 'g')"
#: Stripped lines near the top and bottom of pages, of which here every line is one.
EDGES = rf"""
  with p as (select doc_id, list_transform(string_split(text, chr(10)), lambda x: list_filter([{stripped('x')}], lambda y: y <> '')) as pages, len(string_split(text, chr(10))) as n from documents),
  e as (select doc_id, n, unnest(flatten(list_transform(pages, lambda x: list_concat(x[1:2], x[greatest(1, len(x) - 1):len(x)])))) as line from p where n >= 4),
  c as (select doc_id, line from e group by doc_id, n, line having count(*) >= greatest(2, floor(n * 0.5)))
  select d.doc_id, coalesce((select string_agg(line, '|' order by line) from c where c.doc_id = d.doc_id), '') as edges from documents d"""

NUMBERS = r"list_transform(regexp_extract_all(text, '-?\p{Nd}+(?:[.,]\p{Nd}+)?'), lambda x: try_cast(replace(x, ',', '.') as double))"
GENERATED = "regexp_matches(lower(substr(text, 1, 1500)), 'do not edit|do not modify|automatically generated|autogenerated|auto-generated|@generated|generated by')"
BIB = rf"\n[{S}]*(?:References|REFERENCES|Bibliography|BIBLIOGRAPHY)[{S}]*\n"

#: Lines of texts with their places: rows (doc_id, i, line) of a list of lines.
def numbered(lists: str, name: str = "line") -> str:
    return f"select doc_id, unnest(range(1, len(l) + 1)) as i, unnest(l) as {name} from ({lists})"


LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
#: Lines of a page; an end of the last one opens no other.
PAGE_LINES = f"list_transform(list_transform(pages, lambda p: string_split_regex(p, '{LINE_ENDS}')), lambda l: case when l[-1] = '' then l[1:-2] else l end)"

PDF_CLEAN = rf"""
  with p as (select doc_id, string_split(text, chr(10) || chr(10)) as pages from documents),
  l as (select doc_id, len(pages) as n, {PAGE_LINES} as lines from p),
  full_lines as (select doc_id, n, list_transform(lines, lambda x: list_filter(list_transform(x, lambda y: {stripped('y')}), lambda y: y <> '')) as pages from l where n >= 4),
  e as (select doc_id, n, unnest(flatten(list_transform(pages, lambda x: list_concat(x[1:2], x[greatest(1, len(x) - 1):len(x)])))) as line from full_lines),
  edges as (select doc_id, line from e group by doc_id, n, line having count(*) >= greatest(2, floor(n * 0.5))),
  each as ({numbered('select doc_id, flatten(lines) as l from l')}),
  kept as (select doc_id, i, regexp_replace(line, '[{S}]+$', '') as line from each where not exists (select 1 from edges where edges.doc_id = each.doc_id and edges.line = {stripped('each.line')})),
  joined as (select doc_id, string_agg(line, chr(10) order by i) as t from kept where not regexp_matches(line, '(?i)^[{S}]*(?:page[{S}]*)?\p{{Nd}}+[{S}]*(?:/[{S}]*\p{{Nd}}+)?[{S}]*$') group by doc_id),
  clean as (select doc_id, {stripped(f"regexp_replace(regexp_replace(regexp_replace(coalesce(t, ''), '({W})-\n({W})', '\1\2', 'g'), '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")} as text from documents left join joined using (doc_id))
  select doc_id, case when length(text) > 40000 then regexp_replace(substr(text, 1, 40000), '[{S}]+$', '') || chr(10) || '[... truncated ...]' else text end as text from clean"""

OLDER_SIGNS = r"regexp_replace(regexp_replace(page, '\x{FEFF}', '', 'g'), '[\x00-\x08\x0b\x0e-\x1f\x7f\x{FFFD}\x{E000}-\x{F8FF}]', '', 'g')"
for _pattern, _sign in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("[•▪●–—]", "-"), ("[‘’]", "''"), ("[“”]", '"')):
    OLDER_SIGNS = f"regexp_replace({OLDER_SIGNS}, '{_pattern}', '{_sign}', 'g')"
OLDER_DROPPED = rf"""regexp_matches(x, '(?i)^(?:page[{S}]*)?\(?[{S}]*\p{{Nd}}{{1,4}}[{S}]*\)?(?:[{S}]*(?:/|of|-)[{S}]*\p{{Nd}}{{1,4}})?[{S}]*$') or regexp_matches(x, '^[{S}\-_=~*#•·.]{{3,}}$') or regexp_matches(x, '(?i)^(?:©|\(c\)|copyright)') or regexp_matches(x, '(?i)^(?:www\.|https?://)')"""
PDF_CLEAN_OLDER = rf"""
  with p as (select doc_id, list_transform(string_split(replace(text, chr(10) || chr(10), chr(12)), chr(12)), lambda page: {OLDER_SIGNS}) as pages from documents),
  f as (select doc_id, len(pages) as n, list_transform({PAGE_LINES}, lambda l: list_filter(list_transform(l, lambda y: {stripped('y')}), lambda y: y <> '')) as pages from p where len(pages) >= 3),
  e as (select doc_id, n, unnest(flatten(list_transform(pages, lambda x: list_distinct(list_concat(x[1:3], x[greatest(1, len(x) - 2):len(x)]))))) as line from f),
  edges as (select doc_id, line from e where length(line) >= 4 group by doc_id, n, line having count(*) >= greatest(2, floor(n * 0.4))),
  l as ({numbered('select doc_id, flatten(list_transform(pages, lambda p: string_split(p, chr(10)))) as l from p')}),
  c as (select doc_id, i, regexp_replace({stripped(rf"regexp_replace(line, '(?:\.[{S}]*){{3,}}', ' ', 'g')")}, '[ \t]{{2,}}', ' ', 'g') as x from l),
  k as (select * from c where length(x) >= 3 and not exists (select 1 from edges where edges.doc_id = c.doc_id and edges.line = x) and not ({OLDER_DROPPED}) and length(regexp_replace(x, '[^\p{{L}}\p{{N}}]', '', 'g')) >= greatest(3, floor(length(x) * 0.3))),
  u as (select *, lag(x) over (partition by doc_id order by i) as last from k),
  j as (select doc_id, string_agg(x, '' order by i) as t from u where last is null or x <> last group by doc_id)
  select doc_id, '[ROBOT:' || source || ']' || chr(10) || coalesce(t, '') as text from documents left join j using (doc_id)"""

#: Bands one after the other: a line that is one of the last four kept is left out.
BAND_MERGE = rf"""
  with recursive p as (select doc_id, string_split(text, chr(10) || chr(10)) as pages from documents),
  l as (select doc_id, list_filter(list_transform(flatten({PAGE_LINES}), lambda y: {stripped('y')}), lambda y: y <> '') as l from p),
  r(doc_id, i, recent, kept) as (select doc_id, 0, []::varchar[], null::varchar from l
    union all select r.doc_id, r.i + 1, case when list_contains(recent, l.l[r.i + 1]) then recent else list_append(recent, l.l[r.i + 1])[-4:] end, case when list_contains(recent, l.l[r.i + 1]) then null else l.l[r.i + 1] end
      from r join l using (doc_id) where r.i < len(l.l))
  select doc_id, coalesce(string_agg(kept, chr(10) order by i), '') as text from r group by doc_id"""

ARTICLE = r"""regexp_extract(html, '(?is)<article[^>]*class="[^"]*ltx_document[^"]*".*?</article>')"""


def without_elements(x: str) -> str:
    for name in ("script", "style", "nav", "footer", "head", "noscript", "svg", "math"):
        x = rf"regexp_replace({x}, '(?is)<{name}\b.*?</{name}>', ' ', 'g')"
    return x


def unescaped(x: str) -> str:
    for entity, sign in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("nbsp", " "), ("amp", "&")):
        x = f"replace({x}, '&{entity};', '{sign}')"
    return x


BLOCKS = rf"regexp_replace(regexp_replace({without_elements('body')}, '(?i)</(p|div|section|h\d|li|tr|figcaption)>', chr(10), 'g'), '(?s)<[^>]+>', ' ', 'g')"
TIDY = f"array_to_string(list_transform(string_split(regexp_replace({unescaped(BLOCKS)}, '[ \\t]+', ' ', 'g'), chr(10)), lambda x: {stripped('x')}), chr(10))"
HTML = rf"""with b as (select page_id, case when {ARTICLE} <> '' then {ARTICLE} else html end as body from pages)
  select page_id, {stripped(f"regexp_replace({TIDY}, '\n[{S}]*\n+', chr(10) || chr(10), 'g')")} as text from b"""

MACROS = rf"regexp_replace(regexp_replace(regexp_replace(text, '\\[a-zA-Z@]+\*?', ' ', 'g'), '(?m)^[{S}]*\[[{S}]*\][{S}]*', '', 'g'), '(?m)^[{S}]*[\*∗†‡§¶,;:]+[{S}]*$', '', 'g')"
OWN_ABSTRACT = rf"(?im)^[{S}]*(?:\d+[{S}]*)?abstract[{S}]*[:.\-—]?[{S}]*$"
INLINE_ABSTRACT = rf"(?im)^[{S}]*abstract(?:[ \t]+[^{S}]|[ \t]*[:.\-—][ \t]*[^{S}]|[^\p{{L}}\p{{N}}_{S}])"
LATEX = rf"""
  with m as (select doc_id, {MACROS} as t from documents),
  h as (select doc_id, t, case when regexp_matches(substr(t, 1, 4000), '{OWN_ABSTRACT}') then length(string_split_regex(substr(t, 1, 4000), '{OWN_ABSTRACT}')[1])
    when regexp_matches(substr(t, 1, 4000), '{INLINE_ABSTRACT}') then length(string_split_regex(substr(t, 1, 4000), '{INLINE_ABSTRACT}')[1]) else 0 end as a from m),
  l as ({numbered('select doc_id, string_split(substr(t, a + 1), chr(10)) as l from h')}),
  b as (select *, nullif({stripped('line')}, '') as bare from l),
  k as (select *, lag(bare ignore nulls) over (partition by doc_id order by i) as last from b),
  j as (select doc_id, string_agg(line, chr(10) order by i) as t from k where bare is null or last is null or bare <> last group by doc_id)
  select doc_id, {collapsed(r"regexp_replace(t, '[ \t]{2,}', ' ', 'g')")} as text from j"""

#: Texts with roles, anchors and directives written into them, and what is left: directives by recursion over lines.
RST_INPUT = r"""replace(replace(text, chr(10) || chr(10), chr(10) || '.. image:: x' || chr(10) || '   :alt: y' || chr(10) || chr(10)), ' of ', ' :ref:`of` ') || chr(10) || ':orphan:' || chr(10) || '.. _a:' || chr(10) || '.. note::' || chr(10) || chr(9) || 'kept'"""
RST = rf"""
  with recursive m as (select doc_id, regexp_replace(regexp_replace({RST_INPUT}, '(?m)^[ \t]*:orphan:[ \t]*$\n?', '', 'g'), '(?m)^[ \t]*\.\.[ \t]+_[^:]+:[ \t]*$\n?', '', 'g') as t from documents),
  l as (select doc_id, string_split(t, chr(10)) as l from m),
  r(doc_id, i, scope, gone, out) as (select doc_id, 0, -1, false, []::varchar[] from l
    union all select doc_id, i + 1, case when inside then scope when opens then depth else -1 end, inside or (gone and not closes and scope >= 0),
      case when inside then [] when closes and gone then case when opens then [''] else ['', line] end when opens then [] else [line] end
    from (select *, scope >= 0 and ({stripped('line')} = '' or depth > scope) as inside, scope >= 0 and not ({stripped('line')} = '' or depth > scope) as closes,
        regexp_matches(line, '^[ \t]*\.\.[ \t]+(?i:toctree|image|figure|only|raw|contents|highlight|index|meta|redirect-from|include|tab-set|tabs|youtube|graphviz|sectionauthor|codeauthor)::') as opens
      from (select r.*, l.l[i + 1] as line, length(l.l[i + 1]) - length(ltrim(l.l[i + 1], ' ' || chr(9))) as depth from r join l using (doc_id) where i < len(l.l)))),
  e as (select doc_id, i, out, gone and scope >= 0 and i = max(i) over (partition by doc_id) as ends from r),
  j as (select doc_id, array_to_string(flatten(list(out order by i)), chr(10)) || case when bool_or(ends) then chr(10) else '' end as t from e group by doc_id)
  select doc_id, {collapsed(r"regexp_replace(t, ':[a-z:]+:`([^`]+)`', '\1', 'g')")} as text from j"""

#: Secrets masked step by step; a value that is a placeholder stays.
ASSIGNED = r"""((?i:api_?key|secret|token|passw(?:or)?d)["''\'']?\s*[:=]\s*["''\'']?)[A-Za-z0-9+/_\-]{16,}={0,2}""".replace(r"''\''", "''")
PLACEHOLDER = r"(?i)^(?:your|my|some|example|placeholder|x{3,}|\*{3,}|<|\$\{)"
SCRUBBED = rf"""
  a as (select doc_id, text, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*?-----END [A-Z ]*PRIVATE KEY-----', '[REDACTED:private_key]', 'g'),
      '(://[^\s/:@<>]+:)[^\s/@<>]*[^\s/@<>*][^\s/@<>]*@', '\1[REDACTED:url_credentials]@', 'g'), '\bAKIA[0-9A-Z]{{16}}\b', '[REDACTED:aws_key]', 'g'),
      '\b(?:gh[pousr]_[A-Za-z0-9]{{36,}}|hf_[A-Za-z0-9]{{30,}}|sk-[A-Za-z0-9_\-]{{20,}}|xox[abprs]-[A-Za-z0-9\-]{{10,}}|glpat-[A-Za-z0-9_\-]{{20,}})', '[REDACTED:provider_token]', 'g') as t from documents),
  f as (select *, string_split_regex(t, '{ASSIGNED}') as p, regexp_extract_all(t, '{ASSIGNED}') as m, regexp_extract_all(t, '{ASSIGNED}', 1) as g from a),
  s as (select doc_id, text, array_to_string(list_transform(range(1, len(p) + 1), lambda i: p[i] || case when i > len(m) then '' when regexp_matches(substr(m[i], length(g[i]) + 1), '{PLACEHOLDER}') then m[i] else g[i] || '[REDACTED:assigned_secret]' end), '') as masked from f)"""
KIND_COUNTS = " union all ".join(f"select doc_id, '{k}' as kind, (length(masked) - length(replace(masked, '[REDACTED:{k}]', '')) - length(text) + length(replace(text, '[REDACTED:{k}]', ''))) // length('[REDACTED:{k}]') as n from s" for k in ("private_key", "url_credentials", "aws_key", "provider_token", "assigned_secret"))

#: Hits of the terms of a window rule are whole words; windows are found by recursion over a document's hits.
WORD_RUNS = r"[\p{L}\p{N}_]+"
WINDOWS = rf"""
  plain as (select doc_id, {PLAIN} as t from documents),
  runs as (select doc_id, unnest(range(1, len(m) + 1)) as i, unnest(m) as word, unnest(p[1:len(m)]) as before from (select doc_id, regexp_extract_all(t, '{WORD_RUNS}') as m, string_split_regex(t, '{WORD_RUNS}') as p from plain)),
  placed as (select doc_id, word, sum(length(before) + length(word)) over (partition by doc_id order by i) - length(word) as start from runs),
  hits as (select doc_id, start::bigint as start, word as term, grp, row_number() over (partition by doc_id order by start, word, grp) as n from placed join (values ('and', 0), ('und', 0), ('token', 1), ('license', 1), ('licensed', 1)) v(term, grp) on word = term),
  walk(doc_id, n, open, found) as (select distinct doc_id, 0::bigint, []::struct(start bigint, term varchar, grp integer)[], null::struct(start bigint, term varchar, grp integer)[] from hits
    union all select doc_id, n, case when len(list_distinct(list_transform(near, lambda x: x.grp))) = 2 then [] else near end, case when len(list_distinct(list_transform(near, lambda x: x.grp))) = 2 then near end
    from (select h.doc_id, h.n, list_append(list_filter(w.open, lambda x: h.start - x.start <= 60), {{'start': h.start, 'term': h.term, 'grp': h.grp}}) as near from walk w join hits h on h.doc_id = w.doc_id and h.n = w.n + 1)),
  windows as (select doc_id, n, found[1].start as position, array_to_string(list_sort(list_distinct(list_transform(found, lambda x: x.term))), '+') as terms from walk where found is not null)"""
PHRASES = rf"""
  phrases as (select doc_id, phrase, place, length(regexp_extract(t, '^(?s)(.*?)(?:^|[^\p{{L}}\p{{N}}_])' || phrase || '(?:[^\p{{L}}\p{{N}}_]|$)', 1))::bigint + case when regexp_matches(t, '^' || phrase || '(?:[^\p{{L}}\p{{N}}_]|$)') then 0 else 1 end as position
    from plain, (values ('of the', 1), ('de la', 2)) v(phrase, place) where regexp_matches(t, '(^|[^\p{{L}}\p{{N}}_])' || phrase || '([^\p{{L}}\p{{N}}_]|$)'))"""

#: All sequences of four to seven words of the benchmark, looked for in every text.
BENCHMARK = rf"""
  with w as (select list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') as w from benchmark where text is not null),
  phrases as (select distinct array_to_string(w[i:i + n - 1], ' ') as phrase from (select w, n, unnest(range(1, len(w) - n + 2)) as i from w, (values (4), (5), (6), (7)) v(n))),
  forms as (select phrase, {PLAIN.replace("text", "phrase")} as form from phrases),
  plain as (select doc_id, {PLAIN} as t from documents),
  met as (select doc_id, t, phrase, regexp_escape(form) as e from plain join forms on contains(t, form)),
  hits as (select * from met where regexp_matches(t, '(?:^|[^\p{{L}}\p{{N}}_])' || e || '(?:[^\p{{L}}\p{{N}}_]|$)')),
  firsts as (select doc_id, count(*) as n_phrases, min(phrase) as first_phrase, first(struct_pack(t, e) order by phrase) as f from hits group by doc_id)
  select doc_id, n_phrases, first_phrase, length(regexp_extract(f.t, '^(?s)(.*?)(?:^|[^\p{{L}}\p{{N}}_])' || f.e || '(?:[^\p{{L}}\p{{N}}_]|$)', 1))::bigint + case when regexp_matches(f.t, '^' || f.e || '(?:[^\p{{L}}\p{{N}}_]|$)') then 0 else 1 end as position from firsts"""

#: crc32 by the table of each byte at each distance from the end, and of the start value; then all permutations.
CRC = f"""
  t1 as (select b, list_reduce(list_concat([b::bigint], range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as t from (select unnest(range(256)) as b)),
  tables(k, b, t) as (select 1, b, t from t1 union all select k + 1, x.b, xor(x.t >> 8, t1.t) from tables x join t1 on t1.b = x.t & 255 where k < 400),
  zeros(k, z) as (select 0, 4294967295::bigint union all select k + 1, xor(z >> 8, t) from zeros join t1 on b = z & 255 where k < 400)"""
SIGNATURES = f"""
  w as (select doc_id, {FORM} as form, string_split({FORM}, ' ') as w from documents),
  sh as (select doc_id, unnest(case when form = '' then []::varchar[] when len(w) <= 5 then [form] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from w),
  ds as (select row_number() over () as id, s, hex(encode(s)) as h from (select distinct s from sh)),
  bytes as (select id, length(h) // 2 as size, unnest(range(length(h) // 2)) as i, h from ds),
  crcs as (select id, xor(xor(bit_xor(t), any_value(z)), 4294967295) as crc from bytes join tables on k = size - i and b = ('0x' || substr(h, 2 * i::int + 1, 2))::int join zeros on zeros.k = size group by id),
  sc as (select distinct doc_id, crc from sh join ds using (s) join crcs using (id)),
  perms(p, a, b) as (values {", ".join(f"({i}, {a}::hugeint, {b}::hugeint)" for i, (a, b) in enumerate(permutations()))}),
  mins as (select doc_id, p, min((a * crc + b) % 2305843009213693951 & 4294967295::hugeint)::bigint as v from sc, perms group by doc_id, p),
  sig as (select doc_id, coalesce(list(v order by p) filter (v is not null), list_transform(range(128), lambda i: 4294967295::bigint)) as s from documents left join mins using (doc_id) group by doc_id)"""
#: First-wins decision by recursion over the entries in order; it carries the dropped ones.
GREEDY = f"""
  with recursive {CRC.strip()}, {SIGNATURES.strip()},
  firsts as (select doc_id, {HASH} as hash, min(doc_id) over (partition by {HASH}) as first from documents),
  bands as (select doc_id, unnest(range(16)) as band, unnest(list_transform(range(16), lambda i: s[8 * i + 1:8 * i + 8])) as part from sig),
  met as (select x.doc_id as early, y.doc_id as late, min(x.band) as band from bands x join bands y on x.band = y.band and x.part = y.part and x.doc_id < y.doc_id
    where x.doc_id in (select first from firsts) group by x.doc_id, y.doc_id),
  scored as (select m.*, len(list_filter(list_zip(p.s, q.s), lambda z: z[1] = z[2])) / 128.0::double as sim from met m join sig p on p.doc_id = early join sig q on q.doc_id = late),
  near_pairs as (select early, late, band, sim from scored where sim >= 0.85),
  nodes as (select row_number() over (order by late) as n, late, earlies from (select late, list(early) as earlies from near_pairs where late in (select first from firsts) group by late)),
  walk(n, dropped) as (select 0::bigint, []::bigint[] union all select nodes.n, case when len(list_filter(earlies, lambda e: not list_contains(dropped, e))) > 0 then list_append(dropped, late) else dropped end from walk join nodes on nodes.n = walk.n + 1),
  gone as (select unnest(dropped) as doc_id from (select dropped from walk order by n desc limit 1)),
  best as (select late, early, sim, row_number() over (partition by late order by sim desc, band, early) as r from near_pairs where early not in (select doc_id from gone)),
  verdict as (select f.doc_id, case when first in (select doc_id from gone) then 'near' when first < f.doc_id then 'exact' else '' end as kind, first from firsts f)
  select v.doc_id, kind, case kind when 'exact' then first when 'near' then early end as matched, case kind when 'exact' then 1.0::double when 'near' then sim else 0.0 end as similarity
  from verdict v left join best on late = v.doc_id and r = 1"""


def walked(pieces: str, name: str, joint: int) -> str:
    """Recursion over runs of neighbouring pieces (doc_id, part, l: list) that make at most 4000 characters with joints."""
    return f"""{name}_ends as (select *, list_transform(range(0, len(l) + 1), lambda i: coalesce(list_sum(list_transform(l[1:i], lambda x: length(x) + {joint})), 0)::bigint) as ends from ({pieces})),
  {name}(doc_id, part, here, until, run) as (select doc_id, part, 0::bigint, 0::bigint, null::varchar from {name}_ends
    union all select doc_id, part, until, after, case when length(l[until + 1]) > 0 then array_to_string(l[until + 1:after], case {joint} when 1 then chr(10) else '' end) end
      from (select w.doc_id, w.part, w.until, e.l, case when length(e.l[w.until + 1]) = 0 then w.until + 1 else greatest(w.until + 1, len(list_filter(e.ends, lambda x: x <= e.ends[w.until + 1] + 4000 + {joint})) - 1) end as after
        from {name} w join {name}_ends e using (doc_id, part) where w.until < len(e.l)))"""


#: Long texts by paragraphs; a paragraph that is too long by lines, and lines by length.
SPLIT = rf"""
  with recursive long_texts as (select doc_id, text, regexp_extract_all(text, '\n\s*\n') as m, string_split_regex(text, '\n\s*\n') as p from documents where length(text) > 4000),
  {walked("select doc_id, 0 as part, list_filter(list_transform(range(1, len(p) + 1), lambda i: case when i = 1 then '' else m[i - 1] end || p[i]), lambda x: x <> '') as l from long_texts", "sections", 0)},
  runs as (select doc_id, until as place, run, regexp_replace(run, '^\n\s*\n', '') as bare from sections where run is not null),
  {walked("select doc_id, place as part, string_split(bare, chr(10)) as l from runs where length(run) > 4000 and length(bare) > 4000", "rows", 1)},
  parts as (select doc_id, place as a, 0::bigint as b, 0::bigint as c, case when length(run) > 4000 then bare else run end as t from runs where length(run) <= 4000 or length(bare) <= 4000
    union all select doc_id, part, until, unnest(range(0, length(run), 4000)), unnest(list_transform(range(0, length(run), 4000), lambda i: substr(run, i + 1, 4000))) from rows where run is not null),
  every as (select doc_id, a, b, c, {stripped('t')} as t from parts union all select doc_id, 0, 0, 0, text from documents where length(text) <= 4000)
  select doc_id, row_number() over (partition by doc_id order by a, b, c) as part_no, length(t)::bigint as n_chars, sha256(t) as sha256 from every where t <> '' or doc_id not in (select doc_id from long_texts)"""

#: The whole build: masked texts, those without a window of terms, first-wins duplicates, and the budget.
BUILD = f"""
  with masked_docs as (with {SCRUBBED.strip()} select documents.* replace (masked as text) from documents join (select doc_id, masked from s) using (doc_id)),
  dirty as (with recursive documents as (select * from masked_docs), {WINDOWS.strip()} select distinct doc_id from windows),
  clean as materialized (select * from masked_docs where doc_id not in (select doc_id from dirty)),
  verdicts as ({GREEDY.strip().replace("with recursive", "with recursive documents as (select * from clean),", 1)}),
  documents as (select clean.* from clean join verdicts using (doc_id) where kind = '')
  select ord as doc_id, source_id, n_tokens from {quota(DOCS)} where tokens_before < {BUDGET}"""

#: The robots of the nations: a chain of links, each turned by 0.5 about z and moved by (0.25, 0, 0.1) in the frame before.
ROBOTS = """
  s as (select s_nationkey as r, s_suppkey as n, s_acctbal, row_number() over (partition by s_nationkey order by s_suppkey) as k, ['revolute', 'fixed', 'planar', 'prismatic', 'ball'][s_suppkey % 5 + 1] as kind from supplier),
  moved as (select *, coalesce(sum(0.25 * cos(0.5 * (k - 2))) filter (k > 1) over w, 0) as x, coalesce(sum(0.25 * sin(0.5 * (k - 2))) filter (k > 1) over w, 0) as y, 0.1 * (k - 1) as z from s window w as (partition by r order by k)),
  j as (select *, kind in ('revolute', 'prismatic') as driven from moved where k > 1),
  kinds as (select r, string_agg(kind || ':' || n, ',' order by kind) as joint_types from (select r, kind, count(*) as n from j group by r, kind) group by r),
  joints as (select r, count(*) as n_joints, sum(case kind when 'revolute' then 1 when 'prismatic' then 1 when 'planar' then 3 else 0 end)::bigint as dof, count(*) filter (driven) as actuated_joint_count,
    max(n % 50) filter (driven)::double as max_joint_effort, max(2.0::double) filter (driven) as max_joint_velocity, round_even(sum(n % 7 + 0.5 + n % 4) filter (driven), 4)::double as sum_actuated_range_rad_or_m from j group by r),
  links as (select r, count(*) as n_links, count(*) filter (n % 3 = 0) as links_without_mass, round_even(sum(s_acctbal) filter (n % 3 > 0), 4)::double as total_mass_kg, 's' || min(n) as root_link, round_even(max(sqrt(x * x + y * y + z * z)), 4)::double as kinematic_span_m from moved group by r)"""


ORACLE_SQL = {
    "flagship_build": f"""with d as (select *, row_number() over (partition by {HASH} order by doc_id) as copy from {DOCS})
        select source_id, count(*) as candidates, count(*) filter (tokens_before < {BUDGET}) as kept, coalesce(sum(n_tokens) filter (tokens_before < {BUDGET}), 0)::bigint as tokens
        from {quota('(select * exclude (copy) from d where copy = 1)')} group by 1""",
    "token_count_approx": f"select doc_id, {TOKENS} as n_tokens from documents",
    "token_count_legacy": "select doc_id, greatest(1, length(text) // 4)::bigint as n_tokens from documents",
    "normalize_hash": f"select doc_id, {HASH} as hash from documents",
    "collapse_blank_lines": f"select doc_id, {collapsed('text')} as text from documents",
    "generated_filter": f"select doc_id, {GENERATED} as generated from documents",
    "markdown_clean": f"""select doc_id, {collapsed("regexp_replace(regexp_replace(regexp_replace(text, '(?s)^---\\n.*?\\n---\\n', ''), '(?s)<!--.*?-->', '', 'g'), '(?m)^\\[!\\[[^\\]]*\\]\\([^)]*\\)\\]\\([^)]*\\)[ \\t]*$\\n?', '', 'g')")} as text from documents""",
    "plain_form": f"select doc_id, {PLAIN} as text from documents",
    "number_extract_verify": f"""select doc_id, len({NUMBERS})::bigint as n_numbers,
        len(list_filter({NUMBERS}, lambda v: not (v = floor(v) and v between 0 and 12) and not (abs(v - 100) <= 2 or abs(v - 2024) <= 40.48)))::bigint as n_unsupported from documents""",
    # Texts between headings and the headings, in turn: the lengths before a heading add up to its place.
    "strip_bibliography": f"""with b as (select doc_id, text, string_split_regex(text, '{BIB}') as p, regexp_extract_all(text, '{BIB}') as m from documents),
        h as (select doc_id, list_filter(list_transform(range(1, len(m) + 1), lambda i: length(list_aggregate(p[1:i], 'string_agg', '')) + coalesce(length(list_aggregate(m[1:i - 1], 'string_agg', '')), 0)), lambda place: place > 0.55 * length(text))[1] as place from b)
        select doc_id, case when place is null then text else substr(text, 1, place) end as text from documents join h using (doc_id)""",
    "exact_dedup_first_wins": f"select doc_id, case when first < doc_id then first end as duplicate_of from (select doc_id, min(doc_id) over (partition by {HASH}) as first from documents)",
    "id_collision": "select ord from (select doc_id as ord, row_number() over (partition by doc_id % 700 order by doc_id) as n from documents) where n > 1",
    "quota_round_robin": f"select ord as doc_id, source_id, rank, tokens_before from {quota(DOCS)} where tokens_before < {BUDGET}",
    "quota_dropped": f"select ord as doc_id from {quota(DOCS)} where tokens_before >= {BUDGET}",
    "quota_scaled": f"select source_id, count(*) as n_docs, sum(n_tokens)::bigint as tokens from {quota(DOCS)} where tokens_before < floor({BUDGET + 1} * 0.75) group by 1",
    "quota_scales": f"select percent, source_id, count(*) as n_docs, sum(n_tokens)::bigint as tokens from {quota(DOCS)}, (values (25), (50), (75)) v(percent) where tokens_before < floor({BUDGET + 1} * percent / 100.0) group by 1, 2",
    "quota_pooled": f"select ord as doc_id, source_id, tokens_before from {quota(f'''(select 'all' as pool, source_id as grp, * exclude (grp) from {DOCS})''', 'pool')} where tokens_before < {5 * BUDGET}",
    "contamination_phrases": f"""select doc_id, phrase, length(regexp_extract(plain, '^(?s)(.*?)(?:^|[^\\p{{L}}\\p{{N}}_])' || phrase || '(?:[^\\p{{L}}\\p{{N}}_]|$)', 1))::bigint
          + case when regexp_matches(plain, '^' || phrase || '(?:[^\\p{{L}}\\p{{N}}_]|$)') then 0 else 1 end as position
        from (select doc_id, {PLAIN} as plain from documents), (values ('of the'), ('de la')) v(phrase)
        where regexp_matches(plain, '(^|[^\\p{{L}}\\p{{N}}_])' || phrase || '([^\\p{{L}}\\p{{N}}_]|$)')""",
    "license_detect": f"select doc_id, {LICENSE} as license from documents",
    "license_gate": f"select doc_id, {STATUS} as status, case when {STATUS} = 'no-license' then source = 'src3' else {STATUS} not like 'flagged:%' end as collectible from documents",
    "license_mismatch": f"select doc_id, 'MIT' as license_declared, {LICENSE} as license_detected from documents where {LICENSE} <> 'MIT'",
    "header_footer_removal": EDGES,
    "stats_by_source": f"""select source_id, count(*) as n_docs, sum(n_tokens)::bigint as tokens, sum(n_tokens)::bigint * 100.0::double / (sum(sum(n_tokens)) over ())::bigint as share_pct, sum(n_tokens)::bigint // count(*) as mean_tokens from {DOCS} group by 1""",
    "stats_total": f"select coalesce(source_id, 'TOTAL') as source_id, count(*) as n_docs, sum(n_tokens)::bigint as tokens from {DOCS} group by rollup (source_id)",
    "stats_sources": f"""select source_id, count(*) as candidates, count(*) filter (ord % 3 > 0) as "unique", count(*) filter (ord % 15 > 0 and ord % 3 > 0 and ord % 5 > 0) as kept,
        coalesce(sum(n_tokens) filter (ord % 3 > 0 and ord % 5 > 0), 0)::bigint as tokens, coalesce(sum(n_tokens) filter (ord % 3 > 0 and ord % 5 > 0), 0) > {BUDGET} as over_budget from {DOCS} group by 1""",
    "stats_distribution": f"select quantile_cont(n_tokens, 0.5)::double as median, quantile_cont(n_tokens, 0.95)::double as p95, max(n_tokens)::bigint as largest from {DOCS}",
    "category_mix": f"""with b(category, low, high) as (values ('cat1', 0.60::double, 0.70::double), ('cat2', 0.15, 0.25), ('cat3', 0.10, 0.15)),
        t as (select case grp when 'en' then 'cat1' when 'fr' then 'cat2' else 'cat3' end as category, sum(n_tokens)::bigint as tokens from {DOCS} group by 1)
        select category, coalesce(tokens, 0)::bigint as tokens, coalesce(tokens, 0)::double / (select sum(tokens) from t)::double as share, (coalesce(tokens, 0)::double / (select sum(tokens) from t)::double) between low and high as in_band from b left join t using (category)""",
    "outcome_counts": """select 0::bigint as fail, count(*) filter (n_chars >= 100 and lang = 'de') as warn, count(*) filter (n_chars < 100) as skip, count(*) filter (n_chars >= 100 and lang <> 'de') as ok from documents""",
    "assemble_record": f"""select 'cat1-' || doc_id || '-docs' as id, source, 'cat1' as category, 'A' as tier, {STATUS} as license, '' as url, 'en' as lang, text, {TOKENS} as n_tokens, false as n_tokens_exact, 'docs' as source_type, doc_id % 3 = 0 as ocr, '{COLLECTED}' as collected_at, case when doc_id % 3 = 0 then round_even((doc_id % 97) / 97.0::double, 4)::double end as ocr_confidence from documents""",
    "validate_record": f"select 'cat1-' || doc_id || '-docs' as id, not ({TOKENS} > 20) as invalid from documents",
    "merge_union": f"""select category, case category when 'cat1' then 0 when 'cat2' then 1 else 2 end::bigint as place, count(*) as n_docs, sum(n_tokens)::bigint as tokens
        from (select case grp when 'en' then 'cat1' when 'fr' then 'cat2' else 'cat3' end as category, n_tokens from {DOCS}) group by 1""",
    "urdf_capabilities": f"""with {ROBOTS.strip()}
        select r as robot_id, 'nation ' || r as robot_name, n_links, coalesce(n_joints, 0) as n_joints, coalesce(dof, 0) as dof, coalesce(actuated_joint_count, 0) as actuated_joint_count, links_without_mass, 1::bigint as n_root_links, 1::bigint as n_leaf_links,
        total_mass_kg, max_joint_effort, max_joint_velocity, sum_actuated_range_rad_or_m, root_link, kinematic_span_m, coalesce(joint_types, '') as joint_types from links left join joints using (r) left join kinds using (r)""",
    "urdf_description": f"""with {ROBOTS.strip()}
        select r as robot_id, 'nation ' || r || ' is described by a URDF model with ' || n_links || ' links and ' || coalesce(n_joints, 0) || ' joints, totalling ' || coalesce(dof, 0) || ' degrees of freedom across ' || coalesce(actuated_joint_count, 0) || ' actuated joints.' as opening from links left join joints using (r)""",
    "urdf_document": f"""with {ROBOTS.strip()},
        said as (select r, string_agg(c || ' ' || kind, ', ' order by f) as kinds_said from (select r, kind, count(*) as c, min(k) as f from j group by r, kind) group by r),
        p as (select *, lag(n) over (partition by r order by k) as parent from s),
        joint_lines as (select r, string_agg('  <joint name="j' || n || '" type="' || kind || '">' || chr(10) || '    <parent link="s' || parent || '"/>' || chr(10) || '    <child link="s' || n || '"/>' || chr(10) || '    <origin xyz="0.25 0 0.1"/>' || chr(10)
          || '    <limit lower="-' || n % 4 || '" upper="' || n % 7 || '.5" effort="' || n % 50 || '" velocity="2"/>' || chr(10) || '  </joint>' || chr(10), '' order by k) as l from p where k between 2 and 61 group by r),
        link_lines as (select r, string_agg('  <link name="s' || n || '"/>' || chr(10), '' order by k) as l from s group by r)
        select r as robot_id, concat_ws(' ', 'nation ' || r || ' is described by a URDF model with ' || n_links || ' links and ' || coalesce(n_joints, 0) || ' joints, totalling ' || coalesce(dof, 0) || ' degrees of freedom across ' || coalesce(actuated_joint_count, 0) || ' actuated joints.',
            'Its joints break down as: ' || kinds_said || '.', 'The summed link mass is ' || total_mass_kg || ' kg.', 'The strongest actuated joint is rated at ' || max_joint_effort || ' (effort units as declared in the URDF).',
            'The highest declared joint velocity limit is ' || max_joint_velocity || '.', 'At its zero configuration the kinematic structure spans about ' || kinematic_span_m || ' m from the base link (an extent proxy, not a sampled workspace).',
            'The kinematic tree is rooted at link ' || chr(39) || root_link || chr(39) || ' and has 1 leaf links.')
          || chr(10) || chr(10) || '```urdf' || chr(10) || '<robot name="nation ' || r || '">' || chr(10) || link_lines.l || coalesce(joint_lines.l, '')
          || case when n_joints > 60 then '  <!-- ... ' || (n_joints - 60) || ' additional joints omitted -->' || chr(10) else '' end || '</robot>' || chr(10) || '```' as text
        from links left join joints using (r) left join said using (r) join link_lines using (r) left join joint_lines using (r)""",
    "budget_by_family": "select n_regionkey::varchar as family, string_agg(n_name, ',' order by n_name) as sources, sum(n_nationkey * 1000)::bigint as token_budget, (select sum(n_nationkey * 1000)::bigint from nation) as total_budget from nation group by 1",
    "stats_by_license": f"select {STATUS} as license_status, substr(source, 4, 1) as lang, count(*) as n_docs, sum({TOKENS})::bigint as tokens, sum({TOKENS})::bigint // count(*) as mean_tokens from documents group by 1, 2",
    "stats_all_dimensions": f"""with d as (select source, lang, {STATUS} as license, {TOKENS} as n from documents)
        select case when grouping(source) = 0 then 'source' when grouping(lang) = 0 then 'lang' when grouping(license) = 0 then 'license' else 'TOTAL' end as dimension,
          case when grouping(source) = 0 then source when grouping(lang) = 0 then lang when grouping(license) = 0 then license end as value, count(*) as n_docs, coalesce(sum(n), 0)::bigint as tokens
        from d group by grouping sets ((), (source), (lang), (license))""",
    "stats_quantiles": f"""with d as (select source, lang, {TOKENS} as n from documents where text is not null),
        g as (select source as source_id, null::varchar as grp, list_sort(list(n)) as v from d group by source union all select null, lang, list_sort(list(n)) from d group by lang union all select null, null, list_sort(list(n)) from d)
        select source_id, grp, len(v) as n_docs, v[ceil(len(v) * 0.5)::bigint]::bigint as p50, v[ceil(len(v) * 0.95)::bigint]::bigint as p95 from g""",
    "quarantined_lines": """with w as (select *, '{"doc_id": ' || doc_id || ', "lang": "' || lang || '", "n_chars": ' || case when doc_id % 7 = 3 then '"' || n_chars || ' long"' else n_chars::varchar end || '}' as whole from documents),
          l as (select *, case when doc_id % 11 = 2 then '[' || whole || ']' when doc_id % 5 = 1 then left(whole, 20) else whole end as line,
            case when doc_id % 11 = 2 then 'line that does not fit the schema' when doc_id % 5 = 1 then 'malformed line' when doc_id % 7 = 3 then 'line that does not fit the schema' end as reason from w where doc_id % 13 <> 5)
        select case when reason is null then doc_id end as doc_id, case when reason is null then lang end as lang, case when reason is null then n_chars end as n_chars, case when reason is not null then line end as line, reason from l""",
    "dropped_by_reason": "select case when n_chars < 200 then 'short' else 'language' end as reason, count(*) as n from documents where n_chars < 200 or lang <> 'en' group by 1",
    "papers_represented": "select (select count(distinct doc_id % 90) from documents where n_chars > 4000) as kept, count(distinct doc_id % 90) as pool from documents",
    "manuals_checklist": "select count(*) as manuals, count(*) filter (s_suppkey % 2 = 0) as present, count(*) filter (s_suppkey % 3 = 0) as collectible, count(*) filter (s_suppkey % 6 = 0) as ready from supplier",
    "best_file": "select p_brand as robot_id, coalesce(max(p_name) filter (p_size % 2 = 0), min(p_name)) as file from part group by 1",
    "file_kind": "select doc_id, case doc_id % 5 when 0 then 'PDF' when 1 then 'HTML' when 2 then 'ZIP' when 3 then 'HTML' else 'unknown' end as kind from documents",
    "clean_file": f"""select doc_id, case when doc_id % 3 = 1 then {collapsed("'---' || chr(10) || 'a: b' || chr(10) || '---' || chr(10) || text")}
        else {collapsed("regexp_replace(regexp_replace(text, '(?s)<!--.*?-->', '', 'g'), '(?m)^\\[!\\[[^\\]]*\\]\\([^)]*\\)\\]\\([^)]*\\)[ \\t]*$\\n?', '', 'g')")} end as text from documents""",
    "replaced_rows": "select source as source_id, case when source < 'src13' then doc_id + 1000000 else doc_id end as doc_id from documents",
    "selected_paths": r"""select page_id, (regexp_matches(p, '^en/') or regexp_matches(p, '^f[^/]/[^/]*$')) and not regexp_matches(p, '(^|/)[^/]*top$') and not starts_with(p, 'en/2') and not regexp_matches(p, '(^|/)en/2[^/]*$') as selected
        from (select page_id, regexp_replace(url, '^[a-z]+://[^/]+/?', '') as p from pages)""",
    "excerpts": "select doc_id, case when a > 0 then '...' else '' end || substr(text, a + 1, b - a) || case when b < length(text) then '...' else '' end as excerpt from (select *, greatest(0, doc_id % 300 - 40) as a, least(length(text), doc_id % 300 + 45) as b from documents)",
    "path_functions": r"""with p as (select page_id, regexp_replace(url, '^[a-z]+://[^/]+/?', '') as p from pages), s as (select *, string_split(p, '/') as x, lower(p) as l from p)
        select page_id, case when len(x) = 1 then '(root)' when x[1] in ('source', 'doc', 'docs') and len(x) > 2 then x[1] || '/' || x[2] else x[1] end as grp,
        'web-' || translate(p, '/.', '__') || case when page_id % 2 + 1 > 1 then '-p2' else '' end as doc_id,
        case when contains(l, 'g1') then 'Unitree G1' when contains(l, 'go2') then 'Unitree Go2' when contains(l, 'ranger') then 'AgileX Ranger Mini' when contains(l, 'scout') then 'AgileX Scout' when contains(l, 'husky') then 'Clearpath Husky A200'
          when contains(l, 'spot') then 'Boston Dynamics Spot' when contains(l, 'h1') then 'Unitree H1' when contains(l, 'b2') then 'Unitree B2' when contains(l, 'stretch') then 'Hello Robot Stretch' when contains(l, 'ur10') then 'Universal Robots UR10e'
          when contains(l, 'franka') or contains(l, 'fr3') then 'Franka Research 3' else regexp_replace(p, '(?s)(.)\.[^.]*$', '\1') end as robot from s""",
    "html_to_text": HTML,
    "latex_strip": LATEX,
    "rst_clean": RST,
    "pdf_clean": PDF_CLEAN,
    "ocr_band_merge": BAND_MERGE,
    "pdf_clean_older": PDF_CLEAN_OLDER,
    "scrub_secrets": f"with {SCRUBBED.strip()}, n as (select doc_id, sum(n)::bigint as n_redacted from ({KIND_COUNTS}) group by doc_id) select doc_id, n_redacted, sha256(masked) as sha256 from s join n using (doc_id)",
    "masked_by_kind": f"with {SCRUBBED.strip()} select kind, sum(n)::bigint as n from ({KIND_COUNTS}) group by kind having sum(n) > 0",
    "contamination_inventory": f"with recursive {WINDOWS.strip()}, {PHRASES.strip()} select doc_id, 'words' as rule, phrase as terms, position from phrases union all select doc_id, 'near', terms, position from windows",
    "contamination_check": f"""with recursive {WINDOWS.strip()}, {PHRASES.strip()},
        every as (select doc_id, 'words' as rule, phrase as terms, position, place as o from phrases union all select doc_id, 'near', terms, position, 10 + n from windows),
        firsts as (select *, row_number() over (partition by doc_id order by o) as r from every),
        cut as (select f.*, t, greatest(0, position - 90) as a, least(length(t), position + 90) as b from firsts f join plain using (doc_id) where r = 1)
        select doc_id, rule, terms, position, case when a > 0 then '...' else '' end || substr(t, a + 1, b - a) || case when b < length(t) then '...' else '' end as excerpt from cut""",
    "contamination_benchmark": BENCHMARK,
    "minhash_signature": f"with recursive {CRC.strip()}, {SIGNATURES.strip()} select doc_id, array_to_string(s, ',') as signature from sig",
    "near_dedup_greedy": GREEDY,
    "near_dedup_batches": GREEDY,
    "split_document": SPLIT,
    "category_build": BUILD,
    "ocr_render_plan": """with a as (select doc_id, 300.0::double + doc_id % 900 as w, 400.0::double + n_chars as h from documents),
        b as (select *, greatest(36, least(200, floor(2000 * 72.0::double / w)))::bigint as dpi from a),
        c as (select *, greatest(1, floor(w / 72.0::double * dpi))::bigint as width, greatest(1, floor(h / 72.0::double * dpi))::bigint as height from b)
        select doc_id, dpi, width, height, (greatest(0, ceil((height - 1600) / 1480.0::double)) + 1)::bigint as n_bands from c""",
}

"""DuckDB SQL for the operators whose results SQL can express by comparing all pairs."""

from __future__ import annotations

# Written out here, so that this SQL doesn't agree with the operator's own patterns and bounds by sharing them.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX, MIXED = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}", "[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "owned")

#: (n, c): component c of each node n of links(a, b) in both directions.
REACHED = """
  reached(n, c) as (select id, id from nodes union select l.b, r.c from reached r join links l on l.a = r.n),
  components as (select n, min(c) as c from reached group by n)"""

NEAR_VECTORS = f"""
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings
    where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links as (select x.vec_id as a, y.vec_id as b from v x join v y on x.label = y.label and x.vec_id <> y.vec_id and len(x.e) = len(y.e) and list_cosine_similarity(x.e, y.e) >= 0.93),
  nodes as (select vec_id as id from embeddings), {REACHED}
select vec_id, (select count(*) from links where a = vec_id) as n_links, c as component_id, vec_id = c as kept from embeddings join components on n = vec_id"""

NGRAMS = f"""
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words from documents),
  s as (select doc_id, list_distinct(case when len(words) >= 5 then list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) when len(words) > 0 then [array_to_string(words, ' ')] else [] end) as g from w),
  each as (select doc_id, len(g) as n, unnest(g) as x from s),
  links as (select p.doc_id as a, q.doc_id as b from each p join each q on p.x = q.x and p.doc_id <> q.doc_id group by p.doc_id, q.doc_id, p.n, q.n having 100 * count(*) >= 75 * (p.n + q.n - count(*))),
  nodes as (select doc_id as id from documents), {REACHED}
select doc_id, len(g) as n_shingles, c as component_id from s join components on n = doc_id"""


def _found(kind: int, pattern: str, group: int = 0) -> str:
    quoted = pattern.replace("'", "''")
    return f"select r, s, {kind} as kind, string_split_regex(t, '{quoted}') as p, regexp_extract_all(t, '{quoted}') as m, regexp_extract_all(t, '{quoted}', {group}) as v from d"


_NAMES = "['" + "', '".join(KINDS) + "'][kind + 1]"
_SPAN = f"{_NAMES} || ':' || a || ':' || b"

SECRETS = f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t, coalesce(source, '') as s from documents),
  f as ({_found(0, ASSIGN, 2)} union all {_found(1, ACCESS)} union all {_found(2, HEX)} union all {_found(3, MIXED)}),
  u as (select *, unnest(range(1, len(m) + 1)) as i from f),
  sp as (select r, s, kind, length(array_to_string(p[1:i], '')) + length(array_to_string(m[1:i - 1], '')) as a, length(m[i]) as size, v[i] as val from u),
  ok as (select r, s, kind, a, a + size as b, val from sp where case kind when 0 then length(val) >= 6
    when 3 then regexp_matches(val, '[0-9]') and regexp_matches(val, '[A-Za-z]') and len(list_distinct(string_split(val, ''))) >= 10 else true end),
  every as (select * from ok x where kind < 3 or not exists (select 1 from ok y where y.kind < 3 and y.r = x.r and y.a < x.b and x.a < y.b)),
  own as (select val, count(distinct s) >= 2 and count(distinct split_part(s, '/', 1)) >= 2 as copied from every group by val),
  kept as (select * from every join own using (val) where kind < 3 or not copied),
  sums as (select r, {", ".join(f"count(*) filter (kind = {k}) as n{k}" for k in range(4))}, count(*) filter (copied) as copies,
    string_agg({_SPAN}, ',' order by a, kind, b) filter (kind < 3) as base, string_agg({_SPAN}, ',' order by a, kind, b) as spans from kept group by r)
select doc_id, {", ".join(f"coalesce(n{k}, 0) as n_{KINDS[k]}" for k in range(4))}, coalesce(copies, 0) as n_copied, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join sums using (r)"""

TALKS = r"""
with rows as (select conv_id, coalesce(turn, -1) as turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
  sized as (select *, length(text) + len(regexp_extract_all(text, '[<\[]\\*(/?s>|</?SYS>>|<TURN:|</TURN>>|/?INST\])')) + case role
    when 'user' then 15 when 'assistant' then 7 when 'system' then 19 else 20 + length(role) + len(regexp_extract_all(role, '[<>\\]')) end as size from rows),
  sums as (select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as learnt, sum(size)::bigint as formatted_chars from sized group by conv_id)
select conv_id, n_turns, turns_sha256, length(learnt) as loss_chars, sha256(learnt) as loss_sha256, formatted_chars from sums"""

#: The crc32 of decimal doc_ids: the table of each byte at each distance from the end, and of the start value.
CRC = """
  t1 as (select b, list_reduce(list_concat([b::bigint], range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as t from (select unnest(range(256)) as b)),
  tables(k, b, t) as (select 1, b, t from t1 union all select k + 1, x.b, xor(x.t >> 8, t1.t) from tables x join t1 on t1.b = x.t & 255 where k < 256),
  zeros(k, z) as (select 0, 4294967295::bigint union all select k + 1, xor(z >> 8, t) from zeros join t1 on b = z & 255 where k < 256),
  digits as (select distinct doc_id::varchar as s, unnest(range(length(doc_id::varchar))) as i from documents where doc_id is not null),
  ids as (select s::bigint as doc_id, xor(xor(bit_xor(t), any_value(z)), 4294967295) as h from digits join tables on k = length(s) - i and b = ascii(s[i::int + 1]) join zeros on zeros.k = length(s) group by s)"""

RUNS = rf"""
with recursive {CRC},
  d as (select row_number() over () as r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents),
  s as (select r, doc_id, w, len(w) as n, h // 10 as g, h % 10 = 0 and len(w) > 0 as made from d left join ids using (doc_id)),
  ap as (select *, case when made then g % n end as a, case when made then 1 + (n - g % n) // (3 + g % 8) end as p from s),
  ws as (select r, doc_id, case when made then list_transform(range(n), lambda i: w[1 + case when i < a then i else a + (i - a) % p end]) else w end as w from ap),
  spots as (select r, len(w) as n, unnest(range(len(w))) as i, unnest(w) as x from ws),
  same as (select p.r, p.i, q.i - p.i as d from spots p join spots q on p.r = q.r and p.x = q.x and q.i > p.i and q.i - p.i <= p.n // 2),
  isles as (select r, d, min(i) as a, count(*) + d as size from (select *, i - row_number() over (partition by r, d order by i) as isle from same) group by r, d, isle),
  runs as (select r, a, size, min(d) as p from isles where size >= greatest(12, 2 * d) group by r, a, size),
  gone as (select distinct r, unnest(range(a + p, a + size)) as i from runs),
  kept as (select r, string_agg(x, ' ' order by i) as t from spots anti join gone using (r, i) group by r),
  sums as (select r, count(*) as n_runs, string_agg(a || ',' || size || ',' || p || chr(10), '' order by a, p) as listed, first(struct_pack(a, size, p) order by size desc, a, p) as b from runs group by r)
select doc_id, coalesce(n_runs, 0) as n_runs, b.a as start, b.size as length, b.p as period, 1000 * b.size // b.p as exponent_milli, sha256(coalesce(listed, '')) as runs_sha256, sha256(coalesce(t, '')) as collapsed_sha256
from ws left join sums using (r) left join kept using (r)"""

#: The crc32 of texts(id, s) of any length: chunks of 256 bytes, counted from the end, each advanced over the bytes after it.
LONG_CRC = """
  steps(k, j, b, v) as (select 0, j, b, b::bigint << (8 * j) from (select unnest(range(256))::int as b), (select unnest(range(4))::int as j)
    union all select k + 1, j, s.b, xor(s.v >> 8, t) from steps s join t1 on t1.b = s.v & 255 where k < 256),
  once as (select j, b, v from steps where k = 256),
  bytes as materialized (select id, len(p) as size, unnest(p) as x, unnest(range(len(p), 0, -1)) as k from (select id, regexp_extract_all(hex(encode(s)), '..') as p from texts)),
  far(q, j, b, v) as (select 0, j, b, v from steps where k = 0
    union all select q + 1, far.j, far.b, xor(xor(a.v, c.v), xor(d.v, e.v)) from far join once a on a.j = 0 and a.b = far.v & 255 join once c on c.j = 1 and c.b = far.v >> 8 & 255
      join once d on d.j = 2 and d.b = far.v >> 16 & 255 join once e on e.j = 3 and e.b = far.v >> 24 where q <= (select max(size) // 256 from bytes)),
  chunks as (select id, (bytes.k - 1) // 256 as q, bit_xor(t) as c from bytes join tables on tables.k = (bytes.k - 1) % 256 + 1 and tables.b = ('0x' || x)::int group by all
    union all select id, size // 256, z from (select distinct id, size from bytes) join zeros on zeros.k = size % 256),
  moved as (select id, v from (select id, q, c, unnest(range(4)) as j from chunks) m join far on far.q = m.q and far.j = m.j and far.b = (c >> (8 * m.j)) & 255),
  crcs as (select id, xor(bit_xor(v), 4294967295) as crc from moved group by id)"""

COMMITS = f"""
with recursive {CRC},
  log as (select doc_id, source, case when h % 17 <= 1 then 'commit' when h % 17 = 2 then 'abort' when h % 17 <= 4 then 'savepoint' when h % 17 <= 6 then 'rollback' else 'change' end as kind, h // 100 % 30000 as key,
    case when doc_id not in (select doc_id from labels where toxic = 1 and doc_id is not null) then h // 100 % 30000 || ':' || text end as said from documents join ids using (doc_id)),
  texts as (select doc_id as id, said as s from log where kind = 'change' and said is not null), {LONG_CRC},
  nexts as (select *, first_value(case when kind <> 'change' then kind end ignore nulls) over w as then_kind, first_value(case when kind <> 'change' then doc_id end ignore nulls) over w as then_id,
    first_value(case when kind in ('commit', 'abort') then kind end ignore nulls) over w as end_kind, first_value(case when kind in ('commit', 'abort') then doc_id end ignore nulls) over w as end_id
    from log window w as (partition by source order by doc_id rows between 1 following and unbounded following)),
  fates as (select doc_id, key, crc, case when then_kind = 'rollback' then 'rollback' else coalesce(end_kind, 'abort') end as fate, case when then_kind = 'rollback' then then_id else end_id end as by_id
    from nexts left join crcs on id = doc_id where kind = 'change'),
  ranks as (select doc_id as by_id, row_number() over (order by doc_id) as rank, (row_number() over (order by doc_id) - 1) // 64 + 1 as epoch from log where kind = 'commit'),
  lasts as (select key, epoch, first(crc order by rank desc, doc_id desc) as crc from fates join ranks using (by_id) where fate = 'commit' group by key, epoch),
  moves as (select epoch, crc, lag(crc) over (partition by key order by epoch) as before from lasts),
  sums as (select epoch, sum((crc is not null)::int - (before is not null)::int) as n, sum(coalesce(crc, 0) - coalesce(before, 0)) as v from moves group by epoch)
select 'state' as kind, epoch as id, coalesce(sum(n) over (order by epoch), 0)::bigint as n, coalesce(sum(v) over (order by epoch), 0)::bigint as value from (select distinct epoch from ranks) left join sums using (epoch)
union all select fate, doc_id, by_id, key from fates where fate <> 'commit'"""

ORACLE_SQL = {"op13_transaction_log": COMMITS, "op12_word_runs": RUNS, "op11_reply_trees": TALKS, "op2_embedding_neardup": NEAR_VECTORS, "op5_ngram_join": NGRAMS, "op6_secret_scan": SECRETS}

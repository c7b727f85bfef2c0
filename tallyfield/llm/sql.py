"""SQL for the operators that SQL expresses over whole tables at the oracle's size."""

from __future__ import annotations

_FINITE = "embedding is not null and len([x for x in embedding if x is null or isnan(x::double) or isinf(x::double)]) = 0"


def _components(nodes: str, links: str) -> str:
    """Two further tables: all that each node reaches, and the smallest of it."""
    return f"reach(node, other) as (select id, id from {nodes} union select r.node, l.b from reach r join {links} l on l.a = r.other), low as (select node, min(other) component_id from reach group by node)"


def _level(k: int) -> str:
    """One level of the template tree over the lines of ``rest{k}``: what a leaf's documents share, who agrees, who goes on."""
    return f"""
words{k} as (select leaf, n, unnest(tokens) token, generate_subscripts(tokens, 1) p from rest{k}),
counts{k} as (select leaf, p, token, sum(n) k from words{k} where p > 3 group by all),
places{k} as (select leaf, p, arg_max(token, (k, token)) top, max(k) k, sum(k) total, count(*) kinds from counts{k} group by leaf, p having sum(k) >= 5),
kept{k} as (select leaf, list(case when 2 * k >= total then top else '0' end order by p) kept, arg_min(p, (kinds, p)) filter (where kinds > 1) place from places{k} group by leaf),
alike{k} as (select r.*, place, tokens[1:3] || [case when tokens[i + 3] = kept[i] then kept[i] else '0' end for i in range(1, len(kept) + 1)] alike from rest{k} r join kept{k} using (leaf)),
judged{k} as (select *, len(tokens) - ({_OPEN.format("alike")} - {_OPEN.format("tokens")}) >= 0.7 * len(tokens) and 2 * {_OPEN.format("alike")} <= len(tokens) belongs from alike{k}),
rest{k + 1} as (select leaf || '/' || place::varchar || ' ' || tokens[place] leaf, line_key, tokens, n from judged{k} where not belongs),"""


_OPEN = "len([x for x in {} if x = '0'])"
_OP1 = f"""
with texts as (select doc_id, text, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) - 1 k from documents where text is not null),
masked as (select doc_id, k, line, [case when regexp_matches(t, '[0-9]') then '0' else t end for t in regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')] tokens from texts),
lines as (select *, array_to_string(tokens, ' ') line_key, len(tokens)::varchar || ' ' || array_to_string(case when len(tokens) < 4 then tokens else tokens[1:3] end, ' ') leaf from masked where len(tokens) > 0),
kinds as (select leaf, line_key, any_value(tokens) tokens, count(distinct doc_id) n from lines group by leaf, line_key),
leaves as (select leaf from kinds group by leaf having sum(n) >= 5),
rest0 as (select leaf, line_key, tokens, n from kinds semi join leaves using (leaf) where len(tokens) >= 4),
{"".join(_level(k) for k in range(3))}
templates as (select line_key, alike t from judged0 where belongs union all select line_key, alike from judged1 where belongs union all select line_key, alike from judged2 where belongs
  union all select line_key, tokens from rest3 union all select line_key, tokens from kinds where len(tokens) < 4),
met as (select doc_id, k, array_to_string(t, ' ') template from lines join templates using (line_key) where 2 * {_OPEN.format("t")} <= len(t)),
recurring as (select template, min(struct_pack(doc_id := doc_id, k := k)) first from met group by template having count(distinct doc_id) >= 5),
gone as (select doc_id, k from met join recurring using (template) where first <> struct_pack(doc_id := doc_id, k := k)),
kept as (select x.doc_id, string_agg(line, chr(10) order by x.k) filter (where g.k is null) rest, count(*) n_lines, count(g.k) n_dropped
  from texts x left join gone g on g.doc_id = x.doc_id and g.k = x.k group by x.doc_id)
select d.doc_id, coalesce(n_lines, 0) n_lines, coalesce(n_dropped, 0) n_dropped, case when d.text is not null then sha256(coalesce(rest, '')) end kept_sha256 from documents d left join kept using (doc_id)
"""

_OP2 = f"""
with recursive fine as (select vec_id, label, [x::double for x in embedding] v from embeddings
  where label is not null and {_FINITE} and len([x for x in embedding if x <> 0]) > 0),
nodes as (select distinct vec_id id from embeddings),
links as (select a.vec_id a, b.vec_id b from fine a join fine b on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id where list_cosine_similarity(a.v, b.v) >= 0.93),
counted as (select a, count(*) n from links group by a),
{_components("nodes", "links")}
select id vec_id, coalesce(n, 0) n_links, component_id, component_id = id kept from nodes join low on node = id left join counted on a = id
"""

_OP4 = f"""
with recursive words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') w from documents),
sets as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
  else [w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] for k in range(1, len(w) - 1)] end) s from words),
sizes as (select doc_id, count(*) n from sets group by doc_id),
common as (select a.doc_id a, b.doc_id b, count(*) c from sets a join sets b on a.s = b.s and a.doc_id <> b.doc_id group by all),
links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)),
nodes as (select doc_id id from documents),
{_components("nodes", "links")}
select id doc_id, coalesce(n, 0) n_shingles, component_id from nodes join low on node = id left join sizes on doc_id = id
"""

_OP5 = f"""
with v as (select vec_id, [floor(256 * x::double) for x in embedding] v from embeddings where {_FINITE}),
scores as (select q.vec_id query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint score from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scores)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

_REPEATS = """
with d as (select doc_id, encode(coalesce(text, '')) t, strlen(coalesce(text, ''))::bigint n from documents),
starts as (select doc_id, unnest(range(0, n - 399)) p, n from d where n >= 400),
hashed as (select doc_id, p, md5(t[p + 1 : p + 400]) h from starts join d using (doc_id)),
again as (select h from hashed group by h having count(*) > 1),
hits as (select doc_id, p, p - lag(p) over (partition by doc_id order by p) > 400 apart from hashed semi join again using (h)),
runs as (select doc_id, p, count(*) filter (where apart) over (partition by doc_id order by p) run from hits),
spans as (select doc_id, run, min(p) a, max(p) + 400 b from runs group by all),
ends as (select doc_id, a, b, lag(b, 1, 0) over (partition by doc_id order by a) before from spans),
cut as (select doc_id, sum(b - a)::bigint n_removed, count(*) n_spans, max(b) last, string_agg(hex(t[before + 1 : a]), '' order by a) kept from ends join d using (doc_id) group by doc_id)
select doc_id, n n_bytes, coalesce(n_removed, 0) n_removed, coalesce(n_spans, 0) n_spans,
  sha256(case when last is null then t else unhex(kept || hex(t[last + 1 : n])) end) kept_sha256
from d left join cut using (doc_id)
"""

ORACLE: dict[str, str] = {
    "op1_line_templates": _OP1,
    "op2_vector_forest": _OP2,
    "op4_jaccard_join": _OP4,
    "op5_pivot_top_k": _OP5,
    "op8_suffix_repeats": _REPEATS,
}

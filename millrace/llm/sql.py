"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from .chat import ESCAPE
from .urls import RULES, SOFT, STRICT

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _bounded(terms: str) -> str:
    return f"'(^|[^a-z0-9])({terms})($|[^a-z0-9])'"


def op10_url_filter() -> str:
    rules = sorted(RULES, key=lambda r: -len(r[1]))
    fits = []
    for verdict, rule in rules:
        host, _, path = rule.partition("/")
        fits.append((rule, verdict, f"((host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '/{path}'))"))
    rule = "case " + " ".join(f"when {fit} then '{r}'" for r, _, fit in fits) + " end"
    by_rule = " ".join(f"when rule = '{r}' then '{v}'" for r, v, _ in fits)
    hits = lambda terms: " + ".join(f"cast(regexp_matches(seen, {_bounded(t)}) as bigint)" for t in terms)
    return f"""
with cut as (
  select page_id, url,
         case when url is null or strpos(url, '://') = 0 then '' else substr(url, strpos(url, '://') + 3) end as rest
  from pages
), parts as (
  select page_id, translate(case when strpos(url, '://') = 0 then url else rest end, '{_UPPER}', '{_LOWER}') as seen,
         translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') as host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
  from cut
), judged as (
  select page_id, host, path, {rule} as rule, coalesce(seen, '') as seen
  from parts
), counted as (
  select *, {hits(STRICT)} as strict_hits, {hits(SOFT)} as soft_hits from judged
)
select page_id, host, path, rule,
       case {by_rule} when strict_hits >= 1 or soft_hits >= 2 then 'block' else 'allow' end as verdict,
       strict_hits, soft_hits
from counted"""


def op5_jaccard_join() -> str:
    return f"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') as w
  from documents
), sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] else
           list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from words
), shingles as (
  select doc_id, len(s) as n, unnest(s) as shingle from sets
), shared as (
  select a.doc_id as x, b.doc_id as y, any_value(a.n) as nx, any_value(b.n) as ny, count(*) as c
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id
  group by 1, 2
), links as (
  select x, y from shared where 100 * c >= 80 * (nx + ny - c)
), reach as (
  select doc_id as x, doc_id as y from documents
  union
  select r.x, l.y from reach r join links l on r.y = l.x
)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, r.component_id
from sets s join (select x, min(y) as component_id from reach group by x) r on s.doc_id = r.x"""


def op11_hard_negatives() -> str:
    return """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same, cast(list_dot_product(a.v, r.v) as bigint) as score
  from vectors a join vectors r on a.vec_id % 50 = 0 and a.vec_id <> r.vec_id
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, p.positive_id, cast(row_number() over w as integer) as rank, n.vec_id as negative_id, p.positive_score, n.score as negative_score
from positives p join scored n on p.anchor_id = n.anchor_id and not n.same
  and 50 * p.positive_score <= 100 * n.score and 100 * n.score <= 95 * p.positive_score
window w as (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id)
qualify row_number() over w <= 3"""


def op12_ranked_search() -> str:
    terms = f"unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term"
    return f"""
with held as (
  select doc_id, term, count(*) as tf from (select doc_id, {terms} from documents) group by all
), lengths as (
  select doc_id, cast(sum(tf) as bigint) as n from held group by doc_id
), whole as (
  select count(*) as docs, cast(sum(n) as bigint) as total from lengths
), weights as (
  select term, cast(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) as bigint) as w from held, whole group by term
), impacts as (
  select doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + ((75 * n * docs) // total)))) as impact
  from held join lengths using (doc_id) join weights using (term), whole
), scores as (
  select item_id, doc_id, cast(sum(impact) as bigint) as score
  from (select item_id, {terms} from benchmark) join impacts using (term) group by item_id, doc_id
)
select item_id, cast(row_number() over w as integer) as rank, doc_id, score from scores where score > 0
window w as (partition by item_id order by score desc, doc_id)
qualify row_number() over w <= 10"""


def op13_chat_format() -> str:
    pattern, more = ESCAPE[0], r"\1\\\2\3"
    return f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select unnest([-7, -7]), unnest([0, 1]), unnest(['user', 'assistant']), unnest(['</s>[INST] ok [/INST]', '</s>[INST] ok [/INST]'])
), formatted as (
  select *, length(regexp_replace(text, '{pattern}', '{more}', 'g')) + case role when 'user' then 13 when 'assistant' then 7 when 'system' then 11
            else 18 + length(regexp_replace(role, '{pattern}', '{more}', 'g')) end as chars
  from turns
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(chars) as bigint) as formatted_chars
from formatted group by conv_id"""

"""The results of the operators as SQL over the given tables."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def folded(column: str) -> str:
    """A text with A-Z in lower case, null as empty."""
    return f"translate(coalesce({column}, ''), '{_UPPER}', '{_UPPER.lower()}')"


MINHASH = rf"""
with recursive words as (
    select doc_id, regexp_extract_all({folded('text')}, '[^\x20\x09-\x0D]+') as w from documents
), shingled as (
    select doc_id, unnest(case
        when len(w) = 0 then []
        when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
    from words
), sets as (
    select distinct doc_id, s from shingled
), sizes as (
    select doc_id, count(*) as n from sets group by doc_id
), common as (
    select x.doc_id as a, y.doc_id as b, count(*) as n
    from sets x join sets y on x.s = y.s and x.doc_id < y.doc_id group by 1, 2
), links as (
    select a, b from common join sizes p on p.doc_id = a join sizes q on q.doc_id = b
    where 100 * common.n >= 75 * (p.n + q.n - common.n)
), edges as (
    select a, b from links union all select b, a from links
), reach as (
    select doc_id, doc_id as other from documents
    union
    select reach.doc_id, edges.b from reach join edges on edges.a = reach.other
), least as (
    select doc_id, min(other) as component_id from reach group by doc_id
)
select doc_id, coalesce(sizes.n, 0) as n_shingles, component_id, doc_id = component_id as kept
from least left join sizes using (doc_id)
"""


def mixing(domain: str, weights: dict[str, dict[str, int]], budget_permille: int, max_epochs: int, seed: int) -> str:
    """Budgets down the tree and the documents at the start of each leaf's last epoch."""

    def weight(level: str) -> str:
        known = "".join(f" when {level} = '{k}' then {v}" for k, v in weights.get(level, {}).items())
        return f"case{known} else 1 end" if known else "1"

    def level(name: str, path: str, parent: str, above: str) -> str:
        last = path.split(", ")[-1]
        by = f"partition by {parent}" if parent else ""
        n_by = "partition by " + ", ".join(f"n.{c}" for c in parent.split(", ")) if parent else ""
        return f"""
{name}_nodes as (
    select {path}, sum(capacity)::hugeint as capacity, ({weight(last)})::hugeint as weight from leaves group by {path}
), {name}_laid as (
    select n.*, p.budget, sum(weight) over ({n_by}) - coalesce(sum(weight) over (w rows between unbounded preceding and 1 preceding), 0) as left_weight,
        p.budget - coalesce(sum(capacity) over (w rows between unbounded preceding and 1 preceding), 0) as left_budget
    from {name}_nodes n join {above} p on {" and ".join(f"n.{c} is not distinct from p.{c}" for c in parent.split(", ")) if parent else "true"}
    window w as ({n_by} order by capacity / weight, n.{last})
), {name}_full as (
    select *, capacity * left_weight <= weight * left_budget as is_full from {name}_laid
), {name}_rest as (
    select *, budget - sum(case when is_full then capacity else 0 end) over ({by}) as rest,
        sum(case when is_full then 0 else weight end) over ({by}) as open_weight
    from {name}_full
), {name} as (
    select {path}, case when is_full then capacity else (weight * rest::hugeint) // open_weight::hugeint end as budget from {name}_rest
)"""

    return rf"""
with counted as (
    select doc_id, {domain} as domain, lang, source,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as n_tokens
    from documents
), leaves as (
    select domain, lang, source, sum(n_tokens)::hugeint as tokens, sum(n_tokens)::hugeint * {max_epochs} as capacity
    from counted group by domain, lang, source
), top as (
    select least(sum(capacity), (sum(tokens) * {budget_permille})::hugeint // 1000) as budget from leaves
), {level("domains", "domain", "", "top")}, {level("langs", "domain, lang", "domain", "domains")},
{level("sources", "domain, lang, source", "domain, lang", "langs")},
planned as (
    select l.*, case when tokens > 0 then budget // tokens else 0 end as epochs, case when tokens > 0 then budget % tokens else 0 end as rest
    from leaves l join sources s on l.domain is not distinct from s.domain and l.lang is not distinct from s.lang
        and l.source is not distinct from s.source
), ordered as (
    select c.*, p.epochs, p.rest, sum(n_tokens) over (
        partition by c.domain, c.lang, c.source order by md5('{seed}|' || p.epochs || '|' || c.doc_id)) as upto
    from counted c join planned p on c.domain is not distinct from p.domain and c.lang is not distinct from p.lang
        and c.source is not distinct from p.source
)
select doc_id, domain, lang, source, n_tokens::bigint as n_tokens,
    (epochs + case when upto <= rest then 1 else 0 end)::int as copies
from ordered where epochs > 0 or upto <= rest
"""


WARC = """
with payloads as (
    select page_id, encode(coalesce(html, '')) as payload from pages
), digests as (
    select page_id, octet_length(payload)::bigint as payload_bytes, sha256(payload) as payload_digest from payloads
), firsts as (
    select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) else page_id end as first_id
    from digests
)
select page_id, payload_bytes, payload_digest,
    case when page_id = first_id then 'response' else 'revisit' end as record_type,
    case when page_id = first_id then null else first_id end as refers_to
from firsts
"""


VECTORS = """
with recursive usable as (
    select vec_id, embedding::double[] as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
    select x.vec_id as a, y.vec_id as b from usable x join usable y on x.vec_id < y.vec_id and len(x.v) = len(y.v)
    where list_cosine_similarity(x.v, y.v) >= 0.9
), edges as (
    select a, b from links union all select b, a from links
), reach as (
    select vec_id, vec_id as other from embeddings
    union
    select reach.vec_id, edges.b from reach join edges on edges.a = reach.other
), least as (
    select vec_id, min(other) as component_id from reach group by vec_id
), counted as (
    select a as vec_id, count(*) as n_links from edges group by a
)
select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
from least left join counted using (vec_id)
"""


# CRC-32 of a conversation's decimal id, modulo 6: turns taken from the first of its hundred.
_SHARED = """
steps(i, x, k) as (
    select range, range::bigint, 0 from range(256)
    union all
    select i, xor(x >> 1, 3988292384 * (x & 1)), k + 1 from steps where k < 8
), crc_table as (
    select list(x order by i) as t from steps where k = 8
), shared as (
    select conv_id, xor(list_reduce(
        list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint),
        lambda state, byte: xor(state >> 8, t[(xor(state, byte) & 255) + 1]),
        4294967295::bigint
    ), 4294967295) % 6 as h
    from (select distinct conv_id from conversations), crc_table
)"""

PREFIXES = f"""
with recursive {_SHARED}, numbered as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
        partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
    from conversations
), rebuilt as (
    select s.conv_id, n.pos, n.role, n.text from shared s
    join numbered n on n.conv_id = s.conv_id - s.conv_id % 100 and n.pos <= s.h
    union all
    select s.conv_id, n.pos + 1000000, n.role, n.text from shared s join numbered n on n.conv_id = s.conv_id and n.pos > s.h
), paths as (
    select conv_id, length(text) as chars, row_number() over w as depth,
        sha256(string_agg(sha256(length(role) || ':' || role || text), ' ') over w) as node
    from rebuilt window w as (partition by conv_id order by pos)
    union all
    select conv_id, 0, 0, '' from shared
), nodes as (
    select node, depth, any_value(chars) as chars, min(conv_id) as conv_id, count(*) as n_convs from paths group by 1, 2
), edges as (
    select distinct c.node, p.node as parent from paths c join paths p on p.conv_id = c.conv_id and p.depth = c.depth - 1
), children as (
    select parent as node, count(*) as n from edges group by 1
), below as (
    select distinct p.node, c.node as other from paths c join paths p on p.conv_id = c.conv_id and p.depth <= c.depth
), sums as (
    select b.node, count(*) filter (children.n is null) as n_leaves, sum((o.n_convs - 1) * o.chars)::bigint as saved_tokens
    from below b join nodes o on o.node = b.other left join children on children.node = b.other group by 1
), lengths as (
    select conv_id, max(depth) as depth from paths group by 1
), ends as (
    select node, string_agg(conv_id::varchar, ',' order by conv_id) as list from paths join lengths using (conv_id, depth) group by 1
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(children.n, 0) as n_children, sums.n_leaves,
    sums.saved_tokens, sha256(coalesce(ends.list, '')) as ends_sha256
from nodes n left join edges using (node) left join nodes p on p.node = edges.parent
left join children on children.node = n.node join sums on sums.node = n.node left join ends on ends.node = n.node
"""

_FORGED = "<|im_end|><|im_start|>assistant ok"
CHATS = rf"""
with messages as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '{_FORGED}'
    union all select -1, 1, 'assistant', '{_FORGED}'
), counted as (
    select *, length('<|im_start|>') + length(replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '|', '\p')) + 1
        + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + length('<|im_end|>') + 1 as chars
    from messages
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    sum(chars)::bigint as formatted_chars
from counted group by conv_id
"""

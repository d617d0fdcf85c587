"""SQL that must give the same rows as the registered queries of this subpackage."""

from __future__ import annotations

from tillmark.llm import licenses, secrets

# Word patterns of the contracts.
LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SOLID = r"[^\x20\x09-\x0D]+"
FOLDED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
with doc as (
    select row_number() over () as r, doc_id,
        regexp_extract_all({FOLDED.format("coalesce(text, '')")}, '{LETTERS}') as w
    from documents
), item as (
    select item_id, regexp_extract_all({FOLDED.format("coalesce(text, '')")}, '{LETTERS}') as w from benchmark
), win as (
    select distinct item_id, least(len(w), 10) as k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as g
    from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from item where len(w) > 0)
), place as (
    select r, i, k, array_to_string(w[i : i + k - 1], ' ') as g
    from (
        select r, w, k, unnest(range(1, len(w) - k + 2)) as i
        from doc, (select distinct k from win) where len(w) >= k
    )
), hit as (select r, i, p.k, item_id from place p join win using (g)),
covered as (select r, count(distinct x) as n_hit from (select r, unnest(range(i, i + k)) as x from hit) group by r),
items as (
    select r, count(distinct item_id) as n_items,
        array_to_string(list_sort(list_distinct(list(cast(item_id as varchar)))), ',') as ids
    from hit group by r
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join covered using (r) left join items using (r)
"""


OP2 = f"""
with recursive doc as (
    select row_number() over () as r, doc_id,
        regexp_extract_all({FOLDED.format("coalesce(text, '')")}, '{SOLID}') as w
    from documents
), gram as (
    select distinct r, array_to_string(w[i : i + least(len(w), 3) - 1], ' ') as g
    from (select r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as i from doc where len(w) > 0)
), size as (select r, count(*) as n from gram group by r),
pair as (
    select x.r as a, y.r as b, count(*) as c from gram x join gram y on x.g = y.g and x.r < y.r group by all
), link as (
    select a, b from pair join size s on s.r = a join size t on t.r = b where 100 * c >= 90 * (s.n + t.n - c)
), both_ways as (select a, b from link union all select b, a from link),
reach(r, other) as (select r, r from doc union select reach.r, b from reach join both_ways on a = other)
select d.doc_id, coalesce(any_value(n), 0) as n_shingles, min(o.doc_id) as component_id
from doc d left join size using (r) join reach on reach.r = d.r join doc o on o.r = reach.other
group by d.r, d.doc_id
"""

OP10 = f"""
with rest as (
    select page_id, url,
        case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as r
    from pages
), part as (
    select row_number() over () as n, page_id, {FOLDED.format("regexp_extract(r, '^([^/?#]*)', 1)")} as host,
        regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path
    from rest
), rule(action, h, p) as (
    values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'),
        ('allow', 'org', '/fr/')
), fit as (
    select n, h || p as rule, action from part join rule
    on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
    qualify row_number() over (partition by n order by length(h || p) desc, length(h) desc) = 1
)
select page_id, host, path, rule, coalesce(action, 'allow') as verdict from part left join fit using (n)
"""


def _rows(values) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in values)


OP4 = f"""
with doc as (
    select row_number() over () as r, doc_id, coalesce(text, '') as t,
        regexp_extract_all({FOLDED.format("coalesce(text, '')")}, '{LETTERS}') as w
    from documents
), phrase(p, label) as (values {_rows(licenses.PHRASES.items())}),
spot as (
    select r, label, i - 1 as pos from (
        select r, w, label, string_split(p, ' ') as q, unnest(range(1, len(w) + 1)) as i from doc, phrase
    ) where w[i : i + len(q) - 1] = q
), base as (
    select r, count(*) as n, min(pos) as lo, max(pos) as hi, list_distinct(list(label)) as labels from spot group by r
), template(label, t) as (values {_rows(licenses.TEMPLATES)}),
tokens as (select label, list_distinct(string_split(t, ' ')) as q from template),
line as (
    select r, list_distinct(regexp_extract_all({FOLDED.format("b")}, '{LETTERS}')) as q
    from (select r, unnest(string_split_regex(t, '[\n\r]+')) as b from doc)
), pair as (
    select r, label, len(list_intersect(line.q, tokens.q)) as n, len(tokens.q) as size
    from line, tokens where len(list_intersect(line.q, tokens.q)) >= ceil({licenses.CONTAINMENT} * len(tokens.q) - 1e-9)
), met as (select r, list_distinct(list(label)) as labels, max(n / size) as score from pair group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n, 0) as n_base, lo as first_word, hi as last_word,
    array_to_string(list_sort(coalesce(base.labels, [])), ',') as base_labels,
    array_to_string(list_sort(list_distinct(coalesce(base.labels, []) || coalesce(met.labels, []))), ',') as labels,
    case when n > 0 then 1.0::double else coalesce(score, 0.0)::double end as score
from doc left join base using (r) left join met using (r)
"""


def _kind(rank: int, kind: secrets.Kind) -> str:
    pattern = kind.pattern.replace("'", "''")
    return f"""
        select r, {rank} as k, '{kind.name}' as kind, m[i] as match, regexp_extract(m[i], '{pattern}', {kind.group}) as v,
            list_sum(list_transform(g[1 : i], lambda x: length(x)))
                + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: length(x))), 0) as s
        from (
            select r, m, g, unnest(range(1, len(m) + 1)) as i from (
                select r, regexp_extract_all(t, '{pattern}') as m, string_split_regex(t, '{pattern}') as g from doc
            )
        )
        where length(regexp_extract(m[i], '{pattern}', {kind.group})) >= {kind.least}"""


OP8 = f"""
with doc as (select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents),
raw as ({" union all ".join(_kind(rank, kind) for rank, kind in enumerate(secrets.KINDS))}),
span as (
    select r, k, kind, v, cast(s as bigint) as s, kind || ':' || cast(s as bigint) || ':' || cast(s + length(match) as bigint) as x
    from raw
), owner as (
    select v, count(distinct coalesce(source, chr(0))) as n from span join doc using (r) group by v
), folded as (
    select r, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
        count(*) filter (kind = 'hex') as n_hex,
        string_agg(x, ',' order by s, k) filter (k < {len(secrets.BASE)}) as base,
        string_agg(x, ',' order by s, k) as spans,
        count(*) filter (n < {secrets.COMMON_OWNERS}) as n_live, count(*) filter (n >= {secrets.COMMON_OWNERS}) as n_copied
    from span join owner using (v) group by r
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
    sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans,
    coalesce(n_live, 0) as n_live, coalesce(n_copied, 0) as n_copied
from doc left join folded using (r)
"""


# The checksum of a text's UTF-8 bytes, from the table of its 256 remainders.
CRC = """crc_table as (
    select list(v order by b) as remainders from (
        select b, list_reduce([b] || range(8), lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end) as v
        from (select unnest(range(256)) as b)
    )
)"""


def _crc(text: str) -> str:
    """Of a text column, where ``crc_table`` is joined."""
    digits = f"hex(encode({text}))"
    byte = f"cast(concat('0x', substr({digits}, 2 * i + 1, 2)) as bigint)"
    bytes_ = f"list_transform(range(octet_length(encode({text}))), lambda i: {byte})"
    step = "lambda x, y: xor(x >> 8, remainders[(xor(x, y) & 255) + 1])"
    return f"xor(list_reduce([4294967295] || {bytes_}, {step}), 4294967295)"


OP11 = f"""
with {CRC},
t as (
    select conv_id, row_number() over (partition by conv_id order by turn nulls first, x) as k, x, size
    from (
        select conv_id, turn, strlen(coalesce(text, '')) as size,
            md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as x
        from conversations where conv_id is not null
    )
), c as (
    select conv_id, conv_id - conv_id % 5 as base, {_crc("cast(conv_id as varchar)")} % 9 as h
    from (select distinct conv_id from t), crc_table
), opening as (select c.conv_id, t.k as d, x, size from c join t on t.conv_id = base and k <= h),
rebuilt as (
    select * from opening
    union all
    select t.conv_id, (select count(*) from opening o where o.conv_id = t.conv_id) + k - h as d, x, size
    from t join c using (conv_id) where k > h
), path as (select conv_id, list(x order by d) as xs, list(size order by d) as sizes from rebuilt group by conv_id),
every as (select conv_id, coalesce(xs, []) as xs, coalesce(sizes, []) as sizes from c left join path using (conv_id)),
member as (
    select conv_id, cast(d as bigint) as d, len(xs) = d as ends, case when d > 0 then sizes[d] else 0 end as size,
        md5(array_to_string(xs[1 : d], '')) as node,
        case when d > 0 then md5(array_to_string(xs[1 : d - 1], '')) end as parent,
        list_transform(range(d + 1), lambda j: md5(array_to_string(xs[1 : j], ''))) as above
    from (select *, unnest(range(len(xs) + 1)) as d from every)
), node as (
    select node, min(conv_id) as conv_id, any_value(d) as depth, any_value(parent) as parent, count(*) as n_convs,
        (count(*) - 1) * any_value(size) as saved, any_value(above) as above,
        sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '')) as ends_sha256
    from member group by node
), child as (select parent, count(*) as n from node where parent is not null group by parent),
leaf as (select node, node not in (select parent from child) as childless from node),
below as (
    select a as node, cast(sum(saved) as bigint) as saved_tokens, count(*) filter (childless) as n_leaves
    from (select node, saved, unnest(above) as a from node) u join leaf using (node) group by a
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(child.n, 0) as n_children, n_leaves,
    saved_tokens, n.ends_sha256
from node n join below using (node) left join child on child.parent = n.node left join node p on p.node = n.parent
"""

OP13 = f"""
with {CRC},
doc as (
    select row_number() over () as r, doc_id, regexp_extract_all({FOLDED.format("coalesce(text, '')")}, '{LETTERS}') as w
    from documents
), goal as (select regexp_extract_all({FOLDED.format("coalesce(text, '')")}, '{LETTERS}') as w from benchmark),
run as (
    select r, true as own, array_to_string(w[i : i + k - 1], ' ') as g
    from (select r, w, k, unnest(range(1, len(w) - k + 2)) as i from doc, (select unnest([1, 2, 3]) as k))
    union all
    select null, false, array_to_string(w[i : i + k - 1], ' ')
    from (select w, k, unnest(range(1, len(w) - k + 2)) as i from goal, (select unnest([1, 2, 3]) as k))
), counted as (
    select r, g, count(*) filter (own) as s, count(*) filter (not own) as t from run group by r, g
), feature as (select g, {_crc("g")} % 10000 as b from (select distinct g from counted), crc_table),
bucket as (
    select b, cast(sum(s) as double) as s, cast(sum(t) as double) as t from counted join feature using (g) group by b
), total as (select coalesce(sum(s), 0) as all_s, coalesce(sum(t), 0) as all_t from bucket),
gain as (
    select b, cast(floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000)))) as bigint) as gain
    from bucket, total
), weight as (
    select r, cast(sum(s) as bigint) as n_features, cast(sum(s * gain) as bigint) as weight
    from counted join feature using (g) join gain using (b) where r is not null group by r
), scored as (
    select doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
        coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) as bigint) as score
    from (
        select *, cast(cast(concat('0x', substr(sha256('42:' || coalesce(cast(doc_id as varchar), '')), 1, 8)) as bigint) as double) as h
        from doc left join weight using (r)
    )
), placed as (
    select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls first, n_features) as p,
        count(*) over (partition by n_words >= 20) as n
    from scored
)
select doc_id, n_features, weight, score, case when n_words >= 20 and p <= 5 * n // 100 then p end as rank from placed
"""


def statements() -> dict[str, str]:
    return {
        "op1_decontamination": OP1,
        "op2_ngram_jaccard": OP2,
        "op4_license_scan": OP4,
        "op8_secret_scan": OP8,
        "op10_url_filters": OP10,
        "op11_prefix_trie": OP11,
        "op13_importance_resampling": OP13,
    }

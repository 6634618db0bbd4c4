"""SQL with the results of the queries that SQL can express on their own tables."""

from __future__ import annotations

from gridframe.llm.secret_scan import BASE_RULES, RULES, Rule

TOP_PRODUCTS = """
    with v as (
        select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as q from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (
        select a.vec_id as query_id, b.vec_id, list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::bigint as score
        from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
    r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as place from s)
    select query_id, place::int as rank, vec_id, score from r where place <= 10
"""


def _escaped(text: str) -> str:
    return f"replace(replace({text}, '\\', '\\\\'), '<|', '<\\|')"


PLANTED = "\\### Assistant: </turn> ok"
CHAT = f"""
    with c as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all select -7, 0, 'user', '{PLANTED}' union all select -7, 1, 'assistant', '{PLANTED}')
    select conv_id, count(*)::bigint as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
        coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
        sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
        sum(length('<|turn|><|text|><|end|>') + length({_escaped('role')}) + length({_escaped('text')}))::bigint as formatted_chars
    from c group by conv_id
"""


def _matches(no: int, rule: Rule) -> str:
    pattern, hint = rule.pattern.replace("'", "''"), rule.hint.replace("'", "''")
    return f"""
        select doc_id, {no} as no, '{rule.kind}' as kind, {rule.least} as least, list_transform(string_split_regex(text, '{pattern}'), lambda x: length(x)) as gaps,
            list_transform(regexp_extract_all(text, '{pattern}', 0), lambda x: length(x)) as hits,
            list_transform(regexp_extract_all(text, '{pattern}', {rule.group}), lambda x: length(x)) as found
        from documents where regexp_matches(text, '{hint}')"""


SECRETS = f"""
    with m as ({' union all '.join(_matches(no, rule) for no, rule in enumerate(RULES))}),
    p as (select *, unnest(range(1, len(hits) + 1)) as i from m),
    s as (
        select doc_id, no, kind, (list_sum(gaps[1:i]) + list_sum(hits[1:i]))::bigint as stop, hits[i] as length from p where found[i] >= least),
    t as (
        select doc_id, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access,
            count(*) filter (where kind = 'hex') as n_hex,
            string_agg(kind || ':' || (stop - length) || ':' || stop, ',' order by stop - length, no) filter (where no < {len(BASE_RULES)}) as base,
            string_agg(kind || ':' || (stop - length) || ':' || stop, ',' order by stop - length, no) as spans
        from s group by doc_id)
    select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
        sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
    from documents left join t using (doc_id)
"""

AUDIT = """
    with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
    w as (select *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as words, min(doc_id) over (partition by text) as least from d),
    m as (
        select doc_id, part,
            list_filter([
                case when len(words) < 100 then 'A' end,
                case when 100 * len(list_distinct(words)) < 80 * len(words) then 'B' end,
                case when 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * len(text) then 'C' end,
                case when regexp_matches(text, '[#$%&*|]') then 'D' end,
                case when least < doc_id then 'E' end], lambda x: x is not null) as fails
        from w),
    l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
    k as (
        select part, fails, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic
        from m left join l using (doc_id) group by part, fails),
    f as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
    o as (
        select a.x || b.x || c.x || d.x || e.x as filter_order from f a, f b, f c, f d, f e
        where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    s as (select filter_order, step, filter_order[step] as own, string_split(filter_order[1:step - 1], '') as before from o, range(1, 6) t(step)),
    r as (
        select part, filter_order, step::int as step, own,
            coalesce(sum(n) filter (not list_contains(fails, own) and not list_has_any(fails, before)), 0)::bigint as kept,
            coalesce(sum(n) filter (list_contains(fails, own) and not list_has_any(fails, before)), 0)::bigint as removed,
            coalesce(sum(n) filter (list_contains(fails, own) and list_has_any(fails, before)), 0)::bigint as redundant,
            coalesce(sum(n) filter (fails = [own]), 0)::bigint as unique_fails,
            coalesce(sum(good) filter (list_contains(fails, own) and not list_has_any(fails, before)), 0)::bigint as good_lost,
            coalesce(sum(toxic) filter (list_contains(fails, own) and not list_has_any(fails, before)), 0)::bigint as toxic_lost
        from k, s group by all)
    select * exclude (own), (sum(removed) over (partition by part, own))::bigint as shapley from r
"""

COLLOCATIONS = """
    with d as (
        select coalesce(lang, 'und') as lang,
            unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
        from documents),
    w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as words from d),
    g as (select lang, m, unnest(list_transform(range(1, len(words) - m + 2), lambda i: array_to_string(words[i:i + m - 1], ' '))) as phrase from w, range(1, 6) t(m)),
    c as (select lang, m, phrase, count(*) as f from g group by all),
    n as (select lang, sum(f) as n from c where m = 1 group by lang),
    k as (select * from c where m > 1 and f >= 100),
    x as (
        select distinct a.lang, a.phrase from k a join k b on a.lang = b.lang and a.f = b.f
        where b.m > a.m and contains(' ' || b.phrase || ' ', ' ' || a.phrase || ' ')),
    s as (select lang, phrase, m, f as a, string_split(phrase, ' ') as words, unnest(range(1, m)) as cut from k anti join x using (lang, phrase)),
    t as (
        select s.*, l.f as l, r.f as r, n.n, ((1000::hugeint * s.a * n.n) // (l.f::hugeint * r.f))::bigint as score
        from s join n using (lang)
        join c l on l.lang = s.lang and l.phrase = array_to_string(s.words[1:s.cut], ' ')
        join c r on r.lang = s.lang and r.phrase = array_to_string(s.words[s.cut + 1:], ' ')),
    b as (select * from t qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
    o as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from b)
    select lang, rank::int as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score from o where rank <= 2000
"""

SQL = {"op3_cover_tree": TOP_PRODUCTS, "op4_chat_parts": CHAT, "op7_blob_ledger": SECRETS, "op12_counting_bloom": AUDIT, "op13_branch_and_bound": COLLOCATIONS}

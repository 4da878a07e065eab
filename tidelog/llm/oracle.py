"""SQL with the same results, for DuckDB, where SQL can express an operator."""

from __future__ import annotations

ORACLE = {
    "op4_vptree": """
        with e as (
            select distinct vec_id, cast(embedding as double[]) as v from embeddings
            where vec_id is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), pairs as (
            select q.vec_id as query_id, c.vec_id as vec_id, list_inner_product(q.v, c.v) as score
            from e q join e c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 20 = 0
        ), ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as r from pairs)
        select query_id, cast(r as integer) as rank, vec_id, score from ranked where r <= 20
    """,
    "op8_chat_format": r"""
        with turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, role as r, text as t from conversations
            union all select -1, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
            union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'
        ), sized as (
            select *,
                length(text) + length(text) - length(replace(text, '\', ''))
                    + len(regexp_extract_all(text, '<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|\[ROLE\]|\[/ROLE\]|\[/TURN\]')) as body,
                length(role) + length(role) - length(replace(role, '\', ''))
                    + len(regexp_extract_all(role, '<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|\[ROLE\]|\[/ROLE\]|\[/TURN\]')) as name,
            from turns
        )
        select conv_id, count(*) as n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, r nulls first, t nulls first)) as turns_sha256,
            cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
            sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn nulls first, r nulls first, t nulls first)) as loss_sha256,
            cast(sum(body + case role when 'system' then 15 when 'user' then 13 when 'assistant' then 7 else 20 + name end) as bigint) as formatted_chars,
            regexp_full_match(
                string_agg(case role when 'system' then 's' when 'user' then 'u' when 'assistant' then 'a' else 'x' end, '' order by turn nulls first, r nulls first, t nulls first),
                's?(ua)+') as valid
        from sized group by conv_id
    """,
    "op9_mixing": r"""
        with d as (
            select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
                cast('0x' || substr(md5('9:' || coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) as h
            from documents
        ), s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
        r as (select *, row_number() over (order by source nulls last) as rk from s),
        w as (select *, cast(case (rk - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as double) as weight, cast(source_size as double) * 3 as most from r),
        l as (
            select *, most / weight as full_at,
                (least(cast(sum(source_size) over () as double), sum(most) over ())
                    - coalesce(sum(most) over (order by most / weight, rk rows between unbounded preceding and 1 preceding), 0))
                    / sum(weight) over (order by most / weight, rk rows between current row and unbounded following) as level
            from w
        ), o as (select level from l where level <= full_at order by full_at, rk limit 1),
        t as (select source, source_size, rk, coalesce(least(most, weight * (select level from o)), most) as target from l),
        c as (
            select d.*, t.source_size, t.rk, t.target,
                cast(sum(size) over (partition by d.source order by h, doc_id, size rows between unbounded preceding and current row) as bigint) as reached
            from d join t on d.source is not distinct from t.source
        ), e as (
            select c.*, p.n, cast(p.n * source_size + reached as double) / target as f
            from c, (values (0), (1), (2)) as p(n) where size > 0 and target > p.n * source_size
        ), k as (select *, sum(size) over (order by f, rk, h, doc_id, n rows between unbounded preceding and current row) as upto from e),
        g as (select doc_id, source, count(*) as n from k where upto <= (select sum(size) from d) group by doc_id, source)
        select c.doc_id, c.source, c.size, c.source_size, c.target, cast(coalesce(g.n, 0) as integer) as copies, cast(coalesce(g.n, 0) * c.size as bigint) as taken
        from c left join g on c.doc_id is not distinct from g.doc_id and c.source is not distinct from g.source
    """,
}

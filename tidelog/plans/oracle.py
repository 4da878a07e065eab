"""SQL for the driver's queries, as DuckDB runs it."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "snapshot_initial": """
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders where o_orderkey > 0 and o_orderkey <=
        (select coalesce(max(o_orderkey),0) from orders)
    """,
    "snapshot_resume": """
        select o_orderkey, o_totalprice from orders where o_orderkey > 5000 and o_orderkey <= 10000
    """,
    "snapshot_end_bounds": """
        select 'orders' as collection, coalesce(max(o_orderkey),0) as snapshot_end from orders union all select 'customer', coalesce(max(c_custkey),0)
        from customer union all select 'part', coalesce(max(p_partkey),0) from part union all select 'empty', coalesce(max(p_partkey),0) from part
        where p_partkey < 0
    """,
    "snapshot_multi_table": """
        select collection, count(*) as n, min(k) as first_key, max(k) as last_key from (select 'orders' as collection, o_orderkey as k from orders
        where o_orderkey>0 union all select 'customer', c_custkey from customer where c_custkey>0 union all select 'supplier', s_suppkey from supplier
        where s_suppkey>0 union all select 'part', p_partkey from part where p_partkey>0) group by collection
    """,
    "snapshot_fetch_batches": """
        select cast((rn-1)//512 as bigint) as batch, count(*) as n, min(k) as lo, max(k) as hi from (select o_orderkey as k, row_number() over(order
        by o_orderkey) as rn from orders where o_orderkey>0) group by 1
    """,
    "snapshot_position_json": """
        select c_custkey, '{"type":1,"snapshots":{"customer":{"last_read":'||c_custkey||',"snapshot_end":'||(select max(c_custkey) from
        customer)||'}}}' as position from customer where c_custkey>0
    """,
    "snapshot_key_coercion": """
        select cast(n_nationkey as bigint) as last_read, n_nationkey as key, n_name from nation where n_nationkey > 0
    """,
    "table_key_lookup": """
        select 'orders' as tbl, count(*)=count(distinct o_orderkey) as is_unique from orders union all select 'lineitem', count(*)=count(distinct
        l_orderkey) from lineitem union all select 'events', count(*)=count(distinct event_id) from events
    """,
    "cdc_records": """
        select event_id+1 as lsn, case event_type when 'signup' then 'create' when 'error' then 'delete' else 'update' end as operation, 'events' as
        collection, user_id as key, case when event_type='error' then null else value end as after_value from events
    """,
    "cdc_resume_after_lsn": """
        select event_id+1 as lsn, case event_type when 'signup' then 'create' when 'error' then 'delete' else 'update' end as operation, user_id from
        events where event_id+1 > 4000
    """,
    "cdc_start_lsn": """
        select s.start_lsn, case when s.start_lsn=0 then 3000 when s.start_lsn<3000 then 3000 else s.start_lsn end as effective_lsn from (select
        event_id as start_lsn from events) s
    """,
    "cdc_before_image": """
        select event_id+1 as lsn, user_id, value as after_value, lag(value) over(partition by user_id order by event_id) as before_value from events
    """,
    "cdc_delete_key_only": """
        select event_id+1 as lsn, user_id as key, user_id as before_user_id, cast(null as double) as before_value from events where event_type='error'
    """,
    "cdc_micro_batches": """
        select date_trunc('hour',ts) as flush_window, cast((rn-1)//4 as bigint) as batch, count(*) as n, min(event_id) as lo, max(event_id) as hi from
        (select ts,event_id,row_number() over(partition by date_trunc('hour',ts) order by event_id) as rn from events) group by 1,2
    """,
    "lsn_format": """
        select event_id, printf('%X/%X', (event_id*1000003)>>32, (event_id*1000003)&4294967295) as lsn from events
    """,
    "lsn_roundtrip": """
        select event_id, event_id*1000003 as lsn from events
    """,
    "cdc_standby_status": """
        select event_id, case when flushed>written then 'error' when flushed=written and flushed<wal_end then 'send_wal_end' else 'send_flushed' end
        as status from (select event_id, event_id as written, event_id - (event_id % 3) + (case when event_id % 97=0 then 1 else 0 end) as flushed,
        event_id + (event_id % 2) as wal_end from events)
    """,
    "cdc_op_counts": """
        select case event_type when 'signup' then 'create' when 'error' then 'delete' else 'update' end as operation, count(*) as n from events group
        by 1
    """,
    "apply_last_write_wins": """
        select user_id, op, lsn, value from (select user_id, case event_type when 'signup' then 'create' when 'error' then 'delete' else 'update' end
        as op, event_id+1 as lsn, value, row_number() over(partition by user_id order by event_id desc) as r from events) where r=1
    """,
    "apply_upsert": """
        select coalesce(l.user_id,c.c_custkey) as c_custkey, case when l.user_id is not null then l.value else c.c_acctbal end as c_acctbal from
        (select c_custkey,c_acctbal from customer) c full outer join (select user_id,value from (select
        user_id,value,row_number() over(partition by user_id order by event_id desc) as r from events where event_type<>'error') where r=1) l on
        c.c_custkey=l.user_id
    """,
    "apply_delete": """
        select c_custkey, c_name from customer c where not exists (select 1 from events e where e.event_type='error' and e.user_id=c.c_custkey)
    """,
    "apply_changes": """
        with l as (select * from (select user_id as k, case event_type when 'signup' then 'create' when 'error' then 'delete' else 'update' end as op,
        value, row_number() over(partition by user_id order by event_id desc) as r from events) where r=1) select coalesce(l.k,c.c_custkey) as
        c_custkey, c.c_name, case when l.k is not null then l.value else c.c_acctbal end as c_acctbal from (select * from customer where c_custkey>0)
        c full outer join l on c.c_custkey=l.k where l.op is null or l.op<>'delete'
    """,
    "append_without_key": """
        select s_suppkey, s_acctbal from supplier union all select s_suppkey, s_acctbal from supplier
    """,
    "route_by_table_template": """
        select concat('events_',event_type) as target_table, count(*) as n from events group by 1
    """,
    "numeric_scale": """
        select o_orderkey, cast(cast(o_totalprice as decimal(18,4)) as decimal(16,1)) as p from orders
    """,
    "numeric_scale_default_zero": """
        select o_orderkey, cast(cast(o_totalprice as decimal(18,4)) as decimal(18,0)) as p from orders
    """,
    "raw_json_payload": """
        select event_id, cast(json_extract_string(props,'$.k') as bigint) as k from events
    """,
    "reject_missing_key": """
        select operation, count(*) as n from (select case event_type when 'signup' then 'create' when 'error' then 'delete' else 'update' end as
        operation, nullif(user_id,7) as k from events) where operation in ('update','delete') and k is null group by 1
    """,
    "snapshot_then_cdc": """
        select 1 as pos_type, c_custkey as pos, 'snapshot' as operation, c_custkey as k, c_acctbal as v from customer where c_custkey>0 union all
        select 2, event_id+1, case event_type when 'signup' then 'create' when 'error' then 'delete' else 'update' end, user_id, value from events
    """,
    "uuid_format": """
        select k, coalesce(lower(concat_ws('-',substr(h,1,8),substr(h,9,4),substr(h,13,4),substr(h,17,4),substr(h,21,12))),'') as uuid from (select
        p_partkey as k, case when p_partkey % 10=0 then null else md5(p_name) end as h from part) where h is not null union all select p_partkey, ''
        from part where p_partkey % 10=0
    """,
    "quote_ident": """
        select p_partkey, concat('"',p_name,'"') as ident from part
    """,
}
ORACLE["stream_apply_changes"] = ORACLE["apply_changes"]
ORACLE |= {
    "avro_schema_fields": """
        with c as (select table_name as tbl, column_name as field, data_type as t from information_schema.columns where table_name in ('region',
        'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels',
        'conversations')), bad as (select distinct tbl from c where t like '%[]') select tbl, cast(row_number() over(partition by tbl order by
        field) - 1 as int) as position, field, case t when 'BIGINT' then 'long' when 'INTEGER' then 'int' when 'DOUBLE' then 'double' when 'VARCHAR'
        then 'string' when 'TIMESTAMP' then 'local-timestamp-micros' else t end as type from c where tbl not in (select tbl from bad) union all
        select tbl, -1, null, null from bad
    """,
    "publication_tables": """
        select case when event_type in ('click','view') then 'browsing' else 'business' end as publication, concat('events_',event_type) as tbl,
        count(*) as n from events where event_type <> 'error' group by 1, 2
    """,
    "stream_progress": """
        select cast(1 as bigint) as batches, count(*) as n from events
    """,
    "apply_null_key_creates": """
        with r as (select case when user_id % 7 <> 0 then user_id end as k, value, event_id from events where event_type = 'signup' or (event_type
        <> 'error' and user_id % 7 <> 0)), l as (select k, value from (select *, row_number() over(partition by k order by event_id desc) as n from r
        where k is not null) where n=1) select coalesce(l.k, c.c_custkey) as c_custkey, case when l.k is not null then l.value else c.c_acctbal end
        as c_acctbal from customer c full outer join l on c.c_custkey=l.k union all select null, value from r where k is null
    """,
    "apply_within_transactions": """
        with l as (select * from (select user_id as k, event_type as t, value, row_number() over(partition by user_id order by event_id desc) as r
        from events) where r=1) select coalesce(l.k,c.c_custkey) as c_custkey, case when l.k is not null then l.value else c.c_acctbal end as
        c_acctbal from customer c full outer join l on c.c_custkey=l.k where l.t is null or l.t<>'error'
    """,
    "apply_partial_updates": """
        with e as (select user_id as k, event_id as n, event_type as t, value as v, max(case when event_type='error' then event_id end)
        over(partition by user_id) as d from events), live as (select * from e where d is null or n >= d), net as (select k, arg_max(v,n) filter
        (t<>'error') as a, count(*) filter (t<>'error') > 0 as sa, arg_max(n+1,n) filter (t not in ('error','click')) as b, count(*) filter (t not in
        ('error','click')) > 0 as sb, arg_max(t,n)='error' as gone, max(d) is not null as cleared from live group by k) select coalesce(net.k,
        c.c_custkey) as k, case when sa then net.a when cleared then null else c.c_acctbal end as a, case when sb then net.b when cleared then null
        else c.c_custkey*10 end as b from customer c full outer join net on c.c_custkey=net.k where not coalesce(gone,false)
    """,
    "apply_routed": """
        select concat('events_',event_type) as target_table, user_id as k, arg_max(value,event_id) as v from events group by 1, 2
    """,
    "numeric_many_digits": """
        select o_orderkey, cast(cast(cast(o_orderkey+1 as varchar) || repeat('0',20) || '.' || lpad(cast(o_orderkey%100 as varchar),2,'0') as
        decimal(38,2)) as decimal(38,1))::varchar as p from orders
    """,
    "catalog_primary_keys": """
        select * from (values ('orders','o_orderkey'), ('customer','c_custkey'), ('events','event_id'), ('conversations','conv_id'),
        ('conversations','turn')) t(tbl, name)
    """,
    "pgoutput_decode": """
        select event_id+1 as lsn, case event_type when 'signup' then 'create' when 'error' then 'delete' else 'update' end as operation, user_id as
        key, case when event_type<>'error' then value end as after_value, case when event_type='error' then value end as before_value from events
    """,
    "stream_handover": """
        with e as (select user_id as k, event_id as n, event_type as t, value as v from events where event_id >= (select count(*)//3 from events)),
        l as (select k, arg_max(t,n)='error' as gone, arg_max(v,n) as v, count(*) filter (t='error') > 0 as cleared from e group by k) select
        coalesce(l.k,c.c_custkey) as c_custkey, case when coalesce(l.cleared,false) then null else c.c_name end as c_name, case when l.k is not null
        then l.v else c.c_acctbal end as c_acctbal from (select * from customer where c_custkey>0) c full outer join l on c.c_custkey=l.k where not
        coalesce(l.gone,false)
    """,
}

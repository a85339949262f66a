"""The same queries as ANSI SQL, spelled row by row with window functions."""

from __future__ import annotations

_LINE_COLUMNS = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,"
    " l_tax, l_returnflag, l_linestatus, l_shipdate"
)
_LINE_ORDER = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)

# Rows of the earlier polls come first, then the later ones; both in event order.
_STEPS = """
with rows_ as (
    select user_id, cast(date_trunc('hour', ts) as timestamp) as hour, event_type as level,
           nullif(cast(floor(value / 25) as integer), 0) as message, props as label,
           cast(nullif(length(props) % 3, 0) as integer) as noted,
           event_id, value, coalesce(minute(ts) >= 20, true) as late,
           case when user_id is null or ts is null then event_id end as lone
    from events
), linked as (
    select *, row_number() over w as rn,
           lag(level) over w as p_level, lag(message) over w as p_message, lag(noted) over w as p_noted
    from rows_
    window w as (partition by user_id, hour, lone order by late, event_id)
), steps as (
    select *, rn = 1 or level is distinct from p_level or message is distinct from p_message
        or noted is distinct from p_noted as changed_
    from linked
), ranked as (
    select *,
           row_number() over (partition by user_id, hour, lone order by late desc, event_id desc) as from_end,
           row_number() over (partition by user_id, hour, lone, changed_ order by late desc, event_id desc) as change_from_end
    from steps
)
"""

_STATE = (
    _STEPS
    + """
, state as (
    select f.user_id, f.hour, z.level, z.message, z.noted as changed, c.label,
           f.event_id as created_by, f.value as created_value
    from ranked f
    join ranked z on f.user_id is not distinct from z.user_id and f.hour is not distinct from z.hour
        and f.lone is not distinct from z.lone and z.from_end = 1
    join ranked c on f.user_id is not distinct from c.user_id and f.hour is not distinct from c.hour
        and f.lone is not distinct from c.lone and c.changed_ and c.change_from_end = 1
    where f.rn = 1
)
"""
)

# Good lines as level readings; NULL where the price is too wide for the column.
_LEVELS = """
with good as (
    select 'S' || l_suppkey as station_ref, cast(year(l_shipdate) as integer) as year,
           cast(l_shipdate as date) as date, l_orderkey, l_linenumber, l_partkey, l_extendedprice,
           try_cast(round(cast(cast(l_extendedprice as varchar) as decimal(18, 4)), 3) as decimal(8, 3)) as value_m
    from lineitem where l_returnflag = 'N'
), units as (
    select u.station_ref, u.year, count(g.station_ref) as n_rows,
           coalesce(bool_or(g.value_m is null or g.year not between 2000 and 2026)
                    filter (where g.station_ref is not null), false) as failed
    from (select distinct 'S' || l_suppkey as station_ref, cast(year(l_shipdate) as integer) as year from lineitem) u
    left join good g on g.station_ref = u.station_ref and g.year = u.year
    group by 1, 2
)
"""

# All events as the warnings of one poll. Rows without an area stand alone.
_POLL = """
with warnings as (
    select case when user_id <> 0 then 'A' || user_id end as area, event_id,
           cast(length(event_type) as integer) as level, event_type as label,
           nullif(cast(cast(floor(value / 25) as bigint) as varchar), '0') as message,
           '2024-01-0' || nullif(length(props) % 3, 0) || ' 09:00:00' as noted
    from events
), linked as (
    select *, coalesce(area, 'row ' || event_id) as grp from warnings
), lagged as (
    select *, row_number() over w as rn, lag(level) over w as p_level, lag(message) over w as p_message,
           lag(noted) over w as p_noted
    from linked window w as (partition by grp order by event_id)
), steps as (
    select *, rn = 1 or level is distinct from p_level or message is distinct from p_message
        or noted is distinct from p_noted as changed
    from lagged
), ranked as (
    select *, row_number() over (partition by grp order by event_id desc) as from_end,
           row_number() over (partition by grp, changed order by event_id desc) as change_from_end
    from steps
), counts as (
    select grp, count(*) filter (where rn > 1 and changed) as n_update, count(*) filter (where not changed) as n_noop
    from steps group by 1
)
"""

_UNIT_STATUS = """
    select l_suppkey, cast(year(l_shipdate) as integer) as year, count(*) as n_rows,
           count(*) filter (where l_quantity >= 50 or year(l_shipdate) not between 1995 and 2000) as n_bad,
           case when bool_or(l_quantity >= 50 or year(l_shipdate) not between 1995 and 2000)
                then 'failed' else 'done' end as status
    from lineitem group by 1, 2
"""

_PENDING = """
    select s.s_suppkey, y.year
    from supplier s cross join (select cast(unnest(range(1995, 2002)) as integer) as year) y
    where not exists (
        select 1 from lineitem l
        where l.l_returnflag = 'R' and l.l_discount >= 0.1 and l.l_suppkey = s.s_suppkey and year(l.l_shipdate) = y.year)
"""

_RIVERS = """
    with lines as (
        select 'S' || l_suppkey as station_ref, l_suppkey, cast(year(l_shipdate) as integer) as own_year,
               cast(year(l_shipdate) as integer) + (l_linenumber = 7)::int as year, cast(l_shipdate as date) as date,
               l_returnflag, l_orderkey, l_linenumber, l_partkey, l_extendedprice,
               try_cast(round(cast(cast(l_extendedprice as varchar) as decimal(18, 4)), 3) as decimal(8, 3)) as value_m
        from lineitem
    ), kept as (
        select *, row_number() over (
            partition by station_ref, date order by l_orderkey, l_linenumber, l_partkey, l_extendedprice) as turn
        from lines where l_returnflag = 'N' and own_year = year
    ), landed as (
        select station_ref, year from lines where l_suppkey % 10 <> 0 group by 1, 2
        union
        select 'S' || s_suppkey, y.year from supplier, (select unnest(range(1995, 2002))::int as year) y
        where s_suppkey % 10 = 0
    ), units as (
        select u.station_ref, u.year, count(k.station_ref) filter (where k.l_suppkey % 10 <> 0) as n_rows,
               coalesce(bool_or(k.value_m is null or k.year < 2000) filter (where k.l_suppkey % 10 <> 0), false) as failed
        from landed u left join kept k on k.station_ref = u.station_ref and k.year = u.year
        where u.year between 1995 and 2001 group by 1, 2
    ), added as (
        select k.* from kept k join units u on u.station_ref = k.station_ref and u.year = k.year
        where not u.failed and k.turn = 1 and k.l_suppkey % 10 <> 0
    )
"""

_LANDED_POLL = """
    with polled as (
        select case when user_id <> 0 then 'A' || user_id end as area, user_id, event_id,
               cast(length(event_type) - 4 as integer) as level, event_type as label,
               case when event_id % 3 = 0 then true when event_id % 5 <> 1 then false end as tidal,
               cast(cast(floor(value / 25) as bigint) as varchar) as message,
               '2024-01-0' || nullif(length(props) % 3, 0) || ' 09:00:00' as noted
        from events where length(event_type) - 4 <= 3
    ), lagged as (
        select *, coalesce(area, 'row ' || event_id) as grp from polled
    ), linked as (
        select *, row_number() over w as rn, lag(level) over w as p_level, lag(message) over w as p_message,
               lag(noted) over w as p_noted
        from lagged window w as (partition by grp order by event_id)
    ), steps as (
        select *, rn = 1 or level is distinct from p_level or message is distinct from p_message
            or noted is distinct from p_noted as changed
        from linked
    ), ranked as (
        select *, row_number() over (partition by grp order by event_id desc) as from_end,
               row_number() over (partition by grp, changed order by event_id desc) as change_from_end
        from steps
    )
    select f.area as flood_area_id, cast(f.event_id as varchar) as description, 'C' as county,
           z.level as severity_level, c.label as severity_label, f.tidal as is_tidal, z.message,
           cast(k.c_nationkey as double) as lat,
           cast(cast(round(cast(cast(k.c_acctbal / 100 as varchar) as decimal(18, 12)), 6) as decimal(9, 6)) as varchar) as lon,
           '2024-01-01 07:30:00' as time_raised, z.noted as changed_at, '2024-01-01 10:00:00' as polled_at,
           cast(w.c_nationkey as double) as temperature_c, case when w.c_custkey is not null then 0.25::double end as precipitation_mm,
           case when w.c_custkey is not null then w.c_nationkey + 1 end as wind_direction_deg,
           w.c_nationkey * 2 as weather_code
    from ranked f
    join ranked z on z.grp = f.grp and z.from_end = 1
    join ranked c on c.grp = f.grp and c.changed and c.change_from_end = 1
    left join customer k on 'A' || k.c_custkey = f.area
    left join customer w on 'A' || w.c_custkey = f.area and w.c_acctbal > 0 and w.c_nationkey <> 0
    where f.rn = 1"""

SQL: dict[str, str] = {
    "insert_ignore_batch": f"""
        select {_LINE_COLUMNS} from (
            select *, row_number() over (partition by l_orderkey, l_linenumber order by {_LINE_ORDER}) as rn
            from lineitem) where rn = 1""",
    "insert_ignore_existing": f"""
        with target as (
            select {_LINE_COLUMNS} from (
                select *, row_number() over (partition by l_orderkey, l_linenumber order by {_LINE_ORDER}) as rn
                from lineitem where l_shipdate < timestamp '1998-01-01') where rn = 1
        ), batch as (
            select {_LINE_COLUMNS} from (
                select *, row_number() over (partition by l_orderkey, l_linenumber order by {_LINE_ORDER}) as rn
                from lineitem where l_shipdate >= timestamp '1998-01-01') where rn = 1
        )
        select * from target
        union all
        select * from batch b where not exists (
            select 1 from target t where t.l_orderkey = b.l_orderkey and t.l_linenumber = b.l_linenumber)""",
    "null_keys": """
        with keyed as (
            select nullif(user_id, 0) as user_key, cast(date_trunc('hour', ts) as timestamp) as hour,
                   event_id, coalesce(minute(ts) >= 20, true) as late
            from events
        ), batch as (
            select *, row_number() over (partition by user_key, hour order by event_id) as rn
            from keyed where late
        )
        select user_key, hour, event_id from batch b
        where user_key is null or hour is null
           or (rn = 1 and not exists (
                select 1 from keyed t where not t.late and t.user_key = b.user_key and t.hour = b.hour))""",
    "guarded_upsert": _STATE + "select * from state",
    "upsert_actions": _STEPS
    + """
        select count(*) filter (where late and rn = 1) as n_insert,
               count(*) filter (where late and rn > 1 and changed_) as n_update,
               count(*) filter (where late and not changed_) as n_noop,
               count(*) filter (where late and changed_) as n_stored
        from steps""",
    "distinct_from": """
        with e as (
            select event_id, user_id, nullif(event_type, 'error') as level,
                   nullif(cast(floor(value / 25) as integer), 0) as message
            from events
        )
        select event_id, user_id, row_number() over w > 1 as has_previous,
               level is distinct from lag(level) over w as level_distinct,
               message is distinct from lag(message) over w as message_distinct
        from e window w as (partition by user_id order by event_id)""",
    "hour_bucket": "select distinct user_id, cast(date_trunc('hour', ts) as timestamp) as hour from events",
    "last_wins": """
        select user_id, event_type, event_id from (
            select *, row_number() over (partition by user_id order by event_id desc) as rn from events)
        where rn = 1""",
    "first_entry": """
        with o as (
            select *, row_number() over (partition by o_custkey order by o_orderkey) as rn,
                   row_number() over (partition by o_custkey, o_totalprice > 200000 order by o_orderkey) as large_rn
            from orders
        )
        select c.o_custkey, f.o_orderkey as first_orderkey, f.o_totalprice as first_price, c.n_orders,
               l.o_orderkey as first_large_orderkey, l.o_totalprice as first_large_price, c.n_large_orders
        from (select o_custkey, count(*) as n_orders, count(*) filter (where o_totalprice > 200000) as n_large_orders
              from orders group by 1) c
        join o f on f.o_custkey = c.o_custkey and f.rn = 1
        left join o l on l.o_custkey = c.o_custkey and l.o_totalprice > 200000 and l.large_rn = 1""",
    "latest_per_key": """
        select user_id, event_type, ts, event_id, value from (
            select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rn
            from events)
        where rn = 1""",
    "left_lookup": """
        select o_orderkey, o_custkey, o_totalprice, c_nationkey, c_acctbal
        from orders left join (select * from customer where c_acctbal > 0) on o_custkey = c_custkey""",
    "snapshot_enrich": _STEPS
    + """
        , touched as (
            select user_id, hour, count(*) as n_attempts from steps where late and changed_
            group by user_id, hour, lone
        )
        select t.user_id, t.hour, t.n_attempts, c.c_nationkey, w.c_acctbal
        from touched t
        join customer c on c.c_custkey = t.user_id and c.c_nationkey <> 0
        left join customer w on w.c_custkey = t.user_id and w.c_acctbal > 0""",
    "pending_units": _PENDING,
    "ledger_parse": """
        select distinct 'C:' || o_custkey || ':' || year(o_orderdate) as unit_key,
               'C:' || o_custkey as ref, cast(year(o_orderdate) as integer) as year
        from orders""",
    "ledger_append": """
        select distinct o_custkey, cast(year(o_orderdate) as integer) as year from orders
        where year(o_orderdate) >= 1998""",
    "unit_status": _UNIT_STATUS,
    "run_summary": f"""
        with status as ({_UNIT_STATUS}), pending as ({_PENDING})
        select 'inserted' as metric, cast(sum(n_rows) filter (where status = 'done') as bigint) as total from status
        union all select 'scanned', cast(sum(n_rows) as bigint) from status
        union all select 'failed', count(*) filter (where status = 'failed') from status
        union all select 'done', count(*) filter (where status = 'done') from status
        union all select 'expected', count(*) * 7 from supplier
        union all select 'pending', count(*) from pending""",
    "quality_filter": """
        select l.doc_id, l.quality, l.toxic, d.lang, d.n_chars
        from labels l join documents d on l.doc_id = d.doc_id
        where l.quality = 1 and d.n_chars is not null""",
    "quality_lines": "select * from lineitem where l_returnflag = 'R' and l_quantity is not null",
    "severity_filter": """
        select o_orderkey, o_orderpriority, cast(substring(o_orderpriority, 1, 1) as integer) as severity_level
        from orders where cast(substring(o_orderpriority, 1, 1) as integer) <= 3""",
    "coords_filter": """
        select c_custkey, c_name, nullif(c_nationkey, 0) as lat, c_acctbal as lon from customer
        where c_name is not null and c_name <> '' and nullif(c_nationkey, 0) is not null and c_acctbal is not null""",
    "date_range": """
        select o_orderkey, cast(o_orderdate as date) as day,
               case when cast(o_orderdate as date) between date '1996-03-01' and date '1998-02-28'
                    then 'closed' else 'open' end as "window"
        from orders
        where cast(o_orderdate as date) between date '1996-03-01' and date '1998-02-28'
           or cast(o_orderdate as date) between date '2001-01-01' and current_date""",
    "year_units": """
        select o_orderkey, cast(o_orderdate as date) as day, cast(year(o_orderdate) as integer) as year,
               make_date(year(o_orderdate), 1, 1) as year_start, make_date(year(o_orderdate), 12, 31) as year_end,
               cast(o_orderdate as date) between date '1996-01-01' and date '2000-12-31' as routable
        from orders where o_orderkey % 7 <> 0""",
    "const_columns": """
        select s_suppkey, '' as label, cast(null as double) as lat, cast(null as double) as lon, 'EA' as source
        from supplier""",
    "default_missing": """
        select d.doc_id, d.source,
               case when l.doc_id is null then false when l.doc_id % 5 <> 0 then coalesce(l.toxic = 1, false) end as is_toxic
        from documents d left join labels l on d.doc_id = l.doc_id""",
    "zip_explode": """
        with valid as (
            select vec_id, embedding from embeddings
            where len(list_filter(embedding, lambda x: x > cast(-0.3 as float))) = len(embedding)
        ), numbered as (
            select vec_id, embedding, cast(unnest(range(0, len(embedding))) as integer) as pos from valid
        )
        select vec_id, pos, cast(embedding[pos + 1] as double) as value, cast(embedding[pos + 1] as double) * 2 as doubled,
               cast(null as double) as absent
        from numbered""",
    "first_match": """
        with w as (
            select doc_id, string_split(text, ' ') as words from documents
        ), m as (
            select doc_id, list_filter(words, lambda x: length(x) >= 12)[1] as first_long_word, words from w
        )
        select doc_id, first_long_word,
               cast(list_position(words, first_long_word) - 1 as integer) as first_long_pos,
               first_long_word is not null as has_match
        from m""",
    "array_head": "select doc_id, string_split(text, chr(10))[2] as second_line from documents",
    "json_field": "select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events",
    "extract_ref": """
        with s as (
            select page_id, url, string_split(string_split(url, '//')[-1], '/')[1] as segment from pages
        )
        select page_id, string_split(segment, '.example')[1] as ref from s
        where contains(url, '//') and contains(segment, '.example') and string_split(segment, '.example')[1] <> ''""",
    "to_decimal": """
        select l_orderkey, l_linenumber, l_partkey, l_shipdate,
               cast(cast(round(cast(cast(l_extendedprice as varchar) as decimal(18, 4)), 1) as decimal(12, 1)) as varchar)
                   as price
        from lineitem""",
    "to_int": """
        select event_id, cast(round(value) as integer) as rounded, cast(round(-value) as integer) as rounded_negative,
               cast(round(value) as integer) + 1 as half_up
        from events""",
    "page_cap": """
        with numbered as (
            select p_partkey, row_number() over (order by p_partkey) - 1 as pos from part
        )
        select p_partkey, pos, pos // 500 as page from numbered""",
    "catalogue_pages": """
        with numbered as (
            select *, row_number() over (order by p_partkey) - 1 as n from part
        ), paged as (
            select *, n // 1498 as block, n % 1498 as place from numbered
        )
        select cast(block * 3 + (place >= 500)::int + (place >= 998)::int as int) as page,
            cast(case when place < 500 then place when place < 998 then place - 500 else place - 998 end as int) as pos,
            'P' || p_partkey as station_ref, p_name as label, p_size::double as lat, p_retailprice as lon,
            p_type as catchment, 'm' || p_size as daily_level_measure_url
        from paged""",
    "fk_orphans": """
        select l_orderkey, count(*) as n_rows from lineitem l
        where not exists (select 1 from orders o where o.o_orderkey = l.l_orderkey and o.o_totalprice > 100000)
        group by 1""",
    "unique_audit": """
        select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1""",
    "level_units": _LEVELS + "select station_ref, year, n_rows, failed from units",
    "failed_units": _LEVELS
    + """
        select station_ref, year, l_orderkey, l_linenumber, reason
        from (select *, row_number() over (
                  partition by station_ref, year order by l_orderkey, l_linenumber, l_partkey, reason) as rn
              from (select *, case when value_m is null then 'bad value for value_m: ' || l_extendedprice
                                   when year not between 2000 and 2026 then 'no partition for ' || date end as reason from good)
              where reason is not null)
        where rn = 1""",
    "level_backfill": _LEVELS
    + """
        select station_ref, date, cast(value_m as varchar) as value_m, 'Good' as quality, 'EA' as source
        from (select g.*, row_number() over (
                  partition by g.station_ref, g.date order by l_orderkey, l_linenumber, l_partkey, value_m) as rn
              from good g join units u on u.station_ref = g.station_ref and u.year = g.year and not u.failed)
        where rn = 1""",
    "weather_backfill": """
        with valid as (
            select vec_id, embedding from embeddings
            -- elements 10 to 51 are the days of the range
            where len(list_filter(embedding[10:51], lambda x: abs(round(cast(x as double) * 1000)) * 3 >= 1000)) = 0
        ), days as (
            select vec_id, embedding, unnest(range(0, len(embedding))) as i from valid
        ), kept as (
            select 'V' || vec_id as station_ref, cast(date '2020-01-01' + cast(i as integer) as date) as date,
                   cast(round(cast(embedding[i + 1] as double) * 1000) as integer) as n
            from days
        )
        select station_ref, date,
               cast(cast(round(cast(n || '.125' as decimal(18, 3)), 2) as decimal(7, 2)) as varchar) as precipitation_sum,
               cast(round(cast(n || '.5' as decimal(18, 1))) as integer) as winddirection_dominant,
               cast(cast(n * 3 as decimal(5, 2)) as varchar) as temperature_mean,
               cast(null as double) as windspeed_max
        from kept where date between date '2020-01-10' and date '2020-02-20'""",
    "landed_rivers": _RIVERS
    + """
        select u.station_ref, u.year, case when u.failed then 'failed' else 'done' end as status, u.n_rows,
               count(a.date) over (partition by u.station_ref, u.year) as n_inserted, a.date,
               cast(a.value_m as varchar) as value_m, case when a.date is not null then 'Good' end as quality,
               case when a.date is not null then 'EA' end as source
        from units u left join added a on a.station_ref = u.station_ref and a.year = u.year""",
    "river_rerun": _RIVERS
    + """
        select u.station_ref, u.year, case when u.failed then 'failed' else 'done' end as status, u.n_rows,
               -- What the first run stored is there already.
               count(a.date) filter (where cast(substr(u.station_ref, 2) as integer) % 2 = 1) as n_inserted
        from units u left join added a on a.station_ref = u.station_ref and a.year = u.year
        group by all""",
    "landed_weather": """
        with days as (
            select vec_id, 'V' || vec_id as station_ref, unnest(range(len(embedding)))::int as i, embedding from embeddings
            where vec_id % 7 <> 0 and vec_id % 11 <> 0 and vec_id % 13 <> 0
        ), rows_ as (
            select station_ref, cast(date '2020-01-01' + i as date) as date,
                   cast(round(cast(embedding[i + 1] as double) * 1000) as integer) as n from days
        )
        select station_ref, date, cast(cast(cast(n as decimal(9, 0)) / 100 as decimal(7, 2)) as varchar) as precipitation_sum,
               cast(round(cast(n as decimal(9, 0)) + 0.5) as integer) as winddirection_dominant,
               cast(null as double) as windspeed_max
        from rows_ where date between date '2020-01-10' and date '2020-02-20'""",
    "landed_poll": _LANDED_POLL,
    # Running a poll again repairs it.
    "poll_repair": _LANDED_POLL,
    "poll_backlog": """
        with polled as (
            select case when user_id <> 0 then 'A' || user_id end as area, user_id, event_id, event_id % 100 as p, event_id % 100 // 3 as hour,
                   cast(length(event_type) - 4 as integer) as level, event_type as label,
                   case when event_id % 3 = 0 then true when event_id % 5 <> 1 then false end as tidal,
                   cast(cast(floor(value / 25) as bigint) as varchar) as message,
                   '2024-01-0' || nullif(length(props) % 3, 0) || ' 09:00:00' as noted
            from events where length(event_type) - 4 <= 3
        ), lagged as (
            select *, coalesce(area || ' ' || hour, 'row ' || event_id) as grp from polled
        ), linked as (
            select *, row_number() over w as rn, lag(level) over w as p_level, lag(message) over w as p_message,
                   lag(noted) over w as p_noted
            from lagged window w as (partition by grp order by p, event_id)
        ), steps as (
            select *, rn = 1 or level is distinct from p_level or message is distinct from p_message
                or noted is distinct from p_noted as changed
            from linked
        ), ranked as (
            select *, row_number() over (partition by grp order by p desc, event_id desc) as from_end,
                   row_number() over (partition by grp, changed order by p desc, event_id desc) as change_from_end
            from steps
        )
        select f.area as flood_area_id, cast(f.event_id as varchar) as description, 'C' as county,
               z.level as severity_level, c.label as severity_label, f.tidal as is_tidal, z.message,
               cast(null as double) as lat, cast(null as varchar) as lon,
               '2024-01-01 07:30:00' as time_raised, z.noted as changed_at,
               strftime(timestamp '2024-01-01' + to_hours(cast(f.hour as integer)), '%Y-%m-%d %H:%M:%S') as polled_at
        from ranked f
        join ranked z on z.grp = f.grp and z.from_end = 1
        join ranked c on c.grp = f.grp and c.changed and c.change_from_end = 1
        where f.rn = 1""",
    "landed_readings": """
        select 'U' || user_id as station_ref, '' as station_label, cast(null as double) as lat,
               cast(cast(round(cast(cast(value as varchar) as decimal(18, 10)), 3) as decimal(8, 3)) as varchar) as value_m,
               strftime(day, '%Y-%m-%d %H:%M:%S') as reading_at, true as has_polled_at
        from (
            select *, row_number() over (partition by user_id, day, case when day is null then event_id end order by event_id) as turn
            from (select *, date_trunc('day', ts)::timestamp as day from events) e
        ) r where turn = 1 and user_id is not null""",
    "poll_events": _POLL
    + """
        select f.area as flood_area_id, cast(f.event_id as varchar) as description, z.level as severity_level,
               c.label as severity_label, z.message, cast(k.c_nationkey as double) as lat,
               z.noted as noted_at, cast(1 as bigint) as n_insert, n.n_update, n.n_noop
        from ranked f
        join ranked z on z.grp = f.grp and z.from_end = 1
        join ranked c on c.grp = f.grp and c.changed and c.change_from_end = 1
        join counts n on n.grp = f.grp
        left join customer k on 'A' || k.c_custkey = f.area
        where f.rn = 1""",
    "poll_snapshots": """
        select 'A' || c.c_custkey as flood_area_id,
               case when c.c_acctbal > 0
                    then cast(cast(round(cast(c.c_nationkey || '.125' as decimal(18, 3)), 2) as decimal(5, 2)) as varchar)
               end as temperature_c,
               case when c.c_acctbal > 0 then c.c_nationkey + 1 end as wind_direction_deg,
               cast(null as integer) as humidity_pct
        from (select distinct user_id from events where user_id <> 0) e
        join customer c on c.c_custkey = e.user_id and c.c_nationkey <> 0 and c.c_acctbal <> 0""",
    "poll_stream": _STATE + "select * from state",
    "hourly_state": _STATE
    + """
        select s.*, c.c_nationkey, c.c_mktsegment
        from state s left join customer c on c.c_custkey = s.user_id""",
}

"""DuckDB oracle SQL fragments shared by the registered queries."""

from __future__ import annotations

from ..sources.fixtures import READINGS_SQL

R = f"with r as ({READINGS_SQL})"

METRIC_CASE = ("case data_id when 0 then 'temperature' when 1 then 'humidity' "
               "when 2 then 'light' when 3 then 'motion' end")

AS_OF = "(select max(time) from r)"


def last_period(n: int, unit: str, src: str = "r") -> str:
    return (f"select * from {src} where time > {AS_OF} - interval {n} {unit} "
            f"and time <= {AS_OF}")


def rollup(bucket_expr: str, ops=("MAX", "MIN", "SUM", "COUNT"), part: str | None = None) -> str:
    """Roll-up points per bucket x measure x level, one row per operator; with
    ``part``, SUM adds up the sums of these smaller buckets."""
    total = f"select level, bucket, data_id, gk, {xsum('data')} as s, count(*) as c from lv"
    if part:
        total = (f"select level, bucket, data_id, gk, {xsum('s')} as s, sum(c) as c from ("
                 f"select level, bucket, data_id, gk, {xsum('data')} as s, count(*) as c from lv "
                 f"group by level, bucket, data_id, gk, {part})")
    op_list = ", ".join(f"'{o}'" for o in ops)
    return f"""{R},
b as (select {bucket_expr} as bucket, data_id, mun, room_id, time, data
      from r where data_id between 0 and 3),
lv as (select 'city' as level, bucket, data_id, 0 as gk, mun, room_id, time, data from b
       union all select 'municipality', bucket, data_id, mun, mun, room_id, time, data from b
       union all select 'space', bucket, data_id, room_id, mun, room_id, time, data from b),
rk as (select *,
        row_number() over (partition by level, bucket, data_id, gk
                           order by data desc, time, room_id) as rmax,
        row_number() over (partition by level, bucket, data_id, gk
                           order by data asc, time, room_id) as rmin,
        row_number() over (partition by level, bucket, data_id, gk
                           order by time, room_id) as rfirst
       from lv),
tot as ({total} group by level, bucket, data_id, gk),
pts as (select level, bucket, data_id, 'MAX' as aggregate, time, data as value, mun, room_id
        from rk where rmax = 1
        union all select level, bucket, data_id, 'MIN', time, data, mun, room_id
        from rk where rmin = 1
        union all select f.level, f.bucket, f.data_id, 'SUM', f.time, t.s, f.mun, f.room_id
        from rk f join tot t using (level, bucket, data_id, gk) where f.rfirst = 1
        union all select f.level, f.bucket, f.data_id, 'COUNT', f.time, cast(t.c as double),
                         f.mun, f.room_id
        from rk f join tot t using (level, bucket, data_id, gk) where f.rfirst = 1)
select cast(bucket as timestamp) as bucket, data_id, {METRIC_CASE} as metric, level, aggregate,
       cast(epoch(time) as bigint) as timestamp, value, 'Brussels' as city,
       case when level = 'city' then null else mun end as municipality,
       case when level = 'space' then room_id end as space,
       room_id as arg_room
from pts where aggregate in ({op_list})"""


def space_stats(src: str) -> str:
    """MAX / MIN / AVG / COUNT per measure and level over CTE ``src``."""
    cols = (f"max(data) as max_value, min(data) as min_value, {xavg('data')} as avg_value, "
            "count(*) as n")
    return f"""
select {METRIC_CASE} as metric, 'city' as level, null::integer as municipality,
       null::integer as space, {cols} from {src} group by data_id
union all
select {METRIC_CASE}, 'municipality', mun, null::integer, {cols} from {src} group by data_id, mun
union all
select {METRIC_CASE}, 'space', null::integer, room_id, {cols} from {src} group by data_id, room_id"""


def slots(src: str, width: str = "15 minutes") -> str:
    """CTEs t, lv, s: temperature slots at each level over ``src``."""
    return f"""
t as (select time_bucket(interval '{width}', time) as slot_start, mun, room_id, data
      from {src} where data_id = 0),
lv as (select 'city' as level, null::integer as municipality, null::integer as space,
              slot_start, data from t
       union all select 'municipality', mun, null::integer, slot_start, data from t
       union all select 'space', null::integer, room_id, slot_start, data from t),
s as (select level, municipality, space, slot_start, {xsum('data')} as sum_temp, count(*) as n
      from lv group by level, municipality, space, slot_start)"""


DAY_NIGHT = "case when {a} >= 19 then 'daytime' when {a} < 19 then 'nighttime' end"


def xsum(x: str) -> str:
    """Exact sum of doubles in DuckDB: integers in units of 2^-60, rounded once
    (0 over no values)."""
    unit = f"{2 ** 60}e0"
    total = f"sum(cast(({x}) * {unit} as hugeint))"
    return f"(coalesce(cast(cast({total} as varchar) as double) / {unit}, 0e0))"


def xavg(x: str) -> str:
    return f"({xsum(x)} / count({x}))"

"""Batch-layer queries: parsing, raw and roll-up points, Query 1 / Query 2,
dimension lookups, store maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parse
from ..functions.timefns import to_ntz
from ..operators import enrich, points, ranges, rollup, stats
from ..schema import MEASURES
from ..sources import dims, fixtures
from . import sql as S
from .catalog import register

READ_COLS = ["event_id", "time", "mun", "room_id", "data_id", "data", "voltage"]


def _readings_out(df):
    return df.select("event_id", to_ntz("time").alias("time"), "mun", "room_id", "data_id",
                     "data", "voltage")


# -- parsing ------------------------------------------------------------------

@register("parse_lines", f"{S.R} select event_id, time, mun, room_id, data_id, data, voltage from r")
def q_parse_lines(spark, sf):
    return _readings_out(parse.parse_lines(fixtures.reading_lines(spark, sf)))


@register("parse_rejects", """
select event_id,
       case event_id % 6 when 0 then 'fields' when 1 then 'id' when 2 then 'value'
                         when 3 then 'time' when 4 then 'time' else 'empty' end as reject
from events where event_type = 'error'""")
def q_parse_rejects(spark, sf):
    return parse.rejected_lines(fixtures.reading_lines(spark, sf)).select("event_id", "reject")


# -- raw datapoints -------------------------------------------------------------

def _raw_sql(i: int, m: str) -> str:
    return (f"{S.R} select '{m}' as metric, cast(epoch(time) as bigint) as timestamp, "
            f"data as value, 'Brussels' as city, mun as municipality, room_id as space, "
            f"'RAW' as aggregate, event_id from r where data_id = {i}")


def _raw_builder(m: str):
    def build(spark, sf):
        return points.raw_points(fixtures.readings(spark, sf), m)
    return build


for _i, _m in enumerate(MEASURES):
    register(f"raw_points_{_m}", _raw_sql(_i, _m))(_raw_builder(_m))


# -- roll-ups ---------------------------------------------------------------------

def _rollup_builder(op: str):
    def build(spark, sf):
        return rollup.rollup(fixtures.readings(spark, sf), "1 minute", ops=[op])
    return build


for _op in ["MAX", "MIN", "SUM", "COUNT"]:
    register(f"rollup_{_op.lower()}", S.rollup("date_trunc('minute', time)", [_op]))(
        _rollup_builder(_op))


@register("rollup_points", S.rollup("date_trunc('minute', time)"))
def q_rollup_points(spark, sf):
    """All 48 outputs (4 measures x 4 operators x 3 levels) of every minute."""
    return rollup.rollup(fixtures.readings(spark, sf), "1 minute")


@register("rollup_reaggregate_hour",
          S.rollup("date_trunc('hour', time)", part="date_trunc('minute', time)"))
def q_rollup_reaggregate_hour(spark, sf):
    """Minute roll-ups combined into hours == hourly roll-up of the raw data."""
    minutes = rollup.rollup(fixtures.readings(spark, sf), "1 minute")
    return rollup.reaggregate(minutes, "hour")


@register("rollup_avg", f"""{S.R},
b as (select date_trunc('minute', time) as bucket, * from r where data_id between 0 and 3)
select bucket, {S.METRIC_CASE} as metric, 'city' as level, 'Brussels' as city,
       null::integer as municipality, null::integer as space, {S.xavg('data')} as avg_value,
       count(*) as n from b group by bucket, data_id
union all
select bucket, {S.METRIC_CASE}, 'municipality', 'Brussels', mun, null::integer, {S.xavg('data')},
       count(*) from b group by bucket, data_id, mun
union all
select bucket, {S.METRIC_CASE}, 'space', 'Brussels', mun, room_id, {S.xavg('data')}, count(*)
from b group by bucket, data_id, mun, room_id""")
def q_rollup_avg(spark, sf):
    """AVG derived from the SUM and COUNT roll-ups equals AVG of the raw data."""
    return rollup.avg_from_rollups(rollup.rollup(fixtures.readings(spark, sf), "1 minute",
                                                 ops=["SUM", "COUNT"]))


# -- Query 1: statistics over the last x ---------------------------------------------

_LAST = {"hours": (5, "hours"), "days": (7, "days"), "months": (1, "month"),
         "years": (1, "year")}


def _stats_builder(n: int, unit: str):
    def build(spark, sf):
        return stats.stats_last(fixtures.readings(spark, sf), n, unit)
    return build


for _k, (_n, _u) in _LAST.items():
    register(f"stats_last_{_k}",
             f"{S.R}, f as ({S.last_period(_n, _u)} and data_id between 0 and 3)"
             f"{S.space_stats('f')}")(_stats_builder(_n, _u))


@register("stats_last_space",
          f"{S.R}, f as ({S.last_period(7, 'days')} and data_id = 0 and room_id = 10)"
          f"{S.space_stats('f')}")
def q_stats_last_space(spark, sf):
    """Temperature of one space over the last 7 days (as-of time of all data)."""
    r = fixtures.readings(spark, sf)
    last = stats.last_period(r, 7, "days").filter(F.col("data_id") == 0)
    return stats.space_stats(ranges.space_filter(last, "space", 10))


@register("stats_last_municipality",
          f"{S.R}, f as ({S.last_period(7, 'days')} and data_id between 0 and 3 and mun = 3)"
          f"{S.space_stats('f')}")
def q_stats_last_municipality(spark, sf):
    """One municipality over the last 7 days."""
    last = stats.last_period(fixtures.readings(spark, sf), 7, "days")
    return stats.space_stats(ranges.space_filter(last, "municipality", 3))


# -- Query 2: day / night slots ------------------------------------------------------

@register("slot_day_night", f"""{S.R}, {S.slots('r')}
select level, municipality, space, slot_start, cast(slot_start as date) as day,
       cast(hour(slot_start) * 4 + minute(slot_start) // 15 as integer) as slot,
       sum_temp, n, sum_temp / n as avg_temp, {S.DAY_NIGHT.format(a='sum_temp / n')} as period
from s""")
def q_slot_day_night(spark, sf):
    return stats.slot_classes(fixtures.readings(spark, sf))


_HOURS = S.slots("p", "6 hours")


@register("slot_rollup_6h_slots", f"""{S.R}, p as ({S.last_period(14, "days")}), {_HOURS},
c as (select *, {S.DAY_NIGHT.format(a='sum_temp / n')} as period from s)
select level, municipality, space, date_trunc('week', slot_start) as bucket,
       cast(sum(case when period = 'daytime' then 1 else 0 end) as bigint) as daytime_slots,
       cast(sum(case when period = 'nighttime' then 1 else 0 end) as bigint) as nighttime_slots,
       cast(sum(n) as bigint) as n, {S.xsum('sum_temp')} / sum(n) as avg_temp,
       {S.DAY_NIGHT.format(a=S.xsum('sum_temp') + ' / sum(n)')} as period
from c group by level, municipality, space, date_trunc('week', slot_start)""")
def q_slot_rollup_6h_slots(spark, sf):
    """Query 2 with six-hour slots, by week."""
    return stats.slot_rollup(fixtures.readings(spark, sf), 14, "days", "week", slot="6 hours")


_SLOT_ROLLUPS = {"hour": (7, "days"), "day": (14, "days"), "week": (1, "month"),
                 "month": (1, "year")}


def _slot_rollup_sql(bucket: str, n: int, unit: str) -> str:
    avg = f"{S.xsum('sum_temp')} / sum(n)"
    return f"""{S.R}, p as ({S.last_period(n, unit)}), {S.slots('p')},
c as (select *, {S.DAY_NIGHT.format(a='sum_temp / n')} as period from s)
select level, municipality, space, date_trunc('{bucket}', slot_start) as bucket,
       cast(sum(case when period = 'daytime' then 1 else 0 end) as bigint) as daytime_slots,
       cast(sum(case when period = 'nighttime' then 1 else 0 end) as bigint) as nighttime_slots,
       cast(sum(n) as bigint) as n, {avg} as avg_temp, {S.DAY_NIGHT.format(a=avg)} as period
from c group by level, municipality, space, date_trunc('{bucket}', slot_start)"""


def _slot_rollup_builder(bucket: str, n: int, unit: str):
    def build(spark, sf):
        return stats.slot_rollup(fixtures.readings(spark, sf), n, unit, bucket)
    return build


for _b, (_n, _u) in _SLOT_ROLLUPS.items():
    register(f"slot_rollup_{_b}", _slot_rollup_sql(_b, _n, _u))(
        _slot_rollup_builder(_b, _n, _u))


# -- dimension lookups --------------------------------------------------------------

def _values(rows, cols) -> str:
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(values {body}) as d({', '.join(cols)})"


@register("space_enriched", f"""{S.R}
select r.event_id, r.time, r.mun, r.room_id, r.data_id, r.data, r.voltage,
       cast(d.x as double) as x, cast(d.y as double) as y
from r left join {_values(dims.space_rows(), ['room_id', 'x', 'y'])} on r.room_id = d.room_id""")
def q_space_enriched(spark, sf):
    r = enrich.with_coordinates(fixtures.readings(spark, sf))
    return r.select(*[to_ntz("time").alias("time") if c == "time" else c for c in READ_COLS],
                    "x", "y")


@register("municipality_enriched", f"""{S.R}
select r.event_id, r.time, r.mun, r.room_id, r.data_id, r.data, r.voltage,
       m.name as municipality_name, rm.name as room_municipality_name
from r
left join {_values(dims.municipality_name_rows(), ['mun', 'name'])
           .replace(' as d(', ' as m(')} on r.mun = m.mun
left join {_values(dims.room_municipality_rows(), ['room_id', 'name'])
           .replace(' as d(', ' as rm(')} on r.room_id = rm.room_id""")
def q_municipality_enriched(spark, sf):
    r = enrich.with_municipality_names(fixtures.readings(spark, sf))
    return r.select(*[to_ntz("time").alias("time") if c == "time" else c for c in READ_COLS],
                    "municipality_name", "room_municipality_name")


# -- store maintenance ----------------------------------------------------------------

@register("dedupe_last_write", f"""{S.R},
p as (select {S.METRIC_CASE} as metric, cast(epoch(time) as bigint) as timestamp, data as value,
             'Brussels' as city, mun as municipality, room_id as space, 'RAW' as aggregate,
             event_id from r where data_id between 0 and 3)
select metric, timestamp, arg_max(value, event_id) as value, city, municipality, space,
       aggregate, max(event_id) as event_id
from p group by metric, timestamp, city, municipality, space, aggregate""")
def q_dedupe_last_write(spark, sf):
    """Same (metric, tags, timestamp) written twice: the later write wins."""
    return points.last_write_wins(points.raw_points(fixtures.readings(spark, sf)))


@register("retention_10y", f"""{S.R}
select event_id, time, mun, room_id, data_id, data, voltage from r
where time >= {S.AS_OF} - interval 10 year""")
def q_retention_10y(spark, sf):
    return _readings_out(points.retain(fixtures.readings(spark, sf), years=10))


@register("retention_10d", f"""{S.R}
select event_id, time, mun, room_id, data_id, data, voltage from r
where time >= {S.AS_OF} - interval 10 day""")
def q_retention_10d(spark, sf):
    """A retention that removes rows at this scale."""
    return _readings_out(points.retain(fixtures.readings(spark, sf), days=10))


_POINTS_SQL = f"""
with rp as ({S.rollup("date_trunc('minute', time)")}),
rw as ({S.R} select {S.METRIC_CASE} as metric, cast(epoch(time) as bigint) as timestamp,
       data as value, 'Brussels' as city, mun as municipality, room_id as space,
       'RAW' as aggregate from r where data_id between 0 and 3),
u as (select metric, timestamp, value, city, municipality, space, aggregate from rw union all
      select metric, timestamp, value, city, municipality, space, aggregate from rp)"""


@register("points_json_batches", _POINTS_SQL + " select * from u")
def q_points_json_batches(spark, sf):
    """Requests of at most 50 documents each, their members parsed back."""
    r = fixtures.readings(spark, sf)
    pts = points.serving_union(points.raw_points(r), rollup.datapoints(rollup.rollup(r)))
    return points.read_batches(points.to_batches(pts, 50)).drop("tag_keys")


@register("points_json", f"""
with rp as ({S.rollup("date_trunc('minute', time)")}),
rw as ({S.R} select {S.METRIC_CASE} as metric, cast(epoch(time) as bigint) as timestamp,
       data as value, 'Brussels' as city, mun as municipality, room_id as space,
       'RAW' as aggregate from r where data_id between 0 and 3),
u as (select metric, timestamp, value, city, municipality, space, aggregate from rw union all
      select metric, timestamp, value, city, municipality, space, aggregate from rp)
select *, 'city' || case when municipality is null then '' else ',municipality' end
          || case when space is null then '' else ',space' end as tag_keys from u""")
def q_points_json(spark, sf):
    """Wire documents of raw + roll-up points, their fields parsed back."""
    r = fixtures.readings(spark, sf)
    pts = points.serving_union(points.raw_points(r), rollup.datapoints(rollup.rollup(r)))
    return points.read_document(points.to_document(pts))


# -- demo operators re-aimed at the readings ---------------------------------------------

@register("range_mod_take", f"""{S.R}
select event_id, event_id % 2 as parity from r order by event_id limit 10""")
def q_range_mod_take(spark, sf):
    """Element-wise modulo over the readings, first ten by id (a take-k report)."""
    r = fixtures.readings(spark, sf)
    return r.select("event_id", (F.col("event_id") % 2).alias("parity")) \
            .orderBy("event_id").limit(10)

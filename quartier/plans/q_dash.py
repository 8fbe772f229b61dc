"""Dashboard-side queries (carpet, calendar, metric queries) and Query 3
(frequent temperatures), each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timefns import (FRAGMENTS, days_in_month, days_in_year, is_leap_year,
                                 to_ntz, week_of_month, week_of_year_monday,
                                 week_of_year_sunday)
from ..operators import calendar as cal
from ..operators import carpet as cp
from ..operators import frequent as fq
from ..operators import points, rollup, tsquery
from ..operators.ordering import with_row_index
from ..session import scratch_path
from ..sources import fixtures
from . import sql as S
from .catalog import register


def _series(spark, sf, data_id: int):
    r = fixtures.readings(spark, sf)
    return r.filter(F.col("data_id") == data_id).select(
        F.col("time").alias("ts"), F.col("data").alias("value"), F.col("event_id").alias("seq"),
        F.col("room_id").alias("series"))


def _series_sql(data_id: int) -> str:
    return (f"{S.R}, s as (select time as ts, data as value, event_id as seq, "
            f"room_id as series from r where data_id = {data_id})")


# -- carpet --------------------------------------------------------------------------

_CARPET_AGG_SQL = {"AVG": S.xavg("value"), "SUM": S.xsum("value"), "CNT": "count(value)",
                   "MIN": "min(value)", "MAX": "max(value)",
                   "FIRST": "arg_min(value, {'t': ts, 's': seq})",
                   "LAST": "arg_max(value, {'t': ts, 's': seq})"}
_CARPET = {"avg": "QUARTER", "sum": "HOUR", "cnt": "HOUR", "min": "QUARTER", "max": "QUARTER",
           "first": "HOUR", "last": "HOUR"}


def _carpet_cte(fragment: str, agg: str) -> str:
    count, width = FRAGMENTS[fragment]
    return f"""{_series_sql(0)},
bd as (select date_trunc('day', min(ts)) as d0, date_trunc('day', max(ts)) as d1 from s),
days as (select unnest(generate_series(d0, d1, interval 1 day)) as day from bd),
g as (select day, cast(slot as integer) as slot, day + to_seconds(slot * {width}) as slot_start
      from days cross join (select unnest(range(0, {count})) as slot)),
a as (select time_bucket(interval '{width} seconds', ts) as slot_start,
             {_CARPET_AGG_SQL[agg]} as value
      from s, bd where value is not null and ts >= d0 and ts < d1 + interval 1 day group by 1),
cells as (select cast(g.day as date) as day, g.slot, g.slot_start, a.value
          from g left join a on g.slot_start = a.slot_start)"""


def _carpet_builder(fragment: str, agg: str):
    def build(spark, sf):
        return cp.carpet(_series(spark, sf, 0), fragment, agg)
    return build


for _a, _f in _CARPET.items():
    register(f"carpet_{_a}", _carpet_cte(_f, _a.upper()) + " select * from cells")(
        _carpet_builder(_f, _a.upper()))


@register("carpet_minute", _carpet_cte("MINUTE", "MAX") + " select * from cells")
def q_carpet_minute(spark, sf):
    return cp.carpet(_series(spark, sf, 0), "MINUTE", "MAX")


#: Every seventh event's value is NaN, every eleventh's null.
_BROKEN = ("case when seq % 7 = 0 then cast('nan' as double) when seq % 11 = 0 then null "
           "else value end")


def _broken_sql(agg: str) -> str:
    fn = agg.lower()
    text = _carpet_cte("HOUR", agg).replace(
        f"{fn}(value)", f"coalesce({fn}(value) filter (not isnan(value)), max(value))")
    series = "s as (select time as ts, data as value, event_id as seq, room_id as series"
    return text.replace(series, "s as (select ts, " + _BROKEN + " as value, seq, series from ("
                        + series[len("s as ("):], 1).replace("where data_id = 0)",
                                                             "where data_id = 0))", 1)


def _broken(spark, sf):
    return _series(spark, sf, 0).withColumn("value", F.expr(_BROKEN))


for _a in ("MAX", "MIN"):
    register(f"carpet_{_a.lower()}_nan", _broken_sql(_a) + " select * from cells")(
        lambda spark, sf, _a=_a: cp.carpet(_broken(spark, sf), "HOUR", _a))


@register("carpet_ordered", _carpet_cte("QUARTER", "AVG") + """
select row_number() over (order by slot_start) - 1 as row_index, day, slot, slot_start, value
from cells""")
def q_carpet_ordered(spark, sf):
    """The time-ordered grid with each cell's place in the output."""
    return with_row_index(cp.carpet(_series(spark, sf, 0), "QUARTER", "AVG"), ["slot_start"],
                          scratch_path(spark, "carpet-ordered"))


@register("carpet_stats", _carpet_cte("QUARTER", "AVG") + """
select min(value) as min_value, max(value) as max_value, count(value) as filled,
       count(*) as cells from cells""")
def q_carpet_stats(spark, sf):
    return cp.carpet_stats(cp.carpet(_series(spark, sf, 0), "QUARTER", "AVG"))


@register("carpet_scaled", _carpet_cte("HOUR", "AVG") + """,
mm as (select min(value) as lo, max(value) as hi from cells)
select day, slot, slot_start, value, (value - lo) / (hi - lo) as position,
       floor(value * 100.0 + 0.5) / 100.0 as display from cells, mm""")
def q_carpet_scaled(spark, sf):
    return cp.carpet_scaled(cp.carpet(_series(spark, sf, 0), "HOUR", "AVG"))


# -- calendar ---------------------------------------------------------------------------

_N_EXPR = {
    "hour": ("(cast(epoch(date_trunc('hour', hi)) as bigint)"
             " - cast(epoch(date_trunc('hour', lo)) as bigint)) // 3600"),
    "day": ("(cast(epoch(date_trunc('day', hi)) as bigint)"
            " - cast(epoch(date_trunc('day', lo)) as bigint)) // 86400"),
    "month": "(year(hi) - year(lo)) * 12 + month(hi) - month(lo)",
    "year": "year(hi) - year(lo)",
}
_TO = {"minute": "to_minutes", "hour": "to_hours", "day": "to_days", "week": "to_weeks",
       "month": "to_months", "year": "to_years"}


def _calendar_cte(data_id: int, domain: str, sub: str) -> str:
    su = "minute" if sub == "min" else sub
    return f"""{_series_sql(data_id)},
dd as (select ts, arg_max(value, seq) as value from s group by series, ts),
b as (select min(ts) as lo, max(ts) as hi from s),
p as (select date_trunc('{domain}', lo) as d0,
             cast({_N_EXPR[domain]} + 1 as integer) as n from b),
doms as (select unnest(generate_series(d0, d0 + {_TO[domain]}(n - 1), interval 1 {domain}))
                as domain_start from p),
g as (select domain_start,
             unnest(generate_series(date_trunc('{su}', domain_start),
                                    domain_start + interval 1 {domain} - interval 1 second,
                                    interval 1 {su})) as cell_start from doms),
v as (select date_trunc('{domain}', ts) as domain_start, date_trunc('{su}', ts) as cell_start,
             {S.xsum('value')} as value
      from dd, p where not isnan(value) and ts >= d0 and ts < d0 + {_TO[domain]}(n)
      group by 1, 2),
cells as (select g.domain_start, g.cell_start, v.value
          from g left join v using (domain_start, cell_start))"""


_CALENDARS = {"hour_min": ("hour", "min"), "day_hour": ("day", "hour"),
              "month_day": ("month", "day"), "month_week": ("month", "week"),
              "year_month": ("year", "month")}


def _calendar_builder(data_id: int, domain: str, sub: str):
    def build(spark, sf):
        return cal.calendar_cells(_series(spark, sf, data_id), domain, sub)
    return build


for _k, (_d, _s) in _CALENDARS.items():
    register(f"calendar_{_k}", _calendar_cte(2, _d, _s) + " select * from cells")(
        _calendar_builder(2, _d, _s))


@register("calendar_week_day_sunday", _series_sql(2) + """,
dd as (select ts, arg_max(value, seq) as value from s group by series, ts),
v as (select date_trunc('day', ts) as cell_start, """ + S.xsum("value") + """ as value from dd
      where not isnan(value) group by 1),
b as (select min(ts) as lo, max(ts) as hi from s),
w as (select cast(date_trunc('day', lo) - to_days(cast(dayofweek(lo) as integer)) as timestamp)
             as d0,
             cast(date_trunc('day', hi) - to_days(cast(dayofweek(hi) as integer)) as timestamp)
             as d1 from b),
g as (select unnest(generate_series(d0, d1 + interval 6 day, interval 1 day)) as cell_start
      from w)
select cast(g.cell_start - to_days(cast(dayofweek(g.cell_start) as integer)) as timestamp)
         as domain_start, g.cell_start, v.value
from g left join v using (cell_start)""")
def q_calendar_week_day_sunday(spark, sf):
    """Weeks that start on Sunday, by day."""
    return cal.calendar_cells(_series(spark, sf, 2), "week", "day", week_start_monday=False)


def _thresholds_cte(data_id: int, sub: str) -> str:
    return f"""
td as (select ts, arg_max(value, seq) as value from s group by series, ts),
tc as (select date_trunc('{sub}', ts) as cell, {S.xsum('value')} as v from td
       where not isnan(value) group by 1),
st as (select count(*) as c, {S.xsum('v')} as s, {S.xsum('v * v')} as ss, min(v) as mn,
              max(v) as mx from tc),
lh as (select greatest(mn, s / c - sqrt((ss - (s / c) * (s / c)) / c) * 1.5) as lo,
              least(mx, s / c + sqrt((ss - (s / c) * (s / c)) / c) * 1.5) as hi from st),
cuts as (select cast(i as integer) as i, lo + (hi - lo) / 8 * i as threshold
         from lh cross join (select unnest(range(0, 9)) as i))"""


@register("calendar_thresholds", _series_sql(2) + "," + _thresholds_cte(2, "hour")
          + " select * from cuts")
def q_calendar_thresholds(spark, sf):
    return cal.thresholds(_series(spark, sf, 2), "hour")


@register("calendar_class", _calendar_cte(2, "day", "hour") + "," + _thresholds_cte(2, "hour")
          + """,
cl as (select list(threshold order by i) as cut from cuts)
select domain_start, cell_start, value,
       case when value is null or isnan(value) then null
            when cut[1] > 0 and value < 0 then 1
            else cast(len(list_filter(cut, lambda c: c < value)) + 1 as integer) end as class,
       case when value is not null then cut[1] > 0 and value < 0 end as overflow,
       case when value is not null then value = 0 end as zero,
       case when value is not null
            then cast(len(list_filter(cut, lambda c: c <= least(value, cut[9]))) as integer) end
           as bin
from cells, cl""")
def q_calendar_class(spark, sf):
    s = _series(spark, sf, 2)
    return cal.classify(cal.calendar_cells(s, "day", "hour"), cal.thresholds(s, "hour"))


@register("calendar_dupes", _series_sql(0) + """
select cast(epoch(ts) as bigint) as timestamp, series as space, arg_max(value, seq) as value,
       count(*) as writes from s group by series, ts""")
def q_calendar_dupes(spark, sf):
    """Several points of a series at one timestamp: the last written one is kept."""
    s = _series(spark, sf, 0)
    return (s.groupBy("series", "ts").agg(F.max_by("value", "seq").alias("value"),
                                          F.count(F.lit(1)).alias("writes"))
             .select(F.unix_seconds("ts").alias("timestamp"), F.col("series").alias("space"),
                     "value", "writes"))


@register("calendar_auto_domain", f"""{S.R},
b as (select data_id, room_id, min(time) as lo, max(time) as hi from r
      where data_id between 0 and 3 group by data_id, room_id),
x as (select *, cast(floor((epoch(hi) - epoch(lo)) / 86400) + 1 as integer) as days from b)
select {S.METRIC_CASE} as metric, room_id as space, lo as start_ts, hi as end_ts, days,
       case when days > 31 then 'month' when days > 3 then 'day' else 'hour' end as domain,
       cast(case when days > 31 then {_N_EXPR['month']}
                 when days > 3 then {_N_EXPR['day']}
                 else {_N_EXPR['hour']} end + 1 as integer) as range_n
from x""")
def q_calendar_auto_domain(spark, sf):
    """Domain and range chosen from each series' time span (per measure and space)."""
    r = fixtures.readings(spark, sf).filter(F.col("data_id").between(0, 3))
    b = r.groupBy("data_id", "room_id").agg(F.min("time").alias("lo"), F.max("time").alias("hi"))
    days, domain = cal.auto_domain(F.col("lo"), F.col("hi"))
    n = (F.when(days > 31, cal.domain_count(F.col("lo"), F.col("hi"), "month"))
          .when(days > 3, cal.domain_count(F.col("lo"), F.col("hi"), "day"))
          .otherwise(cal.domain_count(F.col("lo"), F.col("hi"), "hour")))
    return b.select(rollup.metric_name("data_id").alias("metric"), F.col("room_id").alias("space"),
                    to_ntz("lo").alias("start_ts"), to_ntz("hi").alias("end_ts"),
                    days.alias("days"), domain.alias("domain"), n.alias("range_n"))


@register("calendar_weeknum", f"""{S.R},
d as (select distinct cast(time as date) as day from r)
select day, cast(strftime(day, '%W') as integer) as week_monday,
       cast(strftime(day, '%U') as integer) as week_sunday,
       cast(isodow(day) - 1 as integer) as weekday,
       cast((day(day) - 1 + isodow(date_trunc('month', day)) - 1) // 7 + 1 as integer)
           as week_of_month,
       cast(day(last_day(day)) as integer) as days_in_month,
       case when (year(day) % 4 = 0 and year(day) % 100 <> 0) or year(day) % 400 = 0
            then 366 else 365 end as days_in_year,
       last_day(day) as month_end,
       (year(day) % 4 = 0 and year(day) % 100 <> 0) or year(day) % 400 = 0 as is_leap
from d""")
def q_calendar_weeknum(spark, sf):
    """Calendar numbering of every day with readings (%W / %U weeks, weekday,
    week row in the month, month and year lengths)."""
    d = fixtures.readings(spark, sf).select(F.to_date("time").alias("day")).distinct()
    c = F.col("day")
    return d.select("day", week_of_year_monday(c).alias("week_monday"),
                    week_of_year_sunday(c).alias("week_sunday"),
                    F.weekday(c).alias("weekday"), week_of_month(c).alias("week_of_month"),
                    days_in_month(c).alias("days_in_month"),
                    days_in_year(c).alias("days_in_year"),
                    F.last_day(c).alias("month_end"), is_leap_year(c).alias("is_leap"))


# -- metric queries over the store ----------------------------------------------------------

_RAW_SQL = (f"select {S.METRIC_CASE} as metric, cast(epoch(time) as bigint) as timestamp, "
            f"data as value, 'Brussels' as city, mun as municipality, room_id as space, "
            f"'RAW' as aggregate from r where data_id between 0 and 3")


def _store(spark, sf, filters=None, metric=None):
    """Raw and roll-up point tables, only those the ``_aggregate`` filter can
    match, and only the metric's own rows (the written tables are partitioned
    by metric; Catalyst cannot push the metric predicate below the roll-up's
    grouping-sets Expand, so it is applied to the readings up front)."""
    from ..schema import MEASURES, OPS, RAW_TAG
    want = tsquery.aggregate_values(filters)
    r = fixtures.readings(spark, sf)
    if metric in MEASURES:
        r = r.filter(F.col("data_id") == MEASURES.index(metric))
    parts = []
    if want is None or RAW_TAG in want:
        parts.append(points.raw_points(r))
    ops = [o for o in OPS if want is None or o in want]
    if ops:
        parts.append(rollup.datapoints(rollup.rollup(r, ops=ops)))
    return points.serving_union(*parts)


@register("tsquery_downsample", f"""{S.R}, st as ({_RAW_SQL}),
ps as (select timestamp - timestamp % 60 as b, city, municipality, space, aggregate,
              {S.xavg('value')} as v from st where metric = 'temperature' and aggregate = 'RAW'
       group by all)
select 'temperature' as metric, make_timestamp(b * 1000000) as bucket, city,
       cast(max(v) as double) as value from ps group by b, city""")
def q_tsquery_downsample(spark, sf):
    """temperature, _aggregate=RAW, downsample 1m avg, max across series by city."""
    f = {"_aggregate": "literal_or(RAW)"}
    return tsquery.tsquery(_store(spark, sf, f, "temperature"), "temperature", f,
                           group_by=["city"],
                           downsample="1 minute", ds_agg="avg", aggregator="max")


@register("tsquery_filter", f"""
with rp as ({S.rollup("date_trunc('minute', time)", ["MAX"])}),
ps as (select timestamp - timestamp % 60 as b, city, municipality, space, aggregate,
              {S.xavg('value')} as v from rp
       where metric = 'temperature' and lower(aggregate) in ('max') and lower(city) in ('brussels')
       group by all)
select 'temperature' as metric, make_timestamp(b * 1000000) as bucket, city,
       cast(max(v) as double) as value from ps group by b, city""")
def q_tsquery_filter(spark, sf):
    """The documented dashboard query: city = iliteral_or(Brussels) groupBy,
    _aggregate = iliteral_or(MAX), downsample 1m avg, aggregator max."""
    f = {"city": "iliteral_or(brussels)", "_aggregate": "iliteral_or(max)"}
    return tsquery.tsquery(_store(spark, sf, f, "temperature"), "temperature", f,
                           group_by=["city"],
                           downsample="1 minute", ds_agg="avg", aggregator="max")


@register("tsquery_group", f"""{S.R}, st as ({_RAW_SQL}),
ps as (select timestamp - timestamp % 600 as b, city, municipality, space, aggregate,
              {S.xsum('value')} as v from st
       where metric = 'humidity' and aggregate = 'RAW'
             and lower(city) in ('brussels', 'bruxelles')
       group by all)
select 'humidity' as metric, make_timestamp(b * 1000000) as bucket, municipality,
       {S.xsum('v')} as value from ps group by b, municipality""")
def q_tsquery_group(spark, sf):
    """humidity grouped by municipality (groupBy tag), city = iliteral_or(Brussels|Bruxelles),
    10-minute sums per series, summed across the spaces of each municipality."""
    f = {"_aggregate": "RAW", "city": "iliteral_or(Brussels|Bruxelles)"}
    return tsquery.tsquery(_store(spark, sf, f, "humidity"), "humidity", f,
                           group_by=["municipality"], downsample="10 minutes", ds_agg="sum",
                           aggregator="sum")


# -- Query 3: frequent temperatures ------------------------------------------------------------

def _freq_base(slide: int = 600, k: int = 6) -> str:
    return f"""{S.R},
t as (select cast(epoch(time) as bigint) as es, data, round_even(data, 0) as temperature
      from r where data_id = 0),
p as (select es - es % {slide} as pane, temperature, count(*) as n from t group by all),
w as (select pane - j * {slide} as ws, temperature, n
      from p cross join (select unnest(range(0, {k})) as j)),
c as (select ws, temperature, sum(n) as n from w group by ws, temperature)"""


def _freq_top_sql(k: int) -> str:
    return _freq_base() + f"""
select make_timestamp(ws * 1000000) as window_start,
       make_timestamp((ws + 3600) * 1000000) as window_end, temperature,
       cast(n as bigint) as n, cast(rank as integer) as rank
from (select *, row_number() over (partition by ws order by n desc, temperature) as rank
      from c) where rank <= {k}"""


@register("frequent_top1", _freq_top_sql(1))
def q_frequent_top1(spark, sf):
    """Most frequent rounded temperature per 1-hour window sliding by 10 minutes."""
    return fq.frequent_top(fixtures.readings(spark, sf), k=1)


@register("frequent_topk", _freq_top_sql(3))
def q_frequent_topk(spark, sf):
    return fq.frequent_top(fixtures.readings(spark, sf), k=3)


@register("frequent_theta", _freq_base() + """
select make_timestamp(ws * 1000000) as window_start,
       make_timestamp((ws + 3600) * 1000000) as window_end, temperature, cast(n as bigint) as n
from c where n >= 2""")
def q_frequent_theta(spark, sf):
    """Values seen at least theta = 2 times in a window (fixture-scale theta)."""
    return fq.frequent_theta(fixtures.readings(spark, sf), theta=2)


_PER_BATCH_SQL = f"""{S.R},
t as (select cast(epoch(time) as bigint) as es, round_even(data, 0) as temperature
      from r where data_id = 0),
p as (select es - es % 10 as pane, temperature, count(*) as n from t group by all),
w as (select pane - j * 10 as ws, pane, temperature, n
      from p cross join (select unnest(range(0, 6)) as j)),
x as (select *, row_number() over (partition by ws order by n desc, temperature, pane) as rn
      from w)
select make_timestamp(ws * 1000000) as window_start,
       make_timestamp((ws + 60) * 1000000) as window_end, temperature, cast(n as bigint) as n,
       make_timestamp(pane * 1000000) as batch_start
from x where rn = 1"""


@register("frequent_per_batch", _PER_BATCH_SQL)
def q_frequent_per_batch(spark, sf):
    """Coded behaviour: largest single 10 s batch group within 60 s / 10 s windows."""
    return fq.frequent_per_batch(fixtures.readings(spark, sf))


_FREQ_POINTS_SQL = _freq_base() + """,
win as (select ws, temperature, n from
        (select *, row_number() over (partition by ws order by n desc, temperature) as rk
         from c) where rk = 1),
wp as (select ws, temperature, n, ws + j * 600 as pane
       from win cross join (select unnest(range(0, 6)) as j)),
m as (select wp.ws, t.es, t.data, wp.n from t
      join wp on t.es - t.es % 600 = wp.pane and t.temperature = wp.temperature),
fp as (select make_timestamp(ws * 1000000) as window_start, 'temperature.occurence' as metric,
              es as timestamp, data as value, 'Brussels' as city from m
       union all
       select make_timestamp(ws * 1000000), 'occurence.temperature', es,
              cast(n as double), 'Brussels' from m)"""


@register("frequent_points", _FREQ_POINTS_SQL + " select * from fp")
def q_frequent_points(spark, sf):
    return fq.frequent_points(fixtures.readings(spark, sf))


@register("serving_union", f"""
with rp as ({S.rollup("date_trunc('minute', time)")}),
fq as ({_FREQ_POINTS_SQL} select * from fp),
rw as ({S.R} {_RAW_SQL})
select metric, timestamp, value, city, municipality, space, aggregate from rw
union all
select metric, timestamp, value, city, municipality, space, aggregate from rp
union all
select metric, timestamp, value, city, null::integer, null::integer, 'RAW' from fq""")
def q_serving_union(spark, sf):
    """Batch layer (raw + roll-up points) and speed layer (frequent points) in one view."""
    r = fixtures.readings(spark, sf)
    fpts = fq.frequent_points(r).select(
        "metric", "timestamp", "value", "city",
        F.lit(None).cast("int").alias("municipality"), F.lit(None).cast("int").alias("space"),
        F.lit("RAW").alias("aggregate"))
    return points.serving_union(points.raw_points(r), rollup.datapoints(rollup.rollup(r)), fpts)

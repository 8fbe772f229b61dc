"""One stream with every output, the published store, and queries over it.

The stream's input is the events table as wire lines in three deliveries (text
files); every tenth event comes with the last one, so it is late.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timefns import to_ntz
from ..operators import rollup
from ..operators.points import POINT_COLUMNS
from ..session import ensure_utc, scratch_path
from ..sources import fixtures
from ..store import Store, publish, retire, store_last, store_query, vacuum
from ..streaming import jobs, outputs
from . import sql as S
from .catalog import register
from .q_batch import _LAST
from .q_dash import _FREQ_POINTS_SQL, _RAW_SQL

_DELIVERIES = 3
#: Delivery of an event, for SQL and Spark alike.
_DELIVERY = ("case when event_id % 10 = 0 then 2 "
             "when event_id < (select max(event_id) from events) / 2 then 0 else 1 end")


def _deliver(spark, sf, base: str, published: bool, **options) -> Store:
    """Run the stream once per delivery, with a publication between deliveries
    and after the last if asked."""
    ensure_utc(spark)
    ev = fixtures.events(spark, sf)
    half = ev.select(F.max("event_id") / 2).scalar()
    number = (F.when(F.col("event_id") % 10 == 0, 2).when(F.col("event_id") < half, 0).otherwise(1))
    store = Store(spark, f"{base}/store")
    for i in range(_DELIVERIES):
        outputs.event_lines(ev.filter(number == i)).write.mode("append").text(f"{base}/in")
        outputs.start_outputs(jobs.line_stream(spark, f"{base}/in"), store.base, f"{base}/ckpt",
                              **options).awaitTermination()
        if published:
            publish(store)
    return store


def _merged(spark, sf) -> Store:
    """A store of three publications."""
    return _deliver(spark, sf, scratch_path(spark, "store"), published=True)


def _store(spark, sf) -> Store:
    """A store of one delivery and one publication, for queries over it."""
    ensure_utc(spark)
    base = scratch_path(spark, "store")
    store = Store(spark, f"{base}/store")
    lines = outputs.event_lines(jobs.event_stream(spark, sf))
    outputs.start_outputs(lines, store.base, f"{base}/ckpt").awaitTermination()
    publish(store)
    return store


# -- the stream -----------------------------------------------------------------------

@register("stream_all_outputs", f"""
with rp as ({S.rollup("date_trunc('minute', time)")}),
fq as ({_FREQ_POINTS_SQL} select * from fp),
rw as ({S.R} {_RAW_SQL})
select metric, timestamp, value, city, municipality, space, aggregate from rw
union all
select metric, timestamp, value, city, municipality, space, aggregate from rp
union all
select metric, timestamp, value, city, null::integer, null::integer, 'RAW' from fq""")
def q_stream_all_outputs(spark, sf):
    """Raw, roll-up and frequent points of one stream over several deliveries."""
    store = _deliver(spark, sf, scratch_path(spark, "outputs"), published=False)
    return outputs.live_points(store)


@register("stream_landing_lines", f"""{S.R},
good as (select cast(time as date) as dt, null as reject, time, mun, room_id, data_id, data,
                voltage from r),
bad as (select case when event_id % 6 < 3 then cast(ts as date) end as dt,
               case event_id % 6 when 0 then 'fields' when 1 then 'id' when 2 then 'value'
                                 when 5 then 'empty' else 'time' end as reject
        from events where event_type = 'error')
select coalesce(cast(dt as varchar), 'unparsed') as dt, reject, time, mun, room_id, data_id, data,
       voltage from good
union all
select coalesce(cast(dt as varchar), 'unparsed'), reject, null, null, null, null, null, null
from bad""")
def q_stream_landing_lines(spark, sf):
    """All landed lines, malformed ones too, parsed again."""
    from ..functions.parse import annotate
    store = _deliver(spark, sf, scratch_path(spark, "landing"), published=False)
    ok = F.col("reject").isNull()
    a = annotate(outputs.landed_lines(store))
    return a.select("dt", "reject", *[F.when(ok, c).alias(n) for n, c in (
        ("time", to_ntz("time")),
        *[(n, F.col(n)) for n in ("mun", "room_id", "data_id", "data", "voltage")])])


@register("stream_frequent_points", _FREQ_POINTS_SQL + " select * from fp")
def q_stream_frequent_points(spark, sf):
    """Frequent points kept up by the stream: each batch computes the windows it
    touches again, late rows included."""
    store = _deliver(spark, sf, scratch_path(spark, "frequent"), published=False)
    return outputs.live_frequent(store).select("window_start", "metric", "timestamp", "value",
                                               "city")


_DELAY = 3600
_LATE_SQL = f"""{S.R},
d as (select r.*, {_DELIVERY.replace('event_id', 'r.event_id', 1).replace('when event_id <', 'when r.event_id <')} as batch
      from r where data_id between 0 and 3),
mx as (select batch, max(cast(epoch(time) as bigint)) as last from d group by batch),
wm as (select b.batch, max(mx.last) - {_DELAY} as mark
       from (select unnest(range(0, {_DELIVERIES})) as batch) b
       join mx on mx.batch < b.batch group by b.batch),
x as (select d.*, cast(epoch(date_trunc('minute', time)) as bigint) + 60 <= wm.mark as late
      from d left join wm using (batch))"""


@register("stream_late_rows", _LATE_SQL + """
select time, mun, room_id, data_id, data, voltage, cast(batch as bigint) as batch_id
from x where late""")
def q_stream_late_rows(spark, sf):
    """Readings that came after their minute was closed, with their batch."""
    store = _deliver(spark, sf, scratch_path(spark, "late"), published=False, delay=_DELAY)
    return store.lasting("late").select(to_ntz("time").alias("time"), "mun", "room_id", "data_id",
                                        "data", "voltage", "batch_id")


@register("stream_closed_windows", _LATE_SQL + f""",
fin as (select max(last) - {_DELAY} as mark from mx),
o as (select date_trunc('minute', time) as bucket, data_id, mun, room_id, data from x
      where not coalesce(late, false))
select bucket, {S.METRIC_CASE} as metric, mun as municipality, room_id as space,
       count(*) as n, max(data) as max_value, min(data) as min_value, {S.xsum('data')} as sum_value,
       cast(epoch(bucket) as bigint) + 60 <= (select mark from fin) as closed
from o group by bucket, data_id, mun, room_id""")
def q_stream_closed_windows(spark, sf):
    """Minutes as the watermark closed them, once each, and those still open;
    with the late rows they make up all readings."""
    store = _deliver(spark, sf, scratch_path(spark, "closed"), published=False, delay=_DELAY)
    closed = store.lasting("closed").drop("run", "batch_id").withColumn("closed", F.lit(True))
    still = outputs.open_partials(store).withColumn("closed", F.lit(False))
    rows = closed.select(*still.columns).unionByName(still)
    total = F.col("s1") + (F.col("s2") + F.col("s3"))
    return rows.select(to_ntz("bucket").alias("bucket"),
                       rollup.metric_name("data_id").alias("metric"),
                       F.col("mun").alias("municipality"), F.col("room_id").alias("space"),
                       F.col("c").alias("n"), F.col("mx.v").alias("max_value"),
                       F.col("mn.v").alias("min_value"), total.alias("sum_value"), "closed")


# -- the store -------------------------------------------------------------------------

_ROLLUP_COLS = ("bucket, metric, level, aggregate, timestamp, value, city, municipality, space")


@register("store_rollup", f"""
with rp as ({S.rollup("date_trunc('minute', time)")}) select {_ROLLUP_COLS} from rp""")
def q_store_rollup(spark, sf):
    """The published roll-up table after three publications."""
    return _merged(spark, sf).read("rollup").drop("day").select(*_ROLLUP_COLS.split(", "))


def _level_builder(table: str):
    def build(spark, sf):
        part = _merged(spark, sf).read(table)
        return rollup.rollup_partials(part).select(*_ROLLUP_COLS.split(", "))
    return build


for _t, _u in (("1h", "hour"), ("1d", "day")):
    register(f"store_rollup_{_u}", f"""
with rp as ({S.rollup(f"date_trunc('{_u}', time)")}) select {_ROLLUP_COLS} from rp""")(
        _level_builder(f"partials_{_t}"))


@register("store_serving", f"""
with rp as ({S.rollup("date_trunc('minute', time)")}),
rw as ({S.R} {_RAW_SQL})
select {', '.join(POINT_COLUMNS)} from rw union all select {', '.join(POINT_COLUMNS)} from rp""")
def q_store_serving(spark, sf):
    """Raw and roll-up points of the newest manifest, old files removed."""
    store = _merged(spark, sf)
    vacuum(store, keep=1)
    return store.points()


@register("store_retention", f"""{S.R}, f as ({_RAW_SQL}),
cut as (select max(timestamp) - 10 * 86400 as t from f)
select {', '.join(POINT_COLUMNS)} from f where timestamp >= (select t from cut)""")
def q_store_retention(spark, sf):
    """Raw points after a retention of ten days: older partitions are gone."""
    store = _store(spark, sf)
    retire(store, days=10)
    vacuum(store, keep=1)
    return store.points(["raw"])


def _last_builder(n: int, unit: str, **options):
    def build(spark, sf):
        return store_last(_store(spark, sf), n, unit, **options)
    return build


for _k in ("hours", "days"):
    _n, _u = _LAST[_k]
    register(f"store_last_{_k}",
             f"{S.R}, f as ({S.last_period(_n, _u)} and data_id between 0 and 3)"
             f"{S.space_stats('f')}")(_last_builder(_n, _u))


# -- metric queries over the store --------------------------------------------------------

_AGG_SQL = {"sum": S.xsum, "avg": S.xavg, "max": lambda x: f"max({x})",
            "min": lambda x: f"min({x})", "count": lambda x: f"count({x})",
            "dev": lambda x: f"stddev_pop({x})",
            "first": lambda x: f"arg_min({x}, timestamp)",
            "last": lambda x: f"arg_max({x}, timestamp)"}
_DAY0 = "cast(epoch(timestamp '2024-01-08') as bigint)"
_RANGE = (1704672000, 1705276799)        # 2024-01-08 to 2024-01-14, whole days


def _tsquery_sql(metric: str, width: int, ds: str, agg: str, group: str = "", where: str = "true",
                 store: str = "") -> str:
    """Downsample per series, then aggregate across series by ``group``."""
    gcol = f", {group}" if group else ""
    tags = "concat_ws('|', city, coalesce(cast(municipality as varchar), ''), " \
           "coalesce(cast(space as varchar), ''), aggregate)"
    across = {"first": f"arg_min(v, {tags})", "last": f"arg_max(v, {tags})"}.get(
        agg, _AGG_SQL[agg]("v"))
    head = store or f"{S.R}, st as ({_RAW_SQL})"
    return f"""{head},
ps as (select timestamp - timestamp % {width} as b, city, municipality, space, aggregate,
              {_AGG_SQL[ds]('value')} as v from st where metric = '{metric}' and {where}
       group by all)
select '{metric}' as metric, make_timestamp(b * 1000000) as bucket{gcol},
       cast({across} as double) as value from ps group by b{gcol}"""


_WEEK = f"timestamp between {_RANGE[0]} and {_RANGE[1]}"
# name: (metric, width, SQL seconds, downsampling, across, group tags, SQL filter, arguments)
_TSQUERIES = {
    # hours answer it
    "store_tsquery": ("temperature", "1 hour", 3600, "max", "min", "municipality", _WEEK,
                      {"start": _RANGE[0], "end": _RANGE[1]}),
    # days, hours and minutes
    "store_tsquery_day": ("light", "1 day", 86400, "sum", "avg", "city", "true", {}),
    "store_tsquery_hours": ("humidity", "6 hours", 21600, "avg", "max", "municipality", "true", {}),
    "store_tsquery_minutes": ("motion", "10 minutes", 600, "count", "sum", "space", _WEEK,
                              {"start": _RANGE[0], "end": _RANGE[1]}),
    # only raw points can
    "store_tsquery_dev": ("temperature", "1 day", 86400, "dev", "count", "municipality", "true", {}),
}


def _tsquery_builder(metric, width, ds, agg, group, args):
    def build(spark, sf):
        return store_query(_store(spark, sf), metric, group_by=[group] if group else [],
                           downsample=width, ds_agg=ds, aggregator=agg, **args)
    return build


for _name, (_m, _w, _s, _ds, _ag, _g, _where, _args) in _TSQUERIES.items():
    register(_name, _tsquery_sql(_m, _s, _ds, _ag, _g, _where))(
        _tsquery_builder(_m, _w, _ds, _ag, _g, _args))


@register("store_tsquery_rollup", f"""
with rp as ({S.rollup("date_trunc('minute', time)", ["MAX"])}), st as (select * from rp),
ps as (select timestamp - timestamp % 60 as b, city, municipality, space, aggregate,
              {S.xavg('value')} as v from st
       where metric = 'temperature' and lower(city) in ('brussels') group by all)
select 'temperature' as metric, make_timestamp(b * 1000000) as bucket, city,
       cast(max(v) as double) as value from ps group by b, city""")
def q_store_tsquery_rollup(spark, sf):
    """The documented dashboard query over the written roll-up table."""
    return store_query(_store(spark, sf), "temperature",
                       {"city": "iliteral_or(brussels)", "_aggregate": "iliteral_or(max)"},
                       group_by=["city"], downsample="1 minute", ds_agg="avg", aggregator="max")

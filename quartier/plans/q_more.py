"""Registered queries of readers, ranges and options that only tests covered:
dimension files, brushed ranges, missing values as zero, threshold lists, record
defaults, four-decimal rounding, JSON series, Kafka-shaped records."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.parse import parse_lines
from ..functions.timefns import to_ntz
from ..operators import calendar as cal
from ..operators import enrich, ranges, tsquery
from ..session import ensure_utc, scratch_path
from ..sources import dims, fixtures, series
from ..streaming import jobs
from . import sql as S
from .catalog import register
from .q_batch import _readings_out, _values
from .q_dash import _calendar_cte, _series, _store
from .q_store import _tsquery_sql

_READ = "event_id, time, mun, room_id, data_id, data, voltage"


@register("dims_from_files", f"""{S.R},
d as (select * from {_values(dims.space_rows(), ['room_id', 'x', 'y'])}),
rm as (select * from {_values(dims.room_municipality_rows(), ['room_id', 'name'])}),
m as (select * from {_values(dims.municipality_name_rows(), ['mun', 'name'])})
select r.event_id, r.room_id, r.mun, cast(d.x as double) as x, cast(d.y as double) as y,
       rm.name as room_municipality_name, m.name as municipality_name
from r left join d using (room_id) left join rm on r.room_id = rm.room_id
left join m on r.mun = m.mun""")
def q_dims_from_files(spark, sf):
    """Readings enriched from the three dimension files in their own formats."""
    base = scratch_path(spark, "dims")

    def text(rows, name):
        spark.createDataFrame([(x,) for x in rows], "value string").write.text(f"{base}/{name}")
        return f"{base}/{name}"
    space = dims.read_space_file(spark, text([f"{i} {x}  {y}" for i, x, y in dims.space_rows()], "s"))
    rooms = dims.read_room_municipality_file(
        spark, text([f"{i},{n} " for i, n in dims.room_municipality_rows()], "r"))
    names = dims.read_municipality_lookup(
        spark, text(["{", *[f"{i}: {n}," for i, n in dims.municipality_name_rows()], "}"], "m"))
    r = fixtures.readings(spark, sf)
    # files of unknown size: the planner chooses the join
    r = enrich.join_dimension(r, space, "room_id", None)
    r = enrich.join_dimension(r, rooms.withColumnRenamed("municipality_name",
                                                         "room_municipality_name"), "room_id", None)
    r = enrich.join_dimension(r, names.withColumnRenamed("name", "municipality_name"), "mun", None)
    return r.select("event_id", "room_id", "mun", "x", "y", "room_municipality_name",
                    "municipality_name")


@register("range_day_aligned", f"""{S.R}
select {_READ} from r where time >= timestamp '2024-01-05' and time < timestamp '2024-01-09'""")
def q_range_day_aligned(spark, sf):
    """A brushed selection, given backwards, widened to whole days."""
    lo, hi = ranges.day_aligned_range(datetime(2024, 1, 8, 3, 30), datetime(2024, 1, 5, 18, 45))
    return _readings_out(ranges.in_range(fixtures.readings(spark, sf), lo, hi))


_CELL = datetime(2024, 1, 8, 10)
_CELLS = {"week": "7 day", "day": "1 day", "hour": "1 hour", "min": "1 minute"}


@register("range_drill_down", f"{S.R} " + " union all ".join(
    f"select '{c}' as cell, {_READ} from r where time >= timestamp '{_CELL}' "
    f"and time < timestamp '{_CELL}' + interval {w}" for c, w in _CELLS.items()))
def q_range_drill_down(spark, sf):
    """The readings behind a cell of every kind."""
    r, out = fixtures.readings(spark, sf), None
    for c in _CELLS:
        df = _readings_out(ranges.drill_down(r, _CELL, c)).withColumn("cell", F.lit(c))
        out = df if out is None else out.unionByName(df)
    return out


@register("calendar_missing_zero", _calendar_cte(2, "day", "hour") + """
select domain_start, cell_start, coalesce(value, 0e0) as value from cells""")
def q_calendar_missing_zero(spark, sf):
    return cal.calendar_cells(_series(spark, sf, 2), "day", "hour", missing_as_zero=True)


_LIST = "20, 45.5 ,60,x, 90"


@register("calendar_threshold_list", _calendar_cte(2, "day", "hour") + """,
c as (select [20e0, 45.5e0, 60e0, 90e0] as cut)
select domain_start, cell_start, value,
       case when value is not null then cast(len(list_filter(cut, lambda t: t < value)) + 1 as integer)
           end as class
from cells, c""")
def q_calendar_threshold_list(spark, sf):
    """Classes by a typed list of thresholds; what is no number in it is skipped."""
    cells = cal.calendar_cells(_series(spark, sf, 2), "day", "hour")
    cuts = spark.range(1).select(F.posexplode(F.filter(
        series.parse_threshold_list(F.lit(_LIST)), lambda x: x.isNotNull())).alias("i", "threshold"))
    return cal.classify(cells, cuts).select("domain_start", "cell_start", "value", "class")


@register("record_defaults", """
select cast(epoch(date_trunc('second', ts)) as integer) as timestamp,
       cast(case when event_type = 'error' then -1 else user_id % 54 end as integer) as room_id,
       cast(case event_type when 'view' then 0 when 'click' then 1 when 'purchase' then 2 else -1 end
            as integer) as data_id,
       cast(case when event_type = 'signup' then -999 else value end as float) as data,
       cast(-999 as float) as voltage
from events""")
def q_record_defaults(spark, sf):
    """Events as the declared record; what they lack takes the record's defaults."""
    ensure_utc(spark)
    e, t = fixtures.events(spark, sf), F.col("event_type")
    return series.with_avro_defaults(e.select(
        F.unix_seconds(F.date_trunc("second", "ts")).alias("timestamp"),
        F.when(t != "error", F.col("user_id") % 54).alias("room_id"),
        F.when(t == "view", 0).when(t == "click", 1).when(t == "purchase", 2).alias("data_id"),
        F.when(t != "signup", F.col("value")).alias("data")))


@register("round_four_decimals", f"""{S.R}
select event_id, round_even(data / 7, 4) as data4 from r""")
def q_round_four_decimals(spark, sf):
    return fixtures.readings(spark, sf).select("event_id", F.bround(F.col("data") / 7, 4).alias("data4"))


@register("series_json_calendar", _calendar_cte(2, "day", "hour").replace(
    "group by series, ts", "group by ts") + " select * from cells")
def q_series_json_calendar(spark, sf):
    """The light series as JSON objects, one per line, read back: of a time's
    values the last written one is in the file."""
    path = scratch_path(spark, "series-json")
    s = cal.dedupe(_series(spark, sf, 2).drop("series"))
    s.select(F.to_json(F.create_map(F.unix_seconds("ts").cast("string"), F.col("value")))
             .alias("value")).write.text(path)
    return cal.calendar_cells(series.read_series(spark, path, "json"), "day", "hour")


@register("stream_kafka_records", f"""{S.R}
select 'readings' as topic, cast(event_id % 3 as integer) as partition, event_id as "offset",
       cast(event_id as varchar) as key, time, mun, room_id, data_id, data, voltage from r""")
def q_stream_kafka_records(spark, sf):
    """Records as the Kafka source gives them, through a stream: inspected
    (topic, partition, offset, key) and their values parsed."""
    ensure_utc(spark)
    base = scratch_path(spark, "kafka")
    lines = fixtures.lines_from_events(fixtures.events(spark, sf))
    lines.select(F.lit("readings").alias("topic"), (F.col("event_id") % 3).cast("int").alias("partition"),
                 F.col("event_id").alias("offset"),
                 F.col("event_id").cast("string").cast("binary").alias("key"),
                 F.col("value").cast("binary").alias("value")).write.parquet(f"{base}/topic")
    schema = "topic string, partition int, offset bigint, key binary, value binary"
    records = jobs.kafka_inspect(spark.readStream.schema(schema).parquet(f"{base}/topic"))
    q = (parse_lines(records).writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select(
        "topic", "partition", "offset", "key", to_ntz("time").alias("time"), "mun", "room_id",
        "data_id", "data", "voltage")


def _aggregator_builder(ds: str, agg: str):
    def build(spark, sf):
        f = {"_aggregate": "RAW"}
        return tsquery.tsquery(_store(spark, sf, f, "light"), "light", f, ["municipality"],
                               "6 hours", ds, agg)
    return build


for _ds, _agg in (("max", "last"), ("sum", "first"), ("count", "count"), ("min", "avg")):
    register(f"tsquery_{_ds}_{_agg}",
             _tsquery_sql("light", 21600, _ds, _agg, "municipality"))(_aggregator_builder(_ds, _agg))

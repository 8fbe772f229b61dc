"""Readings derived from the driver's ``events`` table (see FIXTURES.md).

The mapping is a plain projection + filter over the parquet scan, so column
pruning and the ``event_type <> 'error'`` predicate reach the reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import format_line
from ..schema import EVENTS
from ..session import ensure_utc

# DuckDB (and Spark SQL) form of the same mapping; every oracle query starts
# from this CTE so both engines see identical readings.
READINGS_SQL = """
select date_trunc('second', ts)                 as time,
       cast((user_id % 54) % 19 as int)         as mun,
       cast(user_id % 54 as int)                as room_id,
       case event_type when 'view' then 0 when 'click' then 1
                       when 'purchase' then 2 else 3 end as data_id,
       case event_type when 'view'     then 15e0 + value % 10e0
                       when 'click'    then value % 100e0
                       when 'purchase' then 30e0 + value % 20e0
                       else case when value >= 35 then 1e0 else 0e0 end end as data,
       cast(event_id % 50 as double) / 10e0     as voltage,
       event_id
from events
where event_type <> 'error'
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with its known schema: no footer sampling for schema
    inference on the driver, however many files the table has."""
    return spark.read.schema(EVENTS).parquet(f"{str(sf_dir).rstrip('/')}/events.parquet")


def _reading() -> dict[str, Column]:
    """The columns of an event's reading."""
    room = F.col("user_id") % 54
    et, v = F.col("event_type"), F.col("value")
    data_id = (F.when(et == "view", 0).when(et == "click", 1)
                .when(et == "purchase", 2).otherwise(3))
    data = (F.when(et == "view", F.lit(15.0) + v % 10.0)
             .when(et == "click", v % 100.0)
             .when(et == "purchase", F.lit(30.0) + v % 20.0)
             .otherwise(F.when(v >= 35, F.lit(1.0)).otherwise(F.lit(0.0))))
    return {"time": F.date_trunc("second", F.col("ts")), "mun": (room % 19).cast("int"),
            "room_id": room.cast("int"), "data_id": data_id.cast("int"),
            "data": data.cast("double"),
            "voltage": (F.col("event_id") % 50).cast("double") / 10.0}


def readings_from_events(ev: DataFrame) -> DataFrame:
    """events -> readings (time, mun, room_id, data_id, data, voltage, event_id).

    Works on batch and streaming frames alike.
    """
    return (ev.filter(F.col("event_type") != "error")
              .select(*[c.alias(n) for n, c in _reading().items()], F.col("event_id")))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return readings_from_events(events(spark, sf_dir))


# Defect injected into an ``error`` event's line, chosen by event_id % 6,
# and the reject reason the parser must report for it.
DEFECT_REASONS = ["fields", "id", "value", "time", "time", "empty"]


def lines_from_events(ev: DataFrame) -> DataFrame:
    """Render every event as a wire line (event_id, dt, value), in one pass.

    Regular events become well-formed lines of their reading; ``error`` events
    become malformed lines with exactly one defect each.
    """
    r = ev.select("event_id", "event_type", "ts", F.col("value").alias("_value"),
                  *[c.alias(n) for n, c in _reading().items()])
    t = F.col("time")
    date_s = F.date_format(t, "yyyy-MM-dd")
    time_s = F.date_format(t, "HH:mm:ss")
    room, mun = F.col("room_id").cast("string"), F.col("mun").cast("string")
    id3 = F.concat_ws("-", mun, room, F.lit("3"))
    val, volt = F.col("_value").cast("string"), F.col("voltage").cast("string")
    k = F.col("event_id") % 6
    bad: Column = (
        F.when(k == 0, F.concat_ws(" ", date_s, time_s, id3, val))
         .when(k == 1, F.concat_ws(" ", date_s, time_s, F.concat_ws("-", room, F.lit("3")),
                                   val, volt))
         .when(k == 2, F.concat_ws(" ", date_s, time_s, id3, F.lit("n/a"), volt))
         .when(k == 3, F.concat_ws(" ", date_s, F.concat(time_s, F.lit(".1234")), id3, val, volt))
         .when(k == 4, F.concat_ws(" ", F.date_format(t, "yyyy/MM/dd"), time_s, id3, val, volt))
         .otherwise(F.lit("")))
    good = format_line(t, F.col("mun"), F.col("room_id"), F.col("data_id"), F.col("data"),
                       F.col("voltage"))
    # a null event type is no reading and no malformed one
    return r.filter(F.col("event_type").isNotNull()).select(
        "event_id", F.to_date(t).alias("dt"),
        F.when(F.col("event_type") == "error", bad).otherwise(good).alias("value"))


def reading_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return lines_from_events(events(spark, sf_dir))

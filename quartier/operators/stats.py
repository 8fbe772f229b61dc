"""Query 1 (statistics over the last x hours/days/months/years) and
Query 2 (15-minute daytime / nighttime slots and their roll-ups)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_avg, exact_sum, max_number, min_number
from ..functions.timefns import bucket_start, interval, slot_index, to_ntz
from ..schema import DAY_NIGHT_THRESHOLD, LEVELS
from .rollup import _LEVEL_KEYS, _LEVEL_OF_GID, metric_name

def as_of_time(readings: DataFrame, as_of: datetime | str | None = None) -> Column:
    """The 'now' of a last-x query: a literal, or max(time) as a scalar subquery.

    The subquery runs once and its result is used as a runtime filter, so the
    filter still prunes at the scan; no join or single-partition window.
    """
    if as_of is not None:
        return F.lit(as_of).cast("timestamp")
    return readings.select(F.max("time")).scalar()


def last_period(readings: DataFrame, n: int, unit: str,
                as_of: datetime | str | None = None) -> DataFrame:
    """Readings in (as_of - n unit, as_of]."""
    now = as_of_time(readings, as_of)
    return readings.filter((F.col("time") > now - interval(n, unit)) & (F.col("time") <= now))


def _level_col() -> Column:
    return F.try_element_at(F.create_map(*[x for gid, lv in _LEVEL_OF_GID.items()
                                       for x in (F.lit(gid), F.lit(lv))]), F.grouping_id())


def space_stats(readings: DataFrame, levels: Sequence[str] = LEVELS,
                extra_keys: Sequence[str] = ()) -> DataFrame:
    """MAX / MIN / AVG / COUNT per measure at each space level (grouping sets)."""
    r = readings.filter(F.col("data_id").between(0, 3))
    keys = [*extra_keys, "data_id"]
    sets = [[*keys, *_LEVEL_KEYS[lv]] for lv in levels]
    g = r.groupingSets(sets, *keys, "mun", "room_id").agg(
        _level_col().alias("level"),
        max_number("data").alias("max_value"), min_number("data").alias("min_value"),
        exact_avg("data").alias("avg_value"), F.count(F.lit(1)).alias("n"))
    return g.select(*extra_keys, metric_name("data_id").alias("metric"), "level",
                    F.col("mun").alias("municipality"), F.col("room_id").alias("space"),
                    "max_value", "min_value", "avg_value", "n")


def stats_last(readings: DataFrame, n: int, unit: str, as_of=None,
               levels: Sequence[str] = LEVELS) -> DataFrame:
    """Query 1: e.g. max temperature per space level over the last 5 hours."""
    return space_stats(last_period(readings, n, unit, as_of), levels)


def day_night(avg: Column, threshold: float = DAY_NIGHT_THRESHOLD) -> Column:
    """Class of a slot average; none for NaN (Spark orders NaN above numbers)."""
    return (F.when(F.isnan(avg), F.lit(None))
             .when(avg >= threshold, F.lit("daytime")).when(avg < threshold, F.lit("nighttime")))


def slot_classes(readings: DataFrame, slot: str = "15 minutes",
                 levels: Sequence[str] = LEVELS,
                 threshold: float = DAY_NIGHT_THRESHOLD) -> DataFrame:
    """Query 2: average temperature per slot of the day -> daytime / nighttime.

    Output: level, municipality, space, slot_start, day, slot (index in day),
    sum_temp, n, avg_temp, period.
    """
    t = (readings.filter(F.col("data_id") == 0)
                 .select(bucket_start("time", slot).alias("slot_start"), "mun", "room_id", "data"))
    sets = [["slot_start", *_LEVEL_KEYS[lv]] for lv in levels]
    g = t.groupingSets(sets, "slot_start", "mun", "room_id").agg(
        F.grouping("mun").alias("g_mun"), F.grouping("room_id").alias("g_room"),
        exact_sum("data").alias("sum_temp"), F.count(F.lit(1)).alias("n"))
    level = (F.when((F.col("g_mun") == 1) & (F.col("g_room") == 1), F.lit("city"))
              .when(F.col("g_room") == 1, F.lit("municipality"))
              .otherwise(F.lit("space")))
    avg = F.col("sum_temp") / F.col("n")
    fragment = {"15 minutes": "QUARTER", "1 hour": "HOUR", "1 minute": "MINUTE"}.get(slot)
    return g.select(
        level.alias("level"), F.col("mun").alias("municipality"), F.col("room_id").alias("space"),
        to_ntz("slot_start").alias("slot_start"),
        F.to_date("slot_start").alias("day"),
        (slot_index("slot_start", fragment) if fragment else F.lit(None).cast("int")).alias("slot"),
        "sum_temp", "n", avg.alias("avg_temp"), day_night(avg, threshold).alias("period"))


def slot_rollup(readings: DataFrame, last_n: int, last_unit: str, bucket: str,
                as_of=None, levels: Sequence[str] = LEVELS,
                threshold: float = DAY_NIGHT_THRESHOLD, slot: str = "15 minutes") -> DataFrame:
    """Query 2 roll-up: over the last n days/weeks/months/years, per coarser
    bucket (hour, day, week, month): number of daytime and nighttime slots of
    length ``slot``, the bucket's own average temperature and its class."""
    slots = slot_classes(last_period(readings, last_n, last_unit, as_of), slot, levels, threshold)
    b = bucket_start(F.col("slot_start").cast("timestamp"), bucket)
    g = (slots.groupBy("level", "municipality", "space", b.alias("bucket"))
              .agg(F.sum(F.when(F.col("period") == "daytime", 1).otherwise(0)).alias("daytime_slots"),
                   F.sum(F.when(F.col("period") == "nighttime", 1).otherwise(0)).alias("nighttime_slots"),
                   exact_sum("sum_temp").alias("sum_temp"), F.sum("n").alias("n")))
    avg = F.col("sum_temp") / F.col("n")
    return g.select("level", "municipality", "space", to_ntz("bucket").alias("bucket"),
                    "daytime_slots", "nighttime_slots", "n", avg.alias("avg_temp"),
                    day_night(avg, threshold).alias("period"))

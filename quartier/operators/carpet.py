"""Carpet plot re-bucketing: a day x slot grid, gap-filled, one value per cell.

The grid is generated from the time range (days x slots-per-day rows, bounded
by the range, not by the data) and left-joined with the per-slot aggregate;
empty cells stay NULL, also for CNT.  MIN and MAX skip NaN unless all is NaN.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_avg, exact_sum, max_number, min_number
from ..functions.timefns import FRAGMENTS, epoch_seconds, floor_seconds, js_round, to_ntz

AGGREGATES = ["AVG", "SUM", "CNT", "MIN", "MAX", "FIRST", "LAST"]


def order_key(ts: Column, seq: Column) -> Column:
    """Lossless single-value ordering of (ts, seq): ts_micros * 1e20 + (seq + 2^63)
    as DECIMAL(38,0).  A decimal buffer keeps first/last hash-aggregated where a
    struct ordering would force a sort-based aggregate."""
    us = F.unix_micros(ts.cast("timestamp")).cast("decimal(38,0)")
    shifted = seq.cast("decimal(38,0)") + F.lit(str(2 ** 63)).cast("decimal(38,0)")
    return (us * F.lit(str(10 ** 20)).cast("decimal(38,0)") + shifted).cast("decimal(38,0)")


def _agg(kind: str) -> Column:
    v, order = F.col("value"), order_key(F.col("ts"), F.col("seq"))
    return {"AVG": exact_avg(v), "SUM": exact_sum(v), "CNT": F.count(v), "MIN": min_number(v),
            "MAX": max_number(v), "FIRST": F.min_by(v, order), "LAST": F.max_by(v, order)}[kind]


def _days(series: DataFrame, start, end) -> tuple[datetime, int]:
    """First day and number of days of the range; times that are not given are
    the series' first and last, from one pass over its time column."""
    start, end = (datetime.fromisoformat(x) if isinstance(x, str) else x for x in (start, end))
    if start is None or end is None:
        ts = F.col("ts").cast("timestamp_ntz")
        lo, hi = series.agg(F.min(ts), F.max(ts)).first()
        if lo is None:
            return datetime(1970, 1, 1), 0
        start, end = start or lo, end or hi
    first = datetime(start.year, start.month, start.day)
    return first, (end.replace(tzinfo=None) - first).days + 1


def carpet(series: DataFrame, fragment: str = "QUARTER", aggregate: str = "AVG",
           start=None, end=None, ordered: bool = False) -> DataFrame:
    """series(ts, value, seq) -> (day, slot, slot_start, value) for every slot of
    every day in [start of day(start), start of day(end) + 1 day).

    ``start`` / ``end`` default to the series' first and last time. The days are
    a range, dealt over tasks before they become slots.
    """
    count, width = FRAGMENTS[fragment.upper()]
    first, n_days = _days(series, start, end)
    d0 = F.lit(first).cast("timestamp_ntz").cast("timestamp")
    d1 = d0 + F.make_dt_interval(F.lit(max(n_days, 0)))
    day = F.unix_seconds(d0) + F.col("id") * 86400
    grid = (series.sparkSession.range(max(n_days, 0))
            .select(F.timestamp_seconds(day).alias("day"),
                    F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("slot"))
            .select(F.col("day"), F.col("slot"),
                    F.timestamp_seconds(epoch_seconds("day") + F.col("slot") * width)
                    .alias("slot_start")))
    vals = (series.filter(F.col("value").isNotNull())
                  .withColumn("slot_start", floor_seconds(F.col("ts"), width))
                  .filter((F.col("slot_start") >= d0) & (F.col("slot_start") < d1)))
    agg = vals.groupBy("slot_start").agg(_agg(aggregate.upper()).alias("value"))
    out = (grid.join(agg, "slot_start", "left")
               .select(F.to_date("day").alias("day"), F.col("slot").cast("int").alias("slot"),
                       to_ntz("slot_start").alias("slot_start"), "value"))
    # time-ordered output for display (a range sort of the bounded grid)
    return out.orderBy("slot_start") if ordered else out


def carpet_stats(cells: DataFrame) -> DataFrame:
    """min / max over the non-empty cells (the true max, also for data <= 0)."""
    return cells.groupBy(F.lit(1).alias("_k")).agg(
        min_number("value").alias("min_value"), max_number("value").alias("max_value"),
        F.count("value").alias("filled"), F.count(F.lit(1)).alias("cells")).drop("_k")


def carpet_scaled(cells: DataFrame, fixed_min: float | None = None,
                  fixed_max: float | None = None, decimals: int = 2) -> DataFrame:
    """Position of each cell between min and max (optionally fixed), plus the
    display-rounded value (halves round towards +infinity)."""
    lo = F.lit(fixed_min) if fixed_min is not None else cells.select(min_number("value")).scalar()
    hi = F.lit(fixed_max) if fixed_max is not None else cells.select(max_number("value")).scalar()
    return cells.select("day", "slot", "slot_start", "value",
                        ((F.col("value") - lo) / (hi - lo)).alias("position"),
                        js_round("value", decimals).alias("display"))

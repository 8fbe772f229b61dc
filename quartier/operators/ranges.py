"""Space and time-range predicates used by dashboard interactions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CITY

_DURATION = {"week": 7 * 86400, "day": 86400, "hour": 3600, "minute": 60, "min": 60}


def space_filter(df: DataFrame, level: str, key=None) -> DataFrame:
    """One space, one municipality, or the whole city (no filter)."""
    if level == "city":
        return df if key in (None, CITY) else df.limit(0)
    col = {"municipality": "mun", "space": "room_id"}[level]
    if col not in df.columns:
        col = {"mun": "municipality", "room_id": "space"}[col]
    return df.filter(F.col(col) == F.lit(key))


def day_aligned_range(a: datetime | Column, b: datetime | Column) -> tuple[Column, Column]:
    """A brushed selection [a, b] widened to [start of day(a), start of day(b) + 1 day)."""
    ca = F.lit(a) if isinstance(a, datetime) else a
    cb = F.lit(b) if isinstance(b, datetime) else b
    lo = F.date_trunc("day", F.least(ca, cb).cast("timestamp"))
    hi = F.date_trunc("day", F.greatest(ca, cb).cast("timestamp")) + F.expr("INTERVAL 1 DAY")
    return lo, hi


def in_range(df: DataFrame, lo: Column, hi: Column, col: str = "time") -> DataFrame:
    return df.filter((F.col(col) >= lo) & (F.col(col) < hi))


def drill_down(df: DataFrame, cell_start: datetime, sub_domain: str, col: str = "time") -> DataFrame:
    """The readings behind one calendar cell, [cell, cell + duration)."""
    d = _DURATION[sub_domain]
    lo = F.lit(cell_start).cast("timestamp")
    hi = F.timestamp_seconds(F.unix_seconds(lo) + d)
    return in_range(df, lo, hi, col)

"""Time bucketing, slot indexes, calendar arithmetic (all native expressions)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_SECONDS = {
    "second": 1, "minute": 60, "min": 60, "hour": 3600, "day": 86400, "week": 604800,
}
_CALENDAR_UNITS = {"minute", "hour", "day", "week", "month", "quarter", "year"}

# Fragment types of the day x slot grid: slots per day and slot length (s).
FRAGMENTS = {"MINUTE": (1440, 60), "QUARTER": (96, 900), "HOUR": (24, 3600)}


def parse_duration(spec: str) -> int:
    """'15 minutes' / '1 hour' / '10 s' -> seconds."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+?)s?\s*", spec)
    if not m:
        raise ValueError(f"bad duration: {spec!r}")
    n, unit = int(m.group(1)), m.group(2).lower()
    unit = {"s": "second", "sec": "second", "m": "minute", "h": "hour", "d": "day",
            "w": "week"}.get(unit, unit)
    if unit not in _UNIT_SECONDS:
        raise ValueError(f"not a fixed-length unit: {spec!r}")
    return n * _UNIT_SECONDS[unit]


def floor_seconds(col: Column | str, seconds: int) -> Column:
    """Epoch-aligned floor of a timestamp to a fixed width (tumbling bucket)."""
    c = F.col(col) if isinstance(col, str) else col
    us = seconds * 1_000_000
    micros = F.unix_micros(c.cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(us)))


def bucket_start(col: Column | str, spec: str) -> Column:
    """Start of the bucket containing ``col``.

    ``spec`` is a calendar unit ('minute' .. 'year', 'week' starts Monday,
    'week_sunday' starts Sunday) or a fixed width such as '15 minutes'.
    """
    c = F.col(col) if isinstance(col, str) else col
    s = spec.strip().lower()
    if s in _CALENDAR_UNITS:
        return F.date_trunc(s, c.cast("timestamp"))
    if s in ("min",):
        return F.date_trunc("minute", c.cast("timestamp"))
    if s == "week_sunday":
        return sunday_week_start(c)
    return floor_seconds(c, parse_duration(s))


def sunday_week_start(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    day = F.date_trunc("day", c.cast("timestamp"))
    return F.timestamp_seconds(F.unix_seconds(day) - (F.dayofweek(day) - 1) * 86400)


def interval(n: int, unit: str) -> Column:
    """A literal interval such as ``INTERVAL 5 HOURS``."""
    u = unit.strip().lower().rstrip("s")
    if u not in ("second", "minute", "hour", "day", "week", "month", "year"):
        raise ValueError(unit)
    if u == "week":
        return F.expr(f"INTERVAL {7 * int(n)} DAYS")
    return F.expr(f"INTERVAL {int(n)} {u.upper()}S")


def epoch_seconds(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_seconds(c.cast("timestamp"))


def to_ntz(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("timestamp_ntz")


def slot_index(col: Column | str, fragment: str = "QUARTER") -> Column:
    """Index of the slot within its day: minute 0..1439, quarter 0..95, hour 0..23."""
    c = F.col(col) if isinstance(col, str) else col
    f = fragment.upper()
    if f == "MINUTE":
        return F.hour(c) * 60 + F.minute(c)
    if f == "QUARTER":
        return F.hour(c) * 4 + F.floor(F.minute(c) / 15).cast("int")
    if f == "HOUR":
        return F.hour(c)
    raise ValueError(fragment)


def slot_time(day: Column, index: Column, fragment: str = "QUARTER") -> Column:
    """Start time of slot ``index`` of ``day`` (inverse of ``slot_index``)."""
    _, width = FRAGMENTS[fragment.upper()]
    return F.timestamp_seconds(epoch_seconds(day) + index.cast("long") * width)


def week_of_year_monday(col: Column | str) -> Column:
    """``%W``: Monday-based week number, days before the first Monday are week 0."""
    c = F.col(col) if isinstance(col, str) else col
    return F.floor((F.dayofyear(c) + 6 - F.weekday(c)) / 7).cast("int")


def week_of_year_sunday(col: Column | str) -> Column:
    """``%U``: Sunday-based week number, days before the first Sunday are week 0."""
    c = F.col(col) if isinstance(col, str) else col
    return F.floor((F.dayofyear(c) + 7 - F.dayofweek(c)) / 7).cast("int")


def week_of_month(col: Column | str, monday_first: bool = True) -> Column:
    """1-based row of the day in a month calendar whose weeks start Monday (or Sunday)."""
    c = F.col(col) if isinstance(col, str) else col
    first = F.trunc(c.cast("date"), "month")
    off = F.weekday(first) if monday_first else F.dayofweek(first) - 1
    return (F.floor((F.dayofmonth(c) - 1 + off) / 7) + 1).cast("int")


def days_in_month(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.dayofmonth(F.last_day(c))


def is_leap_year(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    y = F.year(c)
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)


def days_in_year(col: Column | str) -> Column:
    return F.when(is_leap_year(col), F.lit(366)).otherwise(F.lit(365))


def js_round(col: Column | str, decimals: int = 0) -> Column:
    """Display rounding that rounds halves towards +infinity; NaN, inf and
    numbers without a fraction at this size stay as they are."""
    c = F.col(col) if isinstance(col, str) else col
    mul = float(10 ** decimals)
    return F.when(F.abs(c * mul) < 2.0 ** 52, F.floor(c * mul + 0.5) / mul).otherwise(c)

"""Source / sink round trips over data Spark derives from the driver tables."""

from __future__ import annotations

from ..operators import calendar as cal
from ..operators import points, rollup
from ..session import scratch_path
from ..sources import fixtures, series, sinks
from . import sql as S
from .catalog import register
from .q_dash import _RAW_SQL, _calendar_cte, _series


@register("series_csv_calendar", _calendar_cte(2, "day", "hour") + " select * from cells")
def q_series_csv_calendar(spark, sf):
    """Light series written as 'epoch,value,seq' CSV, read back by the series
    reader and re-bucketed into the day x hour calendar."""
    path = scratch_path(spark, "series-csv")
    series.write_series_csv(_series(spark, sf, 2), path)
    return cal.calendar_cells(series.read_series(spark, path, "csv"), "day", "hour")


@register("points_sink_roundtrip", f"""
with rp as ({S.rollup("date_trunc('minute', time)")}),
rw as ({S.R} {_RAW_SQL})
select metric, timestamp, value, city, municipality, space, aggregate from rw
union all
select metric, timestamp, value, city, municipality, space, aggregate from rp""")
def q_points_sink_roundtrip(spark, sf):
    """Raw and roll-up points written to their partitioned tables, read back
    as the serving view."""
    path = scratch_path(spark, "points")
    r = fixtures.readings(spark, sf)
    sinks.write_points(points.raw_points(r), path, "raw", mode="overwrite")
    sinks.write_points(rollup.datapoints(rollup.rollup(r)), path, "rollup", mode="overwrite")
    return sinks.read_points(spark, path)

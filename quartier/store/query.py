"""Metric queries and statistics over the published tables.

``resolve`` picks the table and resolution that answer a query with the fewest
rows: partials of a day, an hour or a minute when the downsampling interval is a
multiple of one and the aggregator can be made of partials (the store keeps sum,
count, min and max), else raw points. An ``_aggregate`` filter asks for the
written roll-up points themselves. The answer is that of the raw points.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import combine_sums
from ..functions.timefns import epoch_seconds, interval, parse_duration
from ..operators import tsquery as tq
from ..operators.stats import space_stats
from ..schema import CITY, LEVELS, MEASURES, RAW_TAG
from .publish import _month
from .tables import Manifest, Store

# Aggregators that roll-ups can answer.
_FROM_PARTIALS = ("sum", "count", "min", "max", "avg")
#: Resolutions of the partials, the coarsest first (seconds).
RESOLUTIONS = (("partials_1d", 86400), ("partials_1h", 3600), ("partials_1m", 60))


def resolve(filters: Mapping[str, str] | None, downsample: str | None, ds_agg: str,
            start: int | None = None, end: int | None = None) -> str:
    """The table that a query reads. Bounds inside a bucket cannot be told from
    its partial, so both must lie on the resolution's edges (``end`` is
    inclusive: on the last second of a bucket)."""
    tag = tq.aggregate_values(filters)
    if tag is not None and tag != {RAW_TAG}:
        return "rollup"
    if (filters or {}).get("_aggregate") is not None and tag is None:
        return "rollup"
    if downsample and ds_agg.lower() in _FROM_PARTIALS:
        width = parse_duration(downsample)
        for table, seconds in RESOLUTIONS:
            if width % seconds == 0 and (start is None or start % seconds == 0) \
                    and (end is None or (end + 1) % seconds == 0):
                return table
    return "raw"


def _from_partials(part: DataFrame, ds_agg: str, width: int) -> DataFrame:
    """Per bucket and space the downsampled value, from partials."""
    es = epoch_seconds("bucket")
    value = {"max": F.coalesce("mx.v", "first.v"), "min": F.coalesce("mn.v", "first.v")}
    if ds_agg in value:
        agg = tq._agg(ds_agg, value[ds_agg], F.lit(0))
    elif ds_agg == "count":
        agg = F.sum("c")
    else:
        agg = combine_sums([F.sum(c) for c in ("s1", "s2", "s3")])
        if ds_agg == "avg":
            agg = agg / F.sum("c")
    return part.groupBy((es - F.pmod(es, F.lit(width))).alias("b"), F.lit(CITY).alias("city"),
                        F.col("mun").alias("municipality"), F.col("room_id").alias("space"),
                        F.lit(RAW_TAG).alias("aggregate")).agg(agg.alias("v"))


def _utc_day(seconds: int | None) -> date | None:
    return None if seconds is None else datetime.fromtimestamp(seconds, timezone.utc).date()


def store_query(store: Store, metric: str, filters: Mapping[str, str] | None = None,
                group_by: Sequence[str] = (), downsample: str | None = None, ds_agg: str = "avg",
                aggregator: str = "sum", start: int | None = None, end: int | None = None,
                manifest: Manifest | None = None) -> DataFrame:
    """``operators.tsquery`` over the published tables; arguments and result are
    the same. ``start`` and ``end`` are epoch seconds, both inclusive."""
    table = resolve(filters, downsample, ds_agg, start, end)
    if metric not in MEASURES:
        table = "frequent"
    first, last = _utc_day(start), _utc_day(end)
    if table in ("raw", "rollup", "frequent"):
        points = store.read(table, metric, first, last, manifest=manifest)
        if table == "frequent":
            points = points.select(
                "metric", "timestamp", "value", "city", "day",
                *[F.lit(None).cast("int").alias(c) for c in ("municipality", "space")],
                F.lit(RAW_TAG).alias("aggregate"))
        # the day bounds prune here; tsquery bounds the timestamps
        return tq.tsquery(points, metric, filters, group_by, downsample, ds_agg, aggregator,
                          start, end)
    if table == "partials_1d":
        first, last = (d and date.fromisoformat(_month(d.isoformat())) for d in (first, last))
    part = store.read(table, metric, first, last, manifest=manifest)
    if start is not None:
        part = part.filter(F.col("bucket") >= F.timestamp_seconds(F.lit(start)))
    if end is not None:
        part = part.filter(F.col("bucket") <= F.timestamp_seconds(F.lit(end)))
    series = _from_partials(part, ds_agg.lower(), parse_duration(downsample))
    for tag, spec in (filters or {}).items():
        series = series.filter(tq.tag_predicate(tag, spec))
    return tq.across_series(series, metric, group_by, aggregator)


def store_last(store: Store, n: int, unit: str, levels: Sequence[str] = LEVELS,
               metric: str | None = None, manifest: Manifest | None = None,
               where: Column | None = None) -> DataFrame:
    """Statistics over the last ``n`` units before the store's largest reading
    time, which the manifest knows. The bounds are literals: they choose the day
    partitions and reach the reader as predicates on the timestamp. ``where``
    may bound data_id, mun and room_id."""
    m = manifest or store.manifest()
    points = store.read("raw", metric, manifest=m)
    if m.last is not None:
        lo = _before(store, m.last, n, unit)
        points = store.read("raw", metric, _utc_day(lo), _utc_day(m.last), manifest=m).filter(
            (F.col("timestamp") > lo) & (F.col("timestamp") <= m.last))
    measure = F.array_position(F.array(*[F.lit(x) for x in MEASURES]), F.col("metric")) - 1
    readings = points.select(measure.cast("int").alias("data_id"),
                             F.col("municipality").alias("mun"), F.col("space").alias("room_id"),
                             F.col("value").alias("data"))
    return space_stats(readings if where is None else readings.filter(where), levels)


def _before(store: Store, seconds: int, n: int, unit: str) -> int:
    """Epoch second of ``n`` units earlier, by Spark's calendar."""
    t = F.timestamp_seconds(F.lit(seconds)) - interval(n, unit)
    return store.spark.range(1).select(F.unix_seconds(t).alias("t")).first()["t"]

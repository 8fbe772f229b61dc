"""Metric queries over the datapoint store: metric + tag filters, per-series
downsampling, then aggregation across series (optionally grouped by tags).

Filters use the store's syntax: ``literal_or(a|b)`` (exact), ``iliteral_or(a|b)``
(case-insensitive), ``wildcard(*x*)`` / ``*`` or a plain value.  The
``_aggregate`` tag selects roll-up points by operator (``RAW`` = raw points).
No interpolation is done between series (store internals are not specified).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_avg, exact_sum, max_number, min_number
from ..functions.timefns import parse_duration, to_ntz

SERIES_TAGS = ["city", "municipality", "space", "aggregate"]
_TAG_COLUMN = {"_aggregate": "aggregate"}


def _agg(name: str, c: Column, order: Column) -> Column:
    """An aggregator by name; first and last go by ``order``."""
    fns = {"sum": exact_sum, "min": min_number, "max": max_number, "avg": exact_avg,
           "count": F.count, "dev": F.stddev_pop,
           "first": lambda x: F.min_by(x, order), "last": lambda x: F.max_by(x, order)}
    return fns[name.lower()](c)


def tag_predicate(tag: str, spec: str) -> Column:
    col = F.col(_TAG_COLUMN.get(tag, tag)).cast("string")
    spec = spec.strip()
    m = re.fullmatch(r"(i?)literal_or\((.*)\)", spec)
    if m:
        vals = m.group(2).split("|")
        if m.group(1):
            return F.lower(col).isin([v.lower() for v in vals])
        return col.isin(vals)
    m = re.fullmatch(r"(i?)wildcard\((.*)\)", spec)
    if m or "*" in spec:
        pat = (m.group(2) if m else spec)
        rx = "^" + ".*".join(re.escape(p) for p in pat.split("*")) + "$"
        if m and m.group(1):
            rx = "(?i)" + rx
        return col.rlike(rx)
    return col == spec


def aggregate_values(filters: Mapping[str, str] | None) -> set[str] | None:
    """Which point tables an ``_aggregate`` filter can match (None = all).

    The store keeps raw points and roll-up points apart and the ``_aggregate``
    tag selects between them; resolving it before building the store means
    unmatched tables (and roll-up operators) are never read or computed.
    """
    spec = (filters or {}).get("_aggregate")
    if spec is None:
        return None
    m = re.fullmatch(r"i?literal_or\((.*)\)", spec.strip())
    vals = m.group(1).split("|") if m else ([spec.strip()] if "*" not in spec else None)
    return None if vals is None else {v.upper() for v in vals}


def tsquery(store: DataFrame, metric: str, filters: Mapping[str, str] | None = None,
            group_by: Sequence[str] = (), downsample: str | None = None,
            ds_agg: str = "avg", aggregator: str = "sum",
            start: int | None = None, end: int | None = None) -> DataFrame:
    """store(metric, timestamp, value, city, municipality, space, aggregate).

    Output: bucket (TIMESTAMP_NTZ; the point time when not downsampled), the
    group-by tags, value.
    """
    df = store.filter(F.col("metric") == metric)
    # A written point table is partitioned by metric and day: bound the day
    # too, so the time range prunes partitions instead of scanning them.
    has_day = "day" in store.columns
    if start is not None:
        df = df.filter(F.col("timestamp") >= start)
        if has_day:
            df = df.filter(F.col("day") >= F.to_date(F.timestamp_seconds(F.lit(start))))
    if end is not None:
        df = df.filter(F.col("timestamp") <= end)
        if has_day:
            df = df.filter(F.col("day") <= F.to_date(F.timestamp_seconds(F.lit(end))))
    for tag, spec in (filters or {}).items():
        df = df.filter(tag_predicate(tag, spec))
    if downsample:
        w = parse_duration(downsample)
        bucket = F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(w))
    else:
        bucket = F.col("timestamp")
    per_series = (df.groupBy(bucket.alias("b"), *SERIES_TAGS)
                    .agg(_agg(ds_agg, F.col("value"), F.col("timestamp")).alias("v")))
    return across_series(per_series, metric, group_by, aggregator)


def across_series(per_series: DataFrame, metric: str, group_by: Sequence[str],
                  aggregator: str) -> DataFrame:
    """Merge series (b: epoch s, their tags, v: value) by bucket and tags."""
    gcols = [_TAG_COLUMN.get(g, g) for g in group_by]
    # across series, first and last go by the series' tags
    tags = F.concat_ws("|", *[F.coalesce(F.col(t).cast("string"), F.lit("")) for t in SERIES_TAGS])
    out = per_series.groupBy("b", *gcols).agg(
        _agg(aggregator, F.col("v"), tags).cast("double").alias("value"))
    return out.select(F.lit(metric).alias("metric"),
                      to_ntz(F.timestamp_seconds("b")).alias("bucket"), *gcols, "value")

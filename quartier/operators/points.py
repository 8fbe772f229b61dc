"""Datapoint documents: raw points, JSON serialisation, last-write-wins,
retention and the union serving view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefns import epoch_seconds, interval
from ..schema import CITY, MEASURES, RAW_TAG
from .rollup import metric_name

TAG_COLUMNS = ["city", "municipality", "space"]
POINT_COLUMNS = ["metric", "timestamp", "value", *TAG_COLUMNS, "aggregate"]


def raw_points(readings: DataFrame, measure: str | None = None) -> DataFrame:
    """One datapoint per reading, tagged with city, municipality and space."""
    r = readings.filter(F.col("data_id").between(0, 3))
    if measure is not None:
        r = r.filter(F.col("data_id") == MEASURES.index(measure))
    extra = ["event_id"] if "event_id" in readings.columns else []
    return r.select(metric_name("data_id").alias("metric"),
                    epoch_seconds("time").alias("timestamp"),
                    F.col("data").alias("value"), F.lit(CITY).alias("city"),
                    F.col("mun").alias("municipality"), F.col("room_id").alias("space"),
                    F.lit(RAW_TAG).alias("aggregate"), *extra)


def to_document(points: DataFrame) -> DataFrame:
    """Serialise flat points to the store's JSON document.

    Tag members that are NULL (municipality at city level, space above space
    level) are omitted by ``to_json``, reproducing the per-level tag sets;
    ``groupByAggregator`` is present on roll-up points only.
    """
    agg = F.when(F.col("aggregate") != RAW_TAG, F.col("aggregate"))
    doc = F.struct(
        F.col("metric"), F.col("timestamp"), F.col("value"),
        F.struct(*[F.col(t) for t in TAG_COLUMNS]).alias("tags"),
        agg.alias("groupByAggregator"))
    return points.select(F.to_json(doc).alias("value"))


def to_batches(points: DataFrame, most: int = 50) -> DataFrame:
    """The store's request form: JSON arrays of at most ``most`` documents.

    Points are numbered within their task and grouped by (task, number div
    ``most``), so no row ever holds more than one request, however many points a
    task has; a task without points makes none. Output: value, n."""
    docs = to_document(points).withColumn("_at", F.monotonically_increasing_id())
    task, number = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (docs.groupBy(task.alias("_task"), F.floor(number / most).alias("_request"))
            .agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","),
                          F.lit("]")).alias("value"), F.count(F.lit(1)).alias("n"))
            .select("value", "n"))


def read_batches(batches: DataFrame) -> DataFrame:
    """Points of JSON arrays of documents (column ``value``)."""
    one = F.explode(F.from_json("value", "array<string>"))
    return read_document(batches.select(one.alias("value")))


_DOCUMENT = ("metric string, timestamp bigint, value double, groupByAggregator string, "
             "tags struct<city:string,municipality:int,space:int>")


def read_document(docs: DataFrame) -> DataFrame:
    """Fields of JSON documents (column ``value``) and the tags each one has."""
    d = docs.select(F.from_json("value", _DOCUMENT).alias("d"),
                    F.json_object_keys(F.get_json_object("value", "$.tags")).alias("k"))
    return d.select("d.metric", "d.timestamp", "d.value", *[f"d.tags.{t}" for t in TAG_COLUMNS],
                    F.coalesce("d.groupByAggregator", F.lit(RAW_TAG)).alias("aggregate"),
                    F.array_join("k", ",").alias("tag_keys"))


_FIXED_WIDTH = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date",
                "timestamp", "timestamp_ntz")


def last_write_wins(points: DataFrame, keys: Sequence[str] = ("metric", *TAG_COLUMNS,
                                                               "aggregate", "timestamp"),
                    order: str = "event_id") -> DataFrame:
    """Keep, per key, the value written last (largest ``order``).

    A hash aggregate with ``max_by`` rather than a row_number window: map-side
    partial aggregation collapses a hot key before the shuffle, so one huge
    key never lands whole in one task.  ``order`` must be unique per key (an
    ingest sequence or batch id); then one primitive ``max_by`` per column
    picks every column from the same row and keeps the aggregate hash-based
    (a struct-valued buffer would force a sort-based aggregate).
    """
    others = [c for c in points.columns if c not in keys]
    types = dict(points.dtypes)
    if all(types[c] in _FIXED_WIDTH for c in others):
        g = points.groupBy(*keys).agg(*[F.max_by(F.col(c), F.col(order)).alias(c)
                                        for c in others])
        return g.select(*keys, *others)
    g = points.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in others]), F.col(order)).alias("_w"))
    return g.select(*keys, *[F.col("_w")[c].alias(c) for c in others])


def retain(df: DataFrame, years: int = 10, time_col: str = "time", as_of=None,
           days: int | None = None) -> DataFrame:
    """Drop readings older than ``years`` (or ``days``) before the as-of time.

    On a table partitioned by ``day`` the cut-off also bounds the partition
    column, so expired partitions are pruned rather than scanned."""
    from .stats import as_of_time
    now = as_of_time(df.withColumnRenamed(time_col, "time") if time_col != "time" else df, as_of)
    cut = now - (interval(years, "years") if days is None else interval(days, "days"))
    out = df.filter(F.col(time_col) >= cut)
    if "day" in df.columns:
        out = out.filter(F.col("day") >= F.to_date(cut))
    return out


def serving_union(*frames: DataFrame) -> DataFrame:
    """Union of raw, roll-up and frequency points into one store view."""
    out = None
    for f in frames:
        f = f.select(*POINT_COLUMNS)
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out

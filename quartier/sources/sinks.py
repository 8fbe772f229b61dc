"""Datapoint sinks (raw and roll-up tables), console sink, point readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.points import POINT_COLUMNS, to_document


def write_points(points: DataFrame, path: str, kind: str = "raw", mode: str = "append",
                 fmt: str = "parquet") -> None:
    """Write flat datapoints to the ``raw`` or ``rollup`` table.

    Partitioned by metric and UTC day so metric + time-range queries prune
    files.  Rows are clustered by the partition keys with a ``rebalance``
    hint: AQE splits a hot (metric, day) -- a day holding a third of all rows
    is written by many tasks, not one -- and merges small ones, so files stay
    few and sized.  ``fmt='json'`` writes the wire documents instead.
    """
    p = points.select(*POINT_COLUMNS).withColumn(
        "day", F.to_date(F.timestamp_seconds("timestamp")))
    target = f"{path.rstrip('/')}/{kind}"
    if fmt == "json":
        docs = to_document(points).withColumn(
            "day", F.to_date(F.timestamp_seconds(F.get_json_object("value", "$.timestamp")
                                                 .cast("long"))))
        docs.hint("rebalance", "day").write.mode(mode).partitionBy("day").text(target)
        return
    (p.hint("rebalance", "metric", "day").write.mode(mode).partitionBy("metric", "day")
       .format(fmt).save(target))


def read_points(spark: SparkSession, path: str, kinds=("raw", "rollup"),
                with_day: bool = False) -> DataFrame:
    """The serving view: union of the written point tables (``with_day`` keeps
    the partition column so metric/time filters prune partitions)."""
    out = None
    cols = [*POINT_COLUMNS, "day"] if with_day else POINT_COLUMNS
    for k in kinds:
        df = spark.read.parquet(f"{path.rstrip('/')}/{k}").select(*cols)
        out = df if out is None else out.unionByName(df)
    return out


def console(df: DataFrame, rows: int = 20):
    """Debug print sink (batch ``show`` or a streaming console query)."""
    if df.isStreaming:
        return df.writeStream.format("console").option("numRows", rows).start()
    df.show(rows, truncate=False)
    return None

"""Positions in a global order, without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TASK_BITS = 33      # monotonically_increasing_id keeps the task above these


def with_row_index(df: DataFrame, by: Sequence[str], path: str) -> DataFrame:
    """``df`` with ``row_index``, each row's place (from 0) in the order of
    ``by``. Rows are range-sorted and written to ``path``; a row's place in its
    task plus the rows of the tasks before it is its index. The driver adds up
    the tasks' counts, one row each."""
    rows = df.orderBy(*by).withColumn("_pos", F.monotonically_increasing_id())
    rows.write.mode("overwrite").parquet(path)
    spark = df.sparkSession
    rows = (spark.read.schema(rows.schema).parquet(path)
            .withColumn("_task", F.shiftright("_pos", _TASK_BITS)))
    counts = rows.groupBy("_task").agg(F.min("_pos").alias("first"), F.count(F.lit(1)).alias("n"))
    before, shifts = 0, []
    for r in sorted(counts.collect()):
        shifts.append((r["_task"], before - r["first"]))
        before += r["n"]
    shift = spark.createDataFrame(shifts, "_task long, _shift long")
    return (rows.join(F.broadcast(shift), "_task")
            .withColumn("row_index", F.col("_pos") + F.col("_shift"))
            .drop("_pos", "_task", "_shift"))

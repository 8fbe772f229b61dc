"""Positions of rows within their group, whatever the size of a group.

Rows are range-sorted by (group, order) over all tasks and written; the place
of a row in its sorted task and the counts of the tasks before it give its
position. A group that fills many tasks is never gathered in one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

_TASK_BITS = 33      # monotonically_increasing_id keeps the task above these


def numbered(df: DataFrame, group: str, order: list[str], path: str) -> DataFrame:
    """``df`` with ``idx`` (from 0 within ``group``, ascending, nulls first) and
    ``size`` (rows of the group). ``group`` is never null. Rows equal in all of
    ``order`` are told apart by their place in the input, so that many of them
    spread over tasks. ``path`` takes the sorted table."""
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    rows = df.withColumn("_in", F.monotonically_increasing_id())
    rows = (rows.repartitionByRange(*keys, F.col("_in")).sortWithinPartitions(*keys, F.col("_in"))
            .drop("_in").withColumn("_pos", F.monotonically_increasing_id()))
    rows = written(rows, path).withColumn("_task", F.shiftright("_pos", _TASK_BITS))
    tasks = rows.groupBy(group, "_task").agg(F.min("_pos").alias("_first"),
                                             F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select(
        group, "_task", F.sum("_n").over(whole).alias("size"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return (rows.join(tasks, [group, "_task"])
            .withColumn("idx", F.col("_pos") + F.col("_shift"))
            .drop("_pos", "_task", "_shift"))

"""Dimension lookups: readings joined with space coordinates and names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import dims

# Largest dimension we broadcast without asking Spark for statistics.
BROADCAST_MAX_ROWS = 1_000_000


def join_dimension(facts: DataFrame, dim: DataFrame, on, dim_rows: int | None,
                   how: str = "left") -> DataFrame:
    """Join a fact stream with a dimension.

    The dimension is broadcast only when its row count is known and bounded
    (the built-in tables have 54 / 19 rows); otherwise the join is left to
    the planner (AQE converts it to a broadcast at runtime if it turns out
    small, a shuffle join if not).
    """
    if dim_rows is not None and dim_rows <= BROADCAST_MAX_ROWS:
        dim = F.broadcast(dim)
    return facts.join(dim, on, how)


def with_coordinates(readings: DataFrame) -> DataFrame:
    """Reading + (x, y) of its space; unknown rooms get NULL."""
    d = dims.space_dim(readings.sparkSession)
    return join_dimension(readings, d, "room_id", len(dims.space_rows()))


def with_municipality_names(readings: DataFrame) -> DataFrame:
    """Reading + municipality name by municipality id and by room."""
    spark = readings.sparkSession
    by_id = dims.municipality_dim(spark).withColumnRenamed("name", "municipality_name")
    by_room = dims.room_municipality_dim(spark).withColumnRenamed(
        "municipality_name", "room_municipality_name")
    out = join_dimension(readings, by_id, "mun", len(dims.municipality_name_rows()))
    return join_dimension(out, by_room, "room_id", len(dims.room_municipality_rows()))


def with_measure_names(readings: DataFrame) -> DataFrame:
    """data_id -> measure name as an array lookup (no join at all)."""
    from .rollup import metric_name
    return readings.withColumn("measure", metric_name("data_id"))

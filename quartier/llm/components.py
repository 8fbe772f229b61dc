"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; the root is the component's
    smallest node. ``edges``: long columns a, b.

    Large-star hangs larger neighbours on the smallest one, small-star the
    smaller ones; a component becomes a star in a logarithmic number of rounds.
    Each round is written to the shared folder; only a row count and a hash sum
    reach the driver.
    """
    spark = edges.sparkSession
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    e = written(e.distinct(), scratch_path(spark, "edges"))
    before = None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == state or state[0] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state
        # large-star
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        e = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = e.filter("u <> v").distinct()
        # small-star
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct("u", F.col("m").alias("v")))).alias("x"))
        e = written(e.select("x.u", "x.v").filter("u <> v").distinct(),
                    scratch_path(spark, "edges"))

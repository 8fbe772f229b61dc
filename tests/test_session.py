"""Shared-folder contract and retention pruning."""

from datetime import datetime

from quartier.operators import points
from quartier.session import scratch_path, shared_dir


def test_scratch_paths_live_under_the_session_checkpoint_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == base.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base.rstrip("/") + "/quartier/x-")


def test_retention_bounds_day_partitions(spark):
    df = spark.createDataFrame(
        [(datetime(2010, 1, 1), datetime(2010, 1, 1).date(), 1.0),
         (datetime(2024, 1, 1), datetime(2024, 1, 1).date(), 2.0)],
        "time timestamp, day date, data double")
    out = points.retain(df, years=10, as_of=datetime(2024, 6, 1))
    assert [r["data"] for r in out.collect()] == [2.0]
    assert "day" in out._jdf.queryExecution().optimizedPlan().toString().split("Filter")[1]

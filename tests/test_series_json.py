import os

import pytest

from quartier.session import scratch_path
from quartier.sources import series


def test_json_lines_are_split_over_tasks(spark):
    """One object per line is read by several tasks; spread objects on request."""
    base = scratch_path(spark, "series")
    os.makedirs(base)
    with open(f"{base}/lines.json", "w") as f:
        f.writelines(f'{{"{1704067200 + i}": {i}}}\n' for i in range(500))
    with open(f"{base}/spread.json", "w") as f:
        f.write('{\n "1704067200": 1,\n "1704067201": 2\n}\n{"1704067202": 3}\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = series.read_series(spark, f"{base}/lines.json", "json")
        assert lines.rdd.getNumPartitions() > 1
        assert sorted(r["value"] for r in lines.collect()) == list(range(500))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spread = series.read_series(spark, f"{base}/spread.json", "json", multi_line=True)
    assert sorted(r["value"] for r in spread.collect()) == [1, 2, 3]
    with pytest.raises(Exception, match="multi_line"):
        series.read_series(spark, f"{base}/spread.json", "json").collect()

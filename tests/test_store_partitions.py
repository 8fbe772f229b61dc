"""A store of many metrics and days: what one partition costs."""

import os

from pyspark.sql import functions as F

from quartier.session import scratch_path, setting
from quartier.store import Store
from quartier.store.tables import TABLES, Manifest


def _written(spark, days):
    """A store whose raw table holds one point per metric and day."""
    store = Store(spark, scratch_path(spark, "partitions"))
    rows = spark.range(4 * days).select(
        F.concat(F.lit("m"), F.col("id") % 4).alias("metric"),
        F.expr("date_add(date'2024-01-01', cast(id div 4 as int))").alias("day"),
        F.col("id").alias("timestamp"), F.lit(1.0).alias("value"))
    for f in TABLES["raw"]:
        if f.name not in rows.columns:
            rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    folder = store.write(rows, "raw", ["timestamp"])
    keys = [f"{m}/{d}" for m, d in store.partitions(folder)]
    return store, folder, Manifest(1, 1, {}, None, {"raw": {k: [folder] for k in keys}})


def test_listing_takes_few_tasks_and_keeps_all_partitions(spark):
    most = 4 * spark.sparkContext.defaultParallelism
    days = max(most, 32) // 4 + 4
    store, folder, manifest = _written(spark, days)
    assert len(store.partitions(folder)) == 4 * days
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        df = store.read("raw", manifest=manifest)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("listing")
             for s in tracker.getJobInfo(j).stageIds]
    assert tasks and max(tasks) <= most
    assert df.count() == 4 * days and df.select("metric", "day").distinct().count() == 4 * days
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == "10000"


def test_names_take_one_call_however_many(spark, monkeypatch):
    store = Store(spark, scratch_path(spark, "names, and more"))
    for i in range(300):
        os.makedirs(f"{store.base}/many/day={i}, x")
    for n in ("few/a", "few/.hidden", "few/b", "none"):
        os.makedirs(f"{store.base}/{n}")
    client, sent = spark.sparkContext._gateway._gateway_client, []
    plain = client.send_command
    monkeypatch.setattr(client, "send_command",
                        lambda command, *a, **k: (sent.append(command), plain(command, *a, **k))[1])
    assert store.files.names("many") == sorted(f"day={i}, x" for i in range(300))
    assert len(sent) < 50
    assert store.files.names("few") == ["a", "b"]
    assert store.files.names("none") == store.files.names("missing") == []


def test_a_setting_is_given_back(spark):
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(key)
    with setting(spark, key, "32k"):
        assert spark.conf.get(key) != before
        with setting(spark, key, "64k"):        # the session's own counts
            assert spark.conf.get(key) == "32k"
    assert spark.conf.get(key) == before

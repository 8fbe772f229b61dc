"""Structured Streaming twins: availableNow == batch, late rows count, in-progress
files are skipped, restarts go on, replays are idempotent."""

import os
from datetime import datetime

import pyspark.sql.functions as F

from quartier.operators import rollup
from quartier.session import scratch_path
from quartier.sources import fixtures
from quartier.streaming import jobs

SF = "/root/testdata/sf0.001"


def test_stream_rollup_equals_batch(spark):
    s = jobs.run_rollup(spark, SF)
    b = rollup.rollup(fixtures.readings(spark, SF))
    assert s.count() == b.count() > 0
    assert s.exceptAll(b.select(*s.columns)).count() == 0


def test_stream_frequent_equals_batch(spark):
    from quartier.operators import frequent as fq
    s = jobs.run_frequent(spark, SF)
    b = fq.frequent_top(fixtures.readings(spark, SF), 1)
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0


def _write_lines(d, name, lines, mtime=None):
    path = os.path.join(d, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    if mtime is not None:            # arrival order of the files
        os.utime(path, (mtime, mtime))


def _want(spark, src):
    from quartier.functions.parse import parse_lines
    return rollup.rollup(parse_lines(spark.read.text(src + "/[a-z]*.txt")))


def test_late_rows_count_and_a_restart_goes_on(spark):
    from quartier.functions.parse import parse_lines
    base = scratch_path(spark, "late")
    src = base + "/in"
    os.makedirs(src)
    _write_lines(src, "a.txt", ["2024-01-01 12:00:05 1-20-0 10.0 1.0"], 1_700_000_000)
    _write_lines(src, ".inprogress.txt", ["2024-01-01 12:00:06 1-20-0 99.0 1.0"], 1_700_000_001)
    _write_lines(src, "b.txt", ["2024-01-01 13:00:05 1-20-0 11.0 1.0"], 1_700_000_002)
    _write_lines(src, "c.txt", ["2024-01-01 13:10:05 1-20-0 nan 1.0"], 1_700_000_003)
    _write_lines(src, "d.txt", ["2024-01-01 12:00:07 1-20-0 50.0 1.0"], 1_700_000_004)

    def run(checkpoint):
        readings = parse_lines(jobs.line_stream(spark, src, max_files=1))
        jobs.start_rollup(readings, base + "/out", base + checkpoint).awaitTermination()
        return jobs.read_rollup(spark, base + "/out")

    out = run("/ckpt")
    mx = {r["bucket"]: r["value"] for r in out.filter("aggregate = 'MAX' and level = 'city'").collect()}
    assert mx[datetime(2024, 1, 1, 12, 0)] == 50.0 and mx[datetime(2024, 1, 1, 13, 0)] == 11.0
    assert out.exceptAll(_want(spark, src)).count() == 0 and out.count() == _want(spark, src).count()
    # a restart from the checkpoint reads new files only; later rows still count
    _write_lines(src, "e.txt", ["2024-01-01 12:00:09 1-20-0 70.0 1.0"], 1_700_000_005)
    out = run("/ckpt")
    assert out.exceptAll(_want(spark, src)).count() == 0 and out.count() == _want(spark, src).count()
    # a new checkpoint on the same output replaces nothing
    before = jobs.read_batches(spark, base + "/out").count()
    run("/ckpt-2")
    assert jobs.read_batches(spark, base + "/out").count() > before


def test_many_small_batches_equal_one(spark):
    """Files in falling time order, one per micro-batch."""
    base = scratch_path(spark, "order")
    ev = fixtures.events(spark, SF)
    cuts = ev.approxQuantile("event_id", [0.25, 0.5, 0.75], 0)
    for i, (lo, hi) in enumerate(zip([*cuts[::-1], -1], [10**9, *cuts[::-1]])):
        ev.filter((F.col("event_id") > lo) & (F.col("event_id") <= hi)).coalesce(1) \
            .write.mode("append").parquet(base + "/events.parquet")
    src = fixtures.readings_from_events(jobs.event_stream(spark, base, max_files=1))
    jobs.start_rollup(src, base + "/out", base + "/c1").awaitTermination()
    jobs.start_pane_counts(src, base + "/panes", base + "/c2").awaitTermination()
    want = rollup.rollup(fixtures.readings(spark, SF))
    got = jobs.read_rollup(spark, base + "/out")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    from quartier.operators import frequent as fq
    top, best = jobs.read_frequent(spark, base + "/panes"), fq.frequent_top(fixtures.readings(spark, SF), 1)
    assert top.exceptAll(best).count() == 0 and best.exceptAll(top).count() == 0


def test_replayed_batch_is_idempotent(spark):
    base = scratch_path(spark, "replay")
    df = spark.createDataFrame([(1, 2.0)], "k int, v double")
    w = jobs.batch_writer(base)
    w(df, 0)
    w(df, 0)        # replay of the same batch after a failure
    w(spark.createDataFrame([(1, 5.0)], "k int, v double"), 1)
    got = jobs.read_upserts(spark, base, ["k"]).collect()
    assert [(r["k"], r["v"]) for r in got] == [(1, 5.0)]


def test_landing_round_trip(spark):
    r = jobs.run_landing(spark, SF)
    want = fixtures.readings(spark, SF).drop("event_id")
    assert r.drop("dt").exceptAll(want).count() == 0 and r.count() == want.count()


def test_runner_starts_all_layers(spark):
    from quartier.streaming import run
    base = scratch_path(spark, "runner")
    a = run.parser().parse_args(["--source", "events", "--path", SF, "--out", base,
                                 "--available-now"])
    qs = run.start_all(spark, a)
    for q in qs:
        q.awaitTermination()
    assert len(qs) == 4
    raw = spark.read.parquet(base + "/points/raw")
    assert raw.count() == fixtures.readings(spark, SF).count()
    jobs.publish_rollup(spark, base + "/points/rollup_batches", base + "/points")
    from quartier.sources import sinks
    snap = sinks.read_points(spark, base + "/points", kinds=("rollup",))
    assert snap.count() == rollup.rollup(fixtures.readings(spark, SF)).count()
    assert spark.read.text(base + "/landing").count() == fixtures.events(spark, SF).count()


def test_kafka_shaped_records_through_the_pipeline(spark):
    """The Kafka connector jar is absent offline: feed records with the Kafka
    source's schema (topic, partition, offset, key, value as binary) through a
    file stream and run the same value-unwrap -> parse -> roll-up path."""
    from pyspark.sql import types as T
    from quartier.functions.parse import parse_lines
    base = scratch_path(spark, "kafka-shaped")
    lines = fixtures.lines_from_events(fixtures.events(spark, SF))
    recs = lines.select(F.lit("readings").alias("topic"),
                        (F.col("event_id") % 3).cast("int").alias("partition"),
                        F.col("event_id").alias("offset"),
                        F.col("event_id").cast("string").cast("binary").alias("key"),
                        F.col("value").cast("binary").alias("value"))
    recs.write.parquet(base + "/topic")
    schema = T.StructType([T.StructField("topic", T.StringType()),
                           T.StructField("partition", T.IntegerType()),
                           T.StructField("offset", T.LongType()),
                           T.StructField("key", T.BinaryType()),
                           T.StructField("value", T.BinaryType())])
    stream = spark.readStream.schema(schema).parquet(base + "/topic")
    insp = jobs.kafka_inspect(stream)
    assert insp.columns == ["topic", "partition", "offset", "key", "value"]
    readings = parse_lines(jobs.kafka_values(stream))
    q = jobs.start_rollup(readings, base + "/out", base + "/ckpt")
    q.awaitTermination()
    got = jobs.read_rollup(spark, base + "/out")
    want = rollup.rollup(fixtures.readings(spark, SF))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_runner_on_landing_files(spark):
    """--source files: the batch and speed layers over wire lines landed as text."""
    from quartier.streaming import run
    base = scratch_path(spark, "runner-files")
    lines = fixtures.lines_from_events(fixtures.events(spark, SF)).select("value")
    lines.write.text(base + "/landing")
    a = run.parser().parse_args(["--source", "files", "--path", base + "/landing",
                                 "--out", base + "/out", "--available-now"])
    qs = run.start_all(spark, a)
    for q in qs:
        q.awaitTermination()
    assert len(qs) == 3                       # no landing job for a file source
    raw = spark.read.parquet(base + "/out/points/raw")
    assert raw.count() == fixtures.readings(spark, SF).count()
    top = jobs.read_frequent(spark, base + "/out/speed/panes")
    from quartier.operators import frequent as fq
    want = fq.frequent_top(fixtures.readings(spark, SF), 1)
    assert top.exceptAll(want).count() == 0 and want.exceptAll(top).count() == 0


def test_runner_main_publishes_the_rollup_table(spark):
    from quartier.sources import sinks
    from quartier.streaming import run
    base = scratch_path(spark, "runner-main")
    assert run.main(["--source", "events", "--path", SF, "--out", base, "--available-now"]) == 0
    snap = sinks.read_points(spark, base + "/points", kinds=("rollup",))
    assert snap.count() == rollup.rollup(fixtures.readings(spark, SF)).count()

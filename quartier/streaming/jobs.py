"""Structured Streaming jobs: the same DataFrame functions as the batch layer,
wired to stream sources and idempotent sinks.

* Sources: text directory (landing files), Kafka (connector jar needed; not
  bundled), and the events table as a file stream standing in for Kafka.
* Aggregations are stateless: a micro-batch writes combinable partials (minute
  roll-ups, pane counts) and readers merge them.  A late reading counts in the
  batch it arrives in; nothing is dropped and no state grows.
* ``foreachBatch`` writes each micro-batch to its own ``run=R/batch_id=N``
  partition with overwrite, so a replayed batch (after a lost executor or a
  driver restart from the checkpoint) replaces its own output.  R names the
  checkpoint: a new checkpoint on an old output cannot replace older batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.parse import parse_lines
from ..operators import frequent as fq
from ..operators import rollup as ro
from ..operators.points import last_write_wins
from ..schema import EVENTS
from ..session import ensure_utc, scratch_path
from ..sources.fixtures import lines_from_events, readings_from_events


# -- sources ------------------------------------------------------------------------

def _is_dir(spark: SparkSession, path: str) -> bool:
    """Directory test through the Hadoop FileSystem (local, HDFS, object stores)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def event_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The driver's events table read as a file stream (stand-in for Kafka).

    The table is either one file next to the other tables or a directory of
    part files (the usual layout at scale); both are streamed."""
    ensure_utc(spark)
    sf_dir = str(sf_dir)
    table = f"{sf_dir.rstrip('/')}/events.parquet"
    rs = spark.readStream.schema(EVENTS)
    if max_files:
        rs = rs.option("maxFilesPerTrigger", max_files)
    if _is_dir(spark, table):
        return rs.parquet(table)
    return rs.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def line_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A1: new text files of a landing directory; names starting with '.' or
    '_' (files still being written) are skipped by the file source."""
    rs = spark.readStream
    if max_files:
        rs = rs.option("maxFilesPerTrigger", max_files)
    return rs.text(path)


def kafka_stream(spark: SparkSession, bootstrap: str, topic: str,
                 starting_offsets: str = "latest", max_offsets: int | None = None) -> DataFrame:
    """A3: Kafka source (needs the spark-sql-kafka connector on the classpath)."""
    rs = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
          .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if max_offsets:
        rs = rs.option("maxOffsetsPerTrigger", max_offsets)
    return rs.load()


def kafka_values(records: DataFrame) -> DataFrame:
    """Keep the record value as the line text."""
    return records.select(F.col("value").cast("string").alias("value"))


def kafka_inspect(records: DataFrame) -> DataFrame:
    """A4: topic:partition:offset key value, for a console or memory sink."""
    return records.select("topic", "partition", "offset",
                          F.col("key").cast("string").alias("key"),
                          F.col("value").cast("string").alias("value"))


# -- sinks ----------------------------------------------------------------------------

def batch_writer(out_dir: str, run: str = "0", fmt: str = "parquet"):
    """foreachBatch function: overwrite this batch's own partition."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").format(fmt).save(f"{out_dir}/run={run}/batch_id={batch_id}")
    return write


def read_batches(spark: SparkSession, out_dir: str) -> DataFrame:
    """Everything the micro-batches have written."""
    return (spark.read.option("basePath", out_dir).parquet(out_dir).drop("run", "batch_id"))


def read_upserts(spark: SparkSession, out_dir: str, keys: Sequence[str]) -> DataFrame:
    """Latest version of every key over the written micro-batches of one run."""
    df = spark.read.parquet(out_dir)
    return last_write_wins(df, keys=list(keys), order="batch_id").drop("batch_id", "run")


def _start(df: DataFrame, per_batch, out_dir: str, checkpoint: str,
           available_now: bool = True, interval: str = "60 seconds") -> StreamingQuery:
    """Append ``per_batch(micro-batch)`` to ``out_dir``."""
    run = hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    write = batch_writer(out_dir, run)
    w = (df.writeStream.foreachBatch(lambda b, i: write(per_batch(b), i))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def salted_cluster(df: DataFrame, keys: list[str], spread: list[str]) -> DataFrame:
    """Cluster a stream by its output partition keys before a partitioned file
    sink: a hot partition (today's day) is spread over as many tasks as the
    session shuffles to.  (AQE's rebalance does not apply to streams.)"""
    salt = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = F.pmod(F.hash(*[F.col(c) for c in spread]), F.lit(salt))
    return df.repartition(*[F.col(k) for k in keys], s)


# -- jobs -------------------------------------------------------------------------------

def start_rollup(readings: DataFrame, out_dir: str, checkpoint: str, bucket: str = "1 minute",
                 **trigger) -> StreamingQuery:
    """Batch layer: each micro-batch's partials per minute, measure and room."""
    return _start(readings, lambda b: ro.partials(b, bucket), out_dir, checkpoint, **trigger)


def read_rollup(spark: SparkSession, out_dir: str) -> DataFrame:
    """Every roll-up output per minute, from all batches' partials."""
    return ro.rollup_partials(read_batches(spark, out_dir))


def publish_rollup(spark: SparkSession, out_dir: str, points_path: str) -> None:
    """Write the roll-up points of all batches as the served table, partitioned
    by metric and day (``sinks.read_points`` reads it)."""
    from ..sources.sinks import write_points
    write_points(ro.datapoints(read_rollup(spark, out_dir)), points_path, "rollup",
                 mode="overwrite")


def start_pane_counts(readings: DataFrame, out_dir: str, checkpoint: str,
                      slide: str = "10 minutes", digits: int = 0, **trigger) -> StreamingQuery:
    """Speed layer: each micro-batch's counts per (pane, rounded temperature)."""
    return _start(readings, lambda b: fq.pane_counts(b, slide, digits), out_dir, checkpoint,
                  **trigger)


def read_panes(spark: SparkSession, out_dir: str) -> DataFrame:
    return read_batches(spark, out_dir).groupBy("pane", "temperature").agg(F.sum("n").alias("n"))


def read_frequent(spark: SparkSession, out_dir: str, k: int = 1, size: str = "1 hour",
                  slide: str = "10 minutes") -> DataFrame:
    return fq._out(fq.top_k(fq.window_counts(read_panes(spark, out_dir), size, slide), k))


def read_per_batch(spark: SparkSession, out_dir: str, batch: str = "10 seconds",
                   size: str = "60 seconds") -> DataFrame:
    """Speed layer as coded: largest single-batch group per sliding window,
    from pane counts streamed with ``slide = batch``."""
    return fq.per_batch_winners(read_panes(spark, out_dir), batch, size)


def start_raw_points(readings: DataFrame, out_dir: str, checkpoint: str,
                     available_now: bool = True, interval: str = "60 seconds") -> StreamingQuery:
    """Raw datapoints of every reading, appended to the raw point table
    (parquet partitioned by metric and day; the file sink's metadata log makes
    the output exactly-once across restarts)."""
    from ..operators.points import raw_points
    p = salted_cluster(raw_points(readings).withColumn(
        "day", F.to_date(F.timestamp_seconds("timestamp"))), ["metric", "day"], ["space", "timestamp"])
    w = (p.writeStream.format("parquet").partitionBy("metric", "day").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", out_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def start_landing(events: DataFrame, out_dir: str, checkpoint: str,
                  available_now: bool = True, interval: str = "5 seconds") -> StreamingQuery:
    """A5: land every record as a wire line in date-partitioned text files."""
    lines = salted_cluster(lines_from_events(events).select("dt", "value"), ["dt"], ["value"])
    w = (lines.writeStream.format("text").partitionBy("dt").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", out_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


# -- run-to-completion helpers used by the registered queries -------------------------------

def run_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "stream-rollup")
    q = start_rollup(readings_from_events(event_stream(spark, sf_dir)), f"{base}/out",
                     f"{base}/ckpt")
    q.awaitTermination()
    return read_rollup(spark, f"{base}/out")


def run_frequent(spark: SparkSession, sf_dir: str, k: int = 1) -> DataFrame:
    base = scratch_path(spark, "stream-frequent")
    q = start_pane_counts(readings_from_events(event_stream(spark, sf_dir)), f"{base}/out",
                          f"{base}/ckpt")
    q.awaitTermination()
    return read_frequent(spark, f"{base}/out", k)


def run_batch_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both batch-layer outputs from one source: raw points (stateless, append)
    and roll-up partials; returns the union as the store sees it."""
    from ..operators.points import POINT_COLUMNS
    base = scratch_path(spark, "batch-layer")
    src = readings_from_events(event_stream(spark, sf_dir))
    q1 = start_raw_points(src, f"{base}/raw", f"{base}/ckpt-raw")
    q2 = start_rollup(src, f"{base}/rollup", f"{base}/ckpt-rollup")
    q1.awaitTermination()
    q2.awaitTermination()
    raw = spark.read.parquet(f"{base}/raw").select(*POINT_COLUMNS)
    return raw.unionByName(ro.datapoints(read_rollup(spark, f"{base}/rollup")))


def run_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "stream-per-batch")
    q = start_pane_counts(readings_from_events(event_stream(spark, sf_dir)), f"{base}/out",
                          f"{base}/ckpt", slide="10 seconds")
    q.awaitTermination()
    return read_per_batch(spark, f"{base}/out")


def run_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "stream-landing")
    q = start_landing(event_stream(spark, sf_dir), f"{base}/lines", f"{base}/ckpt")
    q.awaitTermination()
    return parse_lines(spark.read.text(f"{base}/lines"))

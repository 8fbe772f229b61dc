"""Run the streaming layers on a cluster.

    spark-submit -m quartier.streaming.run --source kafka --bootstrap host:9092 \
        --topic readings --out s3://bucket/sensors [--available-now]

Starts, on one source: the landing job (wire lines -> dated text files), the
batch layer (raw points + per-minute roll-ups) and the speed layer (pane
counts for the frequent-temperature windows).  Checkpoints and outputs live
under ``--out`` (shared storage), so a restarted driver resumes every query
where it stopped.  ``--source files`` reads new text files of a landing
directory instead of Kafka; ``--source events`` streams the driver's events
table (tests and demos).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from ..functions.parse import parse_lines
from ..session import ensure_utc
from ..sources.fixtures import readings_from_events
from . import jobs


def build_readings(spark: SparkSession, a) -> tuple:
    """(readings stream, raw line/event stream for the landing job or None)."""
    if a.source == "kafka":
        lines = jobs.kafka_values(jobs.kafka_stream(spark, a.bootstrap, a.topic,
                                                    max_offsets=a.max_offsets))
        return parse_lines(lines, id_parts=a.id_parts), None
    if a.source == "files":
        return parse_lines(jobs.line_stream(spark, a.path, a.max_files), id_parts=a.id_parts), None
    ev = jobs.event_stream(spark, a.path, a.max_files)
    return readings_from_events(ev), ev


def start_all(spark: SparkSession, a) -> list:
    ensure_utc(spark)
    out = a.out.rstrip("/")
    trig = {"available_now": a.available_now, "interval": f"{a.interval} seconds"}
    readings, events = build_readings(spark, a)
    qs = []
    if events is not None:
        qs.append(jobs.start_landing(events, f"{out}/landing", f"{out}/_ckpt/landing",
                                     a.available_now, f"{a.landing_interval} seconds"))
    qs.append(jobs.start_raw_points(readings, f"{out}/points/raw", f"{out}/_ckpt/raw",
                                    a.available_now, f"{a.interval} seconds"))
    qs.append(jobs.start_rollup(readings, f"{out}/points/rollup_batches", f"{out}/_ckpt/rollup",
                                **trig))
    speed = {"available_now": a.available_now, "interval": f"{a.speed_interval} seconds"}
    qs.append(jobs.start_pane_counts(readings, f"{out}/speed/panes", f"{out}/_ckpt/panes",
                                     **speed))
    return qs


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="quartier.streaming.run")
    ap.add_argument("--source", choices=["kafka", "files", "events"], default="kafka")
    ap.add_argument("--bootstrap")
    ap.add_argument("--topic", help="Kafka topic (required for --source kafka)")
    ap.add_argument("--path", help="landing directory (files) or table folder (events)")
    ap.add_argument("--out", required=True, help="shared output / checkpoint root")
    ap.add_argument("--id-parts", type=int, default=3)
    ap.add_argument("--interval", type=int, default=60, help="batch-layer trigger (s)")
    ap.add_argument("--speed-interval", type=int, default=10, help="speed-layer trigger (s)")
    ap.add_argument("--landing-interval", type=int, default=5)
    ap.add_argument("--max-files", type=int)
    ap.add_argument("--max-offsets", type=int)
    ap.add_argument("--available-now", action="store_true")
    return ap


def main(argv=None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("quartier-streams").getOrCreate()
    if a.source == "kafka" and not a.topic:
        raise SystemExit("--topic is required for --source kafka")
    qs = start_all(spark, a)
    for q in qs:
        q.awaitTermination()
    out = a.out.rstrip("/")
    jobs.publish_rollup(spark, f"{out}/points/rollup_batches", f"{out}/points")
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""One stream with every output, and a store that is published while it runs.

    spark-submit -m quartier.streaming.serve --source kafka --bootstrap HOST:9092 \
        --topic TOPIC --out SHARED_DIR [--interval 60] [--publish 300] [--keep-days 3650]

Every trigger reads the source once and commits landed lines, raw points, minute
partials, pane counts and frequent points together; every ``--publish`` seconds
the commits since are merged into the published tables, expired days leave them
(``--keep-days``), and files that the newest ``--keep`` manifests do not need are
removed. A restarted driver goes on from the checkpoint and the newest manifest.
``--source files`` reads new text files of a folder, ``--source events`` the
driver's events table as wire lines.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_utc
from ..store import Store, publish, retire, vacuum
from . import jobs, outputs


def lines_of(spark: SparkSession, a) -> DataFrame:
    """The source as wire lines (column ``value``), whatever it is."""
    if a.source == "kafka":
        return jobs.kafka_values(jobs.kafka_stream(spark, a.bootstrap, a.topic,
                                                   max_offsets=a.max_offsets))
    if a.source == "files":
        return jobs.line_stream(spark, a.path, a.max_files)
    return outputs.event_lines(jobs.event_stream(spark, a.path, a.max_files))


def upkeep(store: Store, a) -> None:
    """Publish what has been committed; drop expired days and old files."""
    publish(store)
    if a.keep_days:
        retire(store, a.keep_days)
    vacuum(store, a.keep)


def serve(spark: SparkSession, a, lines: DataFrame | None = None) -> Store:
    """Run the stream until it ends (never, unless --available-now), with upkeep
    between its triggers and once after the last."""
    ensure_utc(spark)
    store = Store(spark, f"{a.out.rstrip('/')}/store")
    query = outputs.start_outputs(
        lines_of(spark, a) if lines is None else lines, store.base,
        f"{a.out.rstrip('/')}/checkpoint", a.available_now, f"{a.interval} seconds",
        delay=a.delay, id_parts=a.id_parts)
    while not query.awaitTermination(a.publish):
        upkeep(store, a)
    upkeep(store, a)
    return store


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="quartier.streaming.serve")
    ap.add_argument("--source", choices=["kafka", "files", "events"], default="kafka")
    ap.add_argument("--bootstrap")
    ap.add_argument("--topic", help="Kafka topic (required for --source kafka)")
    ap.add_argument("--path", help="folder of text files, or of the events table")
    ap.add_argument("--out", required=True, help="shared folder of store and checkpoint")
    ap.add_argument("--id-parts", type=int, default=3)
    ap.add_argument("--interval", type=int, default=60, help="trigger (s)")
    ap.add_argument("--publish", type=int, default=300, help="seconds between publications")
    ap.add_argument("--delay", type=int, help="close minutes this many seconds after their end")
    ap.add_argument("--keep-days", type=int, help="retention of the published tables")
    ap.add_argument("--keep", type=int, default=3, help="manifests whose files stay")
    ap.add_argument("--max-files", type=int)
    ap.add_argument("--max-offsets", type=int)
    ap.add_argument("--available-now", action="store_true")
    return ap


def main(argv=None) -> int:
    a = parser().parse_args(argv)
    if a.source == "kafka" and not a.topic:
        raise SystemExit("--topic is required for --source kafka")
    serve(SparkSession.builder.appName("quartier-serve").getOrCreate(), a)
    return 0


if __name__ == "__main__":
    sys.exit(main())

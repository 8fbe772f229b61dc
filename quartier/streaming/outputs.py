"""One stream, every output.

Each micro-batch is read and parsed once and kept while its outputs are written:
landed lines, raw points, minute partials, pane counts, and the points of the
frequent-temperature windows that it touches. One commit file then makes all of
them count (see ``store.tables``); a replayed batch writes its own folder again,
and one that is committed already is left alone.

With ``delay`` windows close: a reading whose minute ended ``delay`` seconds
before the largest reading time of earlier batches is late. It goes to the
``late`` table (and still counts in all other outputs); every minute is written
to ``closed`` once, by the batch that moves the watermark past its end.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.parse import annotate
from ..functions.timefns import epoch_seconds, parse_duration
from ..operators import frequent as fq
from ..operators import rollup as ro
from ..operators.points import raw_points
from ..session import ensure_utc
from ..store.tables import Commit, Part, Store, keyed_panes, keyed_partials, with_day

_READING = ["time", "mun", "room_id", "data_id", "data", "voltage"]
_MINUTE = 60


@dataclass
class Outputs:
    """What the micro-batches of one checkpoint write to the store ``base``."""
    base: str
    run: str
    size: str = "1 hour"
    slide: str = "10 minutes"
    digits: int = 0
    delay: int | None = None
    id_parts: int = 3

    def write(self, lines: DataFrame, batch_id: int) -> None:
        """foreachBatch function over lines (column ``value``)."""
        store = Store(lines.sparkSession, self.base)
        if store.committed(self.run, batch_id):
            return
        parsed = annotate(lines.select("value"), id_parts=self.id_parts).select(
            "value", "reject", *_READING).persist()
        try:
            self._write(store, parsed, batch_id)
        finally:
            parsed.unpersist()

    def _write(self, store: Store, parsed: DataFrame, batch_id: int) -> None:
        readings = parsed.filter(F.col("reject").isNull()).select(*_READING)
        points = readings.filter(F.col("data_id").between(0, 3))
        # one row per metric and day of the batch
        parts = points.groupBy(ro.metric_name("data_id").alias("metric"),
                               F.to_date("time").alias("day")) \
                      .agg(F.max(epoch_seconds("time")).alias("last")).collect()
        c = Commit(store.next_seq(), self.run, batch_id, ["landing"],
                   sorted([r["metric"], r["day"].isoformat()] for r in parts),
                   max((r["last"] for r in parts), default=None))
        out = store.base
        dt = F.coalesce(F.date_format("time", "yyyy-MM-dd"), F.lit("unparsed"))
        (parsed.select("value", dt.alias("dt")).hint("rebalance", "dt")
         .write.mode("overwrite").partitionBy("dt").text(f"{out}/{c.path('landing')}"))
        if c.parts:
            def put(df: DataFrame, name: str) -> None:
                df.withColumn("seq", F.lit(c.seq).cast("long")).write.mode("overwrite") \
                    .parquet(f"{out}/{c.path(name)}")
                c.outputs.append(name)
            put(with_day(raw_points(points), "timestamp"), "raw")
            put(keyed_partials(ro.partials(points)), "partials")
            put(keyed_panes(fq.pane_counts(points, self.slide, self.digits)), "panes")
            self._frequent(store, c, put)
            if self.delay is not None:
                self._close(store, c, points, put)
        store.commit(c)

    # -- frequent temperatures ------------------------------------------------------

    def _frequent(self, store: Store, c: Commit, put) -> None:
        """Points of all windows that hold a pane of this batch, from the panes
        and temperatures of the days around them, whichever batch brought them."""
        size, slide = parse_duration(self.size), parse_duration(self.slide)
        days = [date.fromisoformat(d) for m, d in c.parts if m == "temperature"]
        if not days:
            return
        reach = -(-size // 86400)
        near = {("temperature", (d + timedelta(k)).isoformat())
                for d in days for k in range(-reach, reach + 1)}
        panes = _all_rows(store, c, "panes", near)
        own = store.batch_rows([c], "panes")
        starts = F.explode(F.transform(F.sequence(F.lit(0), F.lit(size // slide - 1)),
                                       lambda j: F.col("pane") - j * slide))
        touched = own.select("pane").distinct().select(starts.alias("ws")).distinct()
        counts = fq.window_counts(panes.groupBy("pane", "temperature").agg(F.sum("n").alias("n")),
                                  self.size, self.slide).join(touched, "ws", "left_semi")
        raw = _all_rows(store, c, "raw", near).select(
            F.col("timestamp").alias("es"), F.col("value").alias("data"),
            F.bround("value", self.digits).alias("temperature"))
        put(with_day(fq.winner_points(fq.top_k(counts, 1), raw, self.size, self.slide),
                     "timestamp"), "frequent")

    # -- closed windows and late rows ---------------------------------------------------

    def _close(self, store: Store, c: Commit, points: DataFrame, put) -> None:
        m, earlier = store.manifest(), store.commits()
        known = [x for x in [m.last, *(e.last for e in earlier)] if x is not None]
        before = max(known) - self.delay if known else None
        c.watermark = max([*known, c.last]) - self.delay
        end = epoch_seconds("time") - epoch_seconds("time") % _MINUTE + _MINUTE
        late = end <= before if before is not None else F.lit(False)
        points.filter(late).write.mode("overwrite").parquet(f"{store.base}/{c.path('late')}")
        c.outputs.append("late")
        put(keyed_partials(ro.partials(points.filter(~late))), "ontime")
        # minutes that end in (before, watermark]; only batches that reach so far hold them
        holders = [e for e in earlier if "ontime" in e.outputs
                   and (before is None or e.last > before - _MINUTE)] + [c]
        ends = epoch_seconds("bucket") + _MINUTE
        ripe = store.batch_rows(holders, "ontime").filter(ends <= c.watermark)
        if before is not None:
            ripe = ripe.filter(ends > before)
        put(keyed_partials(ro.merge_partials(ripe)), "closed")


def _all_rows(store: Store, c: Commit, table: str, parts: set[Part]) -> DataFrame:
    """Rows of some partitions: published ones, newer batches', and this one's."""
    m = store.manifest()
    return store.read(table, parts=parts, manifest=m).unionByName(
        store.batch_rows([*store.commits(m.merged), c], table, parts).drop("seq"))


def run_name(checkpoint: str) -> str:
    """Names a checkpoint: a new one on an old store replaces nothing."""
    return hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def start_outputs(lines: DataFrame, base: str, checkpoint: str, available_now: bool = True,
                  interval: str = "60 seconds", **options) -> StreamingQuery:
    """Every output of a stream of lines (column ``value``), from one read."""
    outputs = Outputs(base, run_name(checkpoint), **options)
    w = lines.writeStream.foreachBatch(outputs.write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


# -- readers of what batches have committed -----------------------------------------------

def landed_lines(store: Store) -> DataFrame:
    """(value, dt) of the landed lines of committed batches."""
    return store.lasting("landing").select("value", "dt")


def newest_windows(rows: DataFrame) -> DataFrame:
    """Of every window the points of the last batch that has computed it."""
    newest = rows.groupBy("window_start").agg(F.max("seq").alias("seq"))
    return rows.join(newest, ["window_start", "seq"]).drop("seq")


def live_points(store: Store) -> DataFrame:
    """Raw, roll-up and frequent points as of the last commit, published or not."""
    m = store.manifest()
    new = store.commits(m.merged)
    cols = ["metric", "timestamp", "value", "city", "municipality", "space", "aggregate"]
    raw = store.read("raw", manifest=m).unionByName(store.batch_rows(new, "raw").drop("seq"))
    parts = store.read("partials_1m", manifest=m).drop("version").unionByName(
        store.batch_rows(new, "partials").drop("seq"))
    return (raw.select(*cols)
            .unionByName(ro.datapoints(ro.rollup_partials(parts)).select(*cols))
            .unionByName(_as_points(live_frequent(store)).select(*cols)))


def live_frequent(store: Store) -> DataFrame:
    """Frequent points as of the last commit: window_start, metric, timestamp,
    value, city."""
    m = store.manifest()
    rows = store.read("frequent", manifest=m).withColumn("seq", F.lit(0).cast("long")).unionByName(
        store.batch_rows(store.commits(m.merged), "frequent"))
    return newest_windows(rows).select("window_start", "metric", "timestamp", "value", "city")


def _as_points(frequent: DataFrame) -> DataFrame:
    none = F.lit(None).cast("int")
    return frequent.select("metric", "timestamp", "value", "city", none.alias("municipality"),
                           none.alias("space"), F.lit("RAW").alias("aggregate"))


def open_partials(store: Store) -> DataFrame:
    """Partials of the minutes that no batch has closed yet."""
    commits = store.commits()
    mark = max((c.watermark for c in commits if c.watermark is not None), default=None)
    rows = store.batch_rows(commits, "ontime")
    if mark is not None:
        rows = rows.filter(epoch_seconds("bucket") + _MINUTE > mark)
    return keyed_partials(ro.merge_partials(rows))


def event_lines(events: DataFrame) -> DataFrame:
    """The events table's rows as lines, for ``start_outputs``."""
    from ..sources.fixtures import lines_from_events
    return lines_from_events(events).select("value")


def shared_store(spark: SparkSession, base: str) -> Store:
    ensure_utc(spark)
    return Store(spark, base)

"""The store: one read per trigger, commits, incremental publication, replay,
pruning, retention, late rows and the levels of the roll-up."""

import json
import os
import subprocess
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quartier.functions.parse import parse_lines
from quartier.operators import frequent as fq
from quartier.operators import points, rollup, stats, tsquery
from quartier.session import scratch_path
from quartier.sources import fixtures
from quartier.store import Store, publish, query, retire, store_last, store_query, vacuum
from quartier.streaming import jobs, outputs, serve

SF = "/root/testdata/sf0.001"


def same(a, b):
    b = b.select(*a.columns)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _line(t, room, data_id, value):
    return f"{t} {room % 19}-{room}-{data_id} {value} 1.0"


class Feed:
    """Text deliveries to one stream and its store."""

    def __init__(self, spark, **options):
        self.spark, self.options, self.n = spark, options, 0
        self.base = scratch_path(spark, "feed")
        os.makedirs(f"{self.base}/in")
        self.store = Store(spark, f"{self.base}/store")

    def deliver(self, lines):
        with open(f"{self.base}/in/d{self.n}.txt", "w") as f:
            f.write("\n".join(lines) + "\n")
        self.n += 1
        self.run()

    def run(self):
        q = outputs.start_outputs(jobs.line_stream(self.spark, f"{self.base}/in"),
                                  self.store.base, f"{self.base}/ckpt", **self.options)
        q.awaitTermination()
        return q

    def readings(self):
        return parse_lines(self.spark.read.text(f"{self.base}/in"))


FIRST = [_line(f"2024-01-01 {h:02}:00:{s:02}", 20 + s % 3, s % 4, h + s / 10)
         for h in range(10, 13) for s in range(0, 60, 7)]
LATE = [_line("2024-01-01 11:00:03", 21, 0, 99.5), _line("2024-01-02 00:00:00", 21, 0, 10.04)]


def test_batches_with_late_rows_and_publications(spark):
    feed = Feed(spark)
    feed.deliver(FIRST)
    publish(feed.store)
    feed.deliver(LATE)
    feed.deliver(["garbage", "", *LATE[:1]])
    for again in range(2):            # before and after the publication of the rest
        r = feed.readings()
        fp = fq.frequent_points(r)
        same(outputs.live_frequent(feed.store), fp)
        want = points.serving_union(points.raw_points(r), rollup.datapoints(rollup.rollup(r)),
                                    outputs._as_points(fp))
        same(outputs.live_points(feed.store), want)
        publish(feed.store)
    same(feed.store.read("rollup").select("bucket", "metric", "level", "aggregate", "value",
                                          "timestamp", "municipality", "space"),
         rollup.rollup(r))
    same(feed.store.read("frequent").drop("day"), fp)
    for table, unit in (("partials_1h", "hour"), ("partials_1d", "day")):
        same(rollup.rollup_partials(feed.store.read(table)), rollup.rollup(r, unit))
    assert outputs.landed_lines(feed.store).count() == len(FIRST) + len(LATE) + 3
    landed = {(x["value"], x["dt"]) for x in outputs.landed_lines(feed.store).collect()}
    assert ("garbage", "unparsed") in landed and (LATE[1], "2024-01-02") in landed


def test_only_touched_partitions_and_dirty_buckets_are_written(spark):
    feed = Feed(spark)
    days = [_line(f"2024-01-{d:02} {h}:10:00", 20, k, d + h) for d in (1, 2, 3)
            for h in (10, 11) for k in (0, 1)]
    feed.deliver(days)
    before = publish(feed.store)
    feed.deliver([_line("2024-01-02 11:30:00", 21, 0, 5.0)])
    after = publish(feed.store)
    changed = {t: {k for k in after.tables[t] if after.tables[t][k] != before.tables[t].get(k)}
               for t in after.tables}
    here = {"temperature/2024-01-02"}
    assert changed["raw"] == changed["partials_1m"] == changed["rollup"] == here
    assert changed["partials_1h"] == here
    assert changed["partials_1d"] == {"temperature/2024-01-01"}       # filed by month
    hours = {(r["metric"], r["bucket"]) for r in
             feed.store.read("partials_1h").filter(F.col("version") == after.merged).collect()}
    assert hours == {("temperature", datetime(2024, 1, 2, 11))}
    dirty = feed.store.read("partials_1d").filter(F.col("version") == after.merged).collect()
    assert {(r["metric"], r["bucket"]) for r in dirty} == {("temperature", datetime(2024, 1, 2))}
    same(rollup.rollup_partials(feed.store.read("partials_1d")), rollup.rollup(feed.readings(), "day"))
    assert publish(feed.store) == after                                # nothing new


def test_replayed_batch_and_broken_publication(spark, monkeypatch):
    feed = Feed(spark)
    feed.deliver(FIRST)
    out = outputs.Outputs(feed.store.base, outputs.run_name(f"{feed.base}/ckpt"))
    lines = spark.read.text(f"{feed.base}/in")
    out.write(lines, 0)                      # committed already: left alone
    assert len(feed.store.commits()) == 1
    # a batch that died before its commit is written again, once
    out.write(spark.createDataFrame([(x,) for x in LATE], "value string"), 1)
    feed.store.files.delete(f"commits/{feed.store.files.names('commits')[-1]}")
    same(outputs.live_frequent(feed.store), fq.frequent_points(feed.readings()))
    assert outputs.landed_lines(feed.store).count() == len(FIRST)
    out.write(spark.createDataFrame([(x,) for x in LATE], "value string"), 1)
    # a publication that dies before its manifest changes nothing
    monkeypatch.setattr(Store, "put", lambda self, m: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        publish(feed.store)
    monkeypatch.undo()
    assert feed.store.read("rollup").count() == 0
    m = publish(feed.store)
    everything = parse_lines(lines.unionByName(spark.createDataFrame([(x,) for x in LATE],
                                                                     "value string")))
    same(feed.store.read("rollup").select("bucket", "metric", "level", "aggregate", "value",
                                          "space"), rollup.rollup(everything))
    out.write(lines, 0)                      # also known after the publication
    vacuum(feed.store, keep=1)
    out.write(lines, 0)
    assert not feed.store.commits(m.merged) and feed.store.next_seq() == m.merged + 1
    # the number of a manifest is taken once
    with pytest.raises(FileExistsError):
        feed.store.put(m)
    same(feed.store.read("raw").select("metric", "timestamp", "value", "space"),
         points.raw_points(everything))


def test_raw_partitions_are_compacted(spark, monkeypatch):
    monkeypatch.setattr(sys.modules["quartier.store.publish"], "MAX_FOLDERS", 2)
    feed = Feed(spark)
    for i in range(4):
        feed.deliver([_line(f"2024-01-01 10:00:{i:02}", 20, 0, i)])
        publish(feed.store)
    folders = feed.store.manifest().tables["raw"]["temperature/2024-01-01"]
    assert len(folders) == 2
    assert feed.store.read("raw").count() == 4


def test_retention_drops_partitions_and_keeps_readers(spark):
    feed = Feed(spark)
    lines = [_line(f"2024-01-{d:02} {h}:10:00", 20, 0, d + h) for d in range(1, 11)
             for h in (0, 10, 23)]
    feed.deliver(lines)
    old = publish(feed.store)
    reader = feed.store.read("raw", manifest=old)
    retire(feed.store, days=4)              # now: 2024-01-10 23:10
    cut = datetime(2024, 1, 6, 23, 10)
    want = points.raw_points(feed.readings().filter(F.col("time") >= F.lit(cut)))
    same(feed.store.read("raw").select("metric", "timestamp", "value", "space"), want)
    same(feed.store.read("rollup").select("bucket", "metric", "level", "aggregate", "value"),
         rollup.rollup(feed.readings()).filter(F.col("bucket") >= F.lit(cut).cast("timestamp_ntz")))
    assert reader.count() == len(lines)     # its files are still there
    vacuum(feed.store, keep=1)
    root = f"{feed.store.base}/tables/raw"
    days = {d for _, dirs, _ in os.walk(root) for d in dirs if d.startswith("day=")}
    assert days == {f"day=2024-01-{d:02}" for d in range(6, 11)}
    same(feed.store.read("raw").select("metric", "timestamp", "value", "space"), want)
    feed.deliver([_line("2024-01-11 00:00:00", 20, 0, 1.0)])
    publish(feed.store)
    assert feed.store.read("raw").count() == want.count() + 1


def test_late_rows_and_closed_minutes(spark):
    feed = Feed(spark, delay=600)
    feed.deliver([_line(f"2024-01-01 10:{m:02}:00", 20, 0, m) for m in range(0, 30)])
    # the watermark is at 10:19: minutes up to 10:18 are closed
    feed.deliver([_line("2024-01-01 10:18:30", 21, 0, 1.0), _line("2024-01-01 10:19:30", 21, 0, 2.0),
                  _line("2024-01-01 10:45:00", 20, 0, 3.0)])
    feed.deliver([_line("2024-01-01 10:34:59", 21, 0, 4.0), _line("2024-01-01 10:35:00", 21, 0, 5.0)])
    late = feed.store.lasting("late").orderBy("time").collect()
    assert [(r["data"], r["batch_id"]) for r in late] == [(1.0, 1), (4.0, 2)]
    closed = feed.store.lasting("closed")
    assert closed.groupBy("bucket", "data_id", "mun", "room_id").count() \
        .filter("count > 1").count() == 0
    assert closed.agg(F.max("bucket")).first()[0] == datetime(2024, 1, 1, 10, 29)
    by = {(r["bucket"].minute, r["room_id"]): r["batch_id"] for r in closed.collect()}
    assert by[18, 20] == 0 and by[19, 20] == by[19, 21] == 1
    parts = (closed.drop("run", "batch_id").unionByName(outputs.open_partials(feed.store)
                                                       .select(*closed.drop("run", "batch_id").columns)))
    extra = rollup.partials(feed.store.lasting("late").drop("run", "batch_id"))
    both = parts.select(*extra.columns).unionByName(extra)
    same(rollup.rollup_partials(both), rollup.rollup(feed.readings()))
    publish(feed.store)
    vacuum(feed.store, keep=1)
    assert feed.store.lasting("late").count() == 2      # kept for good
    feed.deliver([_line("2024-01-01 10:35:30", 21, 0, 6.0), _line("2024-01-01 11:30:00", 21, 0, 7.0)])
    assert feed.store.lasting("closed").filter("room_id = 21 and bucket = '2024-01-01 10:35:00'") \
        .select("c").first()[0] == 2                    # open minutes outlive the vacuum


@pytest.fixture(scope="module")
def store(spark):
    base = scratch_path(spark, "store-q")
    q = outputs.start_outputs(outputs.event_lines(jobs.event_stream(spark, SF)), f"{base}/store",
                              f"{base}/ckpt")
    q.awaitTermination()
    # the source was read once, for all outputs
    assert sum(p["numInputRows"] for p in q.recentProgress) == fixtures.events(spark, SF).count()
    s = Store(spark, f"{base}/store")
    publish(s)
    return s


def test_queries_equal_those_over_raw_points(spark, store):
    raw = points.raw_points(fixtures.readings(spark, SF))
    for width, ds, table in [("1 day", "sum", "partials_1d"), ("2 hours", "avg", "partials_1h"),
                             ("1 hour", "min", "partials_1h"), ("5 minutes", "max", "partials_1m"),
                             ("1 minute", "count", "partials_1m"), ("30 s", "sum", "raw"),
                             ("1 day", "dev", "raw"), ("1 day", "first", "raw"),
                             ("1 hour", "last", "raw")]:
        assert query.resolve(None, width, ds) == table
        for agg in ("sum", "min", "max", "avg", "count", "dev", "first", "last"):
            args = {"group_by": ["municipality"], "downsample": width, "ds_agg": ds,
                    "aggregator": agg}
            a = store_query(store, "temperature", **args)
            b = tsquery.tsquery(raw, "temperature", **args)
            if agg in ("sum", "max"):
                same(a, b)
            else:
                assert a.count() == b.count()
    f = {"municipality": "literal_or(3|4)", "_aggregate": "RAW"}
    lo, hi = 1704672000, 1705276799
    args = {"filters": f, "downsample": "1 hour", "ds_agg": "avg", "aggregator": "max",
            "start": lo, "end": hi}
    assert query.resolve(f, "1 hour", "avg", lo, hi) == "partials_1h"
    assert query.resolve(f, "1 hour", "avg", lo + 1, hi) == "raw"
    assert query.resolve({"_aggregate": "*"}, "1 hour", "avg") == "rollup"
    assert query.resolve({"_aggregate": "iliteral_or(max)"}, "1 hour", "avg") == "rollup"
    same(store_query(store, "temperature", **args), tsquery.tsquery(raw, "temperature", **args))
    args["start"] += 1
    same(store_query(store, "temperature", **args), tsquery.tsquery(raw, "temperature", **args))
    assert store_query(store, "occurence.temperature", downsample="1 hour").count() > 0
    assert store_query(store, "temperature", start=0, end=10).count() == 0


def _scan(df):
    """(partition filters, pushed filters, rows read) of the plan's point scans."""
    df.collect()
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    part = [x for x in text.splitlines() if "PartitionFilters" in x]
    pushed = [x for x in text.splitlines() if "PushedFilters" in x]
    return part, pushed


def _rows_read(df):
    """Rows that the files' scan gave, from the executed plan's own metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    todo, total = [plan], 0
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if "QueryStage" in name:
            todo.append(p.plan())
            continue
        if name.startswith("Scan parquet"):
            total += p.metrics().apply("numOutputRows").value()
        it = p.children().iterator()
        while it.hasNext():
            todo.append(it.next())
    return total


def test_plans_prune_partitions(spark, store):
    q = store_query(store, "humidity", group_by=["space"], downsample="1 hour", ds_agg="sum",
                    start=1704672000, end=1704758399)
    part, _ = _scan(q)
    assert part and all("metric" in p and "day" in p for p in part)
    hours = rollup.rollup(fixtures.readings(spark, SF), "hour", ["COUNT"], ["space"])
    need = hours.filter("metric = 'humidity' and to_date(bucket) = date'2024-01-08'").count()
    assert _rows_read(q) == need


def test_last_x_reads_what_it_needs(spark, store):
    r = fixtures.readings(spark, SF)
    for n, unit in [(20, "days"), (7, "days"), (5, "hours"), (1, "months")]:
        got = store_last(store, n, unit)
        same(got, stats.stats_last(r, n, unit))
        _, pushed = _scan(got)
        assert all("GreaterThan(timestamp" in p for p in pushed)
        first = query._utc_day(query._before(store, store.manifest().last, n, unit))
        days = r.filter(F.to_date("time") >= F.lit(first)).count()
        assert _rows_read(got) <= days
        if n == 20:
            assert _rows_read(got) <= 1.1 * stats.last_period(r, n, unit).count()
    one = store_last(store, 7, "days", metric="temperature", where=F.col("room_id") == 10)
    want = stats.space_stats(stats.last_period(r, 7, "days").filter("data_id = 0 and room_id = 10"))
    same(one, want)


def test_one_source_scan_per_trigger_in_the_event_log(spark):
    """A run of its own: the source's scans give every line once in all, however
    many outputs are written."""
    base = scratch_path(spark, "eventlog")
    os.makedirs(f"{base}/log")
    lines = fixtures.lines_from_events(fixtures.events(spark, SF)).select("value")
    for _ in range(2):
        lines.coalesce(1).write.mode("append").text(f"{base}/in")
    code = f'''
import sys
sys.path.insert(0, {os.getcwd()!r})
from quartier.session import get_session
spark = get_session("local[2]", shuffle_partitions=2, extra={{
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://{base}/log",
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
    "spark.checkpoint.dir": {base!r}}})
from quartier.streaming import jobs, outputs
q = outputs.start_outputs(jobs.line_stream(spark, "{base}/in", max_files=1), "{base}/store",
                          "{base}/ckpt", delay=60)
q.awaitTermination()
print("batches", len(q.recentProgress))
spark.stop()
'''
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "batches 2" in run.stdout, run.stderr[-2000:]
    ids, rows = set(), 0

    def scans(node):
        if node["nodeName"].startswith("Scan text"):
            ids.update(m["accumulatorId"] for m in node["metrics"]
                       if m["name"] == "number of output rows")
        for child in node["children"]:
            scans(child)

    events = [json.loads(x) for n in os.listdir(f"{base}/log") for x in open(f"{base}/log/{n}")]
    for e in events:
        if "sparkPlanInfo" in e:
            scans(e["sparkPlanInfo"])
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd":
            rows += sum(int(x["Update"]) for x in e["Task Info"]["Accumulables"] if x["ID"] in ids)
    assert ids and rows == 2 * lines.count()


def test_served_stream_of_kafka_records(spark):
    """Records as the Kafka source gives them, several triggers, upkeep between."""
    base = scratch_path(spark, "serve")
    lines = fixtures.lines_from_events(fixtures.events(spark, SF))
    recs = lines.select(F.col("event_id").cast("string").cast("binary").alias("key"),
                        F.col("value").cast("binary").alias("value"), "event_id")
    for i in range(3):
        recs.filter(F.col("event_id") % 3 == i).drop("event_id").coalesce(1) \
            .write.mode("append").parquet(base + "/topic")
    stream = (spark.readStream.schema("key binary, value binary").option("maxFilesPerTrigger", 1)
              .parquet(base + "/topic"))
    a = serve.parser().parse_args(["--topic", "t", "--out", base, "--available-now",
                                   "--publish", "2", "--keep-days", "3650"])
    store = serve.serve(spark, a, jobs.kafka_values(stream))
    r = fixtures.readings(spark, SF)
    same(store.read("rollup").select("bucket", "metric", "level", "aggregate", "value", "space"),
         rollup.rollup(r))
    same(store.points(["raw"]), points.raw_points(r))
    assert outputs.landed_lines(store).count() == fixtures.events(spark, SF).count()


def test_serve_reads_text_files_and_events(spark):
    base = scratch_path(spark, "serve-files")
    fixtures.lines_from_events(fixtures.events(spark, SF)).select("value").write.text(base + "/in")
    want = rollup.rollup(fixtures.readings(spark, SF)).count()
    for source, path in (("files", base + "/in"), ("events", SF)):
        assert serve.main(["--source", source, "--path", path, "--out", f"{base}/{source}",
                           "--available-now"]) == 0
        assert Store(spark, f"{base}/{source}/store").read("rollup").count() == want


def test_stream_without_rows(spark):
    feed = Feed(spark)
    assert feed.store.points().count() == 0 and outputs.landed_lines(feed.store).count() == 0
    feed.deliver(["nothing to parse"])
    m = publish(feed.store)
    assert m.merged == 1 and m.tables == {} and retire(feed.store, 1) == m
    assert feed.store.read("raw", "temperature", date(2024, 1, 1)).count() == 0
    assert store_last(feed.store, 1, "days").count() == 0

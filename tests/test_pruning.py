"""Sums without a sort, distributed grids, bounded requests, positions in an order
and one rule for NaN."""

import json
import random
from datetime import datetime

from pyspark.sql import functions as F

from quartier.operators import carpet, ordering, points, rollup
from quartier.session import scratch_path
from quartier.sources import fixtures

SF = "/root/testdata/sf0.001"


def same(a, b):
    b = b.select(*a.columns)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_totals_equal_the_full_roll_up(make_readings):
    r = random.Random(3)
    rows = [(f"2024-01-01 {r.randrange(3):02}:{r.randrange(3):02}:{r.randrange(60):02}"
             f".{r.choice(['000000', '500000', '999999'])}",
             r.randrange(3), r.choice([-2 ** 31 + 1, -7, 0, 5, 2 ** 31 - 1]), r.randrange(4),
             r.choice([1.5, -2.25, 1e300, float("nan")])) for _ in range(400)]
    # a room has one municipality, so that the earliest row's is one value
    rows = [(t, abs(room) % 3, room, d, v) for t, _, room, d, v in rows]
    df = make_readings(rows)
    for bucket in ("1 minute", "15 minutes", "hour", "1 hour"):
        got = rollup.rollup(df, bucket, ["SUM", "COUNT"])
        want = rollup.rollup_partials(rollup.partials(df, bucket)).filter("aggregate in ('SUM', 'COUNT')")
        same(got, want)
    assert not rollup._packs("day") and not rollup._packs("2 hours") and rollup._packs("30 s")
    same(rollup.rollup(df, "day", ["SUM"]),
         rollup.rollup(df, "day").filter("aggregate = 'SUM'"))
    assert rollup.rollup(df.limit(0), ops=["COUNT"]).count() == 0


def test_minute_grid_of_ten_years_is_dealt_out(spark):
    s = spark.createDataFrame([(datetime(2014, 1, 1, 12), 1.0, 1), (datetime(2023, 12, 31, 23, 59), 2.0, 2)],
                              "ts timestamp, value double, seq long")
    c = carpet.carpet(s, "MINUTE", "SUM")
    assert "Range (0, 3652, step=1, splits=" in c._jdf.queryExecution().toString()
    assert "splits=1)" not in c._jdf.queryExecution().toString()
    agg = c.agg(F.count(F.lit(1)), F.count("value"), F.min("day"), F.max("slot_start")).first()
    assert agg[0] == 3652 * 1440 and agg[1] == 2
    assert agg[3] == datetime(2023, 12, 31, 23, 59)
    assert carpet.carpet(s.limit(0)).count() == 0
    fixed = carpet.carpet(s, "HOUR", "SUM", start="2014-01-01", end="2014-01-02T05:00:00", ordered=True)
    rows = fixed.collect()
    assert len(rows) == 48 and rows == sorted(rows, key=lambda r: r["slot_start"])


def test_nan_in_a_cell(spark):
    nan = float("nan")
    s = spark.createDataFrame([(datetime(2024, 1, 1, 1), 5.0, 1), (datetime(2024, 1, 1, 1, 1), nan, 2),
                               (datetime(2024, 1, 1, 2), nan, 3), (datetime(2024, 1, 1, 3), None, 4)],
                              "ts timestamp, value double, seq long")
    for kind in ("MAX", "MIN"):
        cells = {r["slot"]: r["value"] for r in carpet.carpet(s, "HOUR", kind).collect()}
        assert cells[1] == 5.0 and cells[2] != cells[2] and cells[3] is None
        st = carpet.carpet_stats(carpet.carpet(s, "HOUR", kind)).first()
        assert (st["min_value"], st["max_value"], st["filled"]) == (5.0, 5.0, 2)
        pos = carpet.carpet_scaled(carpet.carpet(s, "HOUR", kind), fixed_min=0.0).collect()
        assert [r["position"] for r in pos if r["slot"] == 1] == [1.0]


def test_requests_are_bounded_and_whole(spark):
    pts = points.raw_points(fixtures.readings(spark, SF))
    for df in (pts.coalesce(1), pts.repartition(7), pts.limit(0), pts.limit(101).coalesce(1)):
        b = points.to_batches(df).collect()
        assert all(len(json.loads(r["value"])) == r["n"] <= 50 for r in b)
        assert sum(r["n"] for r in b) == df.count()
        back = points.read_batches(points.to_batches(df)).drop("tag_keys")
        assert back.count() == df.count()
    same(points.read_batches(points.to_batches(pts.repartition(3))).drop("tag_keys"),
         pts.select(*points.POINT_COLUMNS))


def test_row_index(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(6)
    rows = ordering.with_row_index(df, ["k"], scratch_path(spark, "index")).collect()
    assert sorted((r["row_index"], r["k"]) for r in rows) == [(i, i) for i in range(1000)]
    assert ordering.with_row_index(df.limit(0), ["k"], scratch_path(spark, "index")).count() == 0

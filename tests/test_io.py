"""Sources, sinks and predicate helpers."""

import json
import os
from datetime import datetime

from pyspark.sql import functions as F

from quartier.operators import points, ranges
from quartier.session import scratch_path
from quartier.sources import dims, series, sinks


def test_document_tags_per_level(spark):
    p = spark.createDataFrame(
        [("temperature", 10, 1.5, "Brussels", None, None, "MAX"),
         ("temperature", 10, 1.5, "Brussels", 3, None, "SUM"),
         ("temperature", 10, 1.5, "Brussels", 3, 7, "RAW")],
        "metric string, timestamp long, value double, city string, municipality int, "
        "space int, aggregate string")
    docs = [json.loads(r["value"]) for r in points.to_document(p).collect()]
    assert docs[0] == {"metric": "temperature", "timestamp": 10, "value": 1.5,
                       "tags": {"city": "Brussels"}, "groupByAggregator": "MAX"}
    assert docs[1]["tags"] == {"city": "Brussels", "municipality": 3}
    assert docs[2]["tags"] == {"city": "Brussels", "municipality": 3, "space": 7}
    assert "groupByAggregator" not in docs[2]


def test_dimension_file_readers_match_fixed_tables(spark):
    base = scratch_path(spark, "dims")
    os.makedirs(base)
    with open(f"{base}/locs.txt", "w") as f:
        f.write(dims.SPACE_COORDINATES.strip() + "\n")
    with open(f"{base}/munis.txt", "w") as f:
        f.write(dims.ROOM_MUNICIPALITIES.strip().replace("1,Bruxelles-Ville", "1,Bruxelles-Ville ", 1) + "\n")
    with open(f"{base}/mun.json", "w") as f:
        f.write("{\n" + ",\n".join(dims.MUNICIPALITY_NAMES.strip().splitlines()) + "\n}\n")
    s = dims.read_space_file(spark, f"{base}/locs.txt")
    assert s.exceptAll(dims.space_dim(spark)).count() == 0 and s.count() == 54
    m = dims.read_room_municipality_file(spark, f"{base}/munis.txt")
    assert m.exceptAll(dims.room_municipality_dim(spark)).count() == 0 and m.count() == 54
    j = dims.read_municipality_lookup(spark, f"{base}/mun.json")
    assert j.exceptAll(dims.municipality_dim(spark)).count() == 0 and j.count() == 19


def test_series_readers(spark):
    base = scratch_path(spark, "series")
    os.makedirs(base)
    with open(f"{base}/a.tsv", "w") as f:
        f.write("1704067200\t3\n1704067260\tabc\nxx\t4\n")
    with open(f"{base}/a.json", "w") as f:
        f.write('{"1704067200": 3, "1704070800": 5.5}\n')
    t = series.read_series(spark, f"{base}/a.tsv", "tsv").collect()
    assert [(r["ts"], r["value"]) for r in t] == [(datetime(2024, 1, 1), 3.0)]
    j = sorted((r["ts"], r["value"]) for r in series.read_series(spark, f"{base}/a.json", "json").collect())
    assert j == [(datetime(2024, 1, 1), 3.0), (datetime(2024, 1, 1, 1), 5.5)]


def test_avro_defaults_and_threshold_list(spark):
    df = spark.createDataFrame([(5, None)], "room_id int, data double")
    r = series.with_avro_defaults(df).collect()[0]
    assert (r["room_id"], r["data_id"], r["data"], r["voltage"]) == (5, -1, -999.0, -999.0)
    got = spark.range(1).select(series.parse_threshold_list(F.lit(" 10, 20,30 "))).collect()[0][0]
    assert got == [10.0, 20.0, 30.0]


def test_points_sink_partitions(spark):
    base = scratch_path(spark, "sink")
    p = spark.createDataFrame([("light", 1704067200, 2.0, "Brussels", 1, 2, "RAW")],
                              "metric string, timestamp long, value double, city string, "
                              "municipality int, space int, aggregate string")
    sinks.write_points(p, base, "raw", mode="overwrite")
    assert os.path.isdir(f"{base}/raw/metric=light/day=2024-01-01")
    sinks.write_points(p, base, "jsondocs", mode="overwrite", fmt="json")
    assert os.path.isdir(f"{base}/jsondocs/day=2024-01-01")
    back = sinks.read_points(spark, base, kinds=("raw",)).collect()
    assert back[0]["value"] == 2.0


def test_range_helpers(make_readings):
    r = make_readings([("2024-01-01 10:00:05", 1, 20, 0, 1.0), ("2024-01-01 11:00:05", 2, 21, 0, 2.0),
                       ("2024-01-02 23:00:00", 1, 22, 0, 3.0)])
    assert ranges.space_filter(r, "municipality", 1).count() == 2
    assert ranges.space_filter(r, "space", 21).count() == 1
    assert ranges.space_filter(r, "city").count() == 3
    lo, hi = ranges.day_aligned_range(datetime(2024, 1, 1, 15), datetime(2024, 1, 1, 9))
    assert ranges.in_range(r, lo, hi).count() == 2
    assert ranges.drill_down(r, datetime(2024, 1, 1, 10), "hour").count() == 1
    assert ranges.drill_down(r, datetime(2024, 1, 1), "day").count() == 2


def test_tsquery_prunes_point_partitions(spark):
    from quartier.operators import tsquery
    base = scratch_path(spark, "prune")
    rows = [("light", 1704067200 + d * 86400 + 60, float(d), "Brussels", 1, 2, "RAW")
            for d in range(5)]
    rows += [("humidity", 1704067200 + 60, 9.0, "Brussels", 1, 2, "RAW")]
    p = spark.createDataFrame(rows, "metric string, timestamp long, value double, city string, "
                                    "municipality int, space int, aggregate string")
    sinks.write_points(p, base, "raw", mode="overwrite")
    store = sinks.read_points(spark, base, kinds=("raw",), with_day=True)
    q = tsquery.tsquery(store, "light", start=1704067200 + 86400, end=1704067200 + 2 * 86400 + 3600)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(metric" in plan and "day#" in plan.split("PartitionFilters")[1]
    assert sorted(r["value"] for r in q.collect()) == [1.0, 2.0]


def test_carpet_ordered_output(spark):
    from quartier.operators import carpet as cp
    s = spark.createDataFrame([(datetime(2024, 1, 2, 5), 1.0, 1), (datetime(2024, 1, 1, 3), 2.0, 2)],
                              "ts timestamp, value double, seq long")
    got = [r["slot_start"] for r in cp.carpet(s, "HOUR", "AVG", ordered=True).collect()]
    assert got == sorted(got) and len(got) == 48

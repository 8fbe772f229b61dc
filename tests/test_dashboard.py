"""Carpet, calendar and metric-query operators on hand-made edge tables."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from quartier.operators import calendar as cal
from quartier.operators import carpet as cp
from quartier.operators import tsquery as tq


def series(spark, rows):
    return spark.createDataFrame(
        [(datetime.fromisoformat(t) if isinstance(t, str) else t, float(v), i)
         for i, (t, v) in enumerate(rows)], "ts timestamp, value double, seq long")


def test_carpet_gaps_keep_all_days(spark):
    s = series(spark, [("2024-01-01 10:07:00", 1.0), ("2024-01-04 23:59:00", 3.0)])
    cells = cp.carpet(s, "HOUR", "CNT").collect()
    assert len(cells) == 4 * 24                       # final day included (fix)
    filled = [c for c in cells if c["value"] is not None]
    assert {(c["day"], c["slot"], c["value"]) for c in filled} == {
        (date(2024, 1, 1), 10, 1), (date(2024, 1, 4), 23, 1)}


def test_carpet_first_last_and_stats(spark):
    s = series(spark, [("2024-01-01 10:01:00", 5.0), ("2024-01-01 10:02:00", -7.0),
                       ("2024-01-01 10:02:00", -1.0)])
    first = [c for c in cp.carpet(s, "HOUR", "FIRST").collect() if c["value"] is not None]
    last = [c for c in cp.carpet(s, "HOUR", "LAST").collect() if c["value"] is not None]
    assert first[0]["value"] == 5.0 and last[0]["value"] == -1.0
    st = cp.carpet_stats(cp.carpet(s, "MINUTE", "SUM")).collect()[0]
    assert (st["min_value"], st["max_value"]) == (-8.0, 5.0)
    neg = series(spark, [("2024-01-01 10:01:00", -5.0), ("2024-01-01 11:01:00", -2.0)])
    assert cp.carpet_stats(cp.carpet(neg, "HOUR", "AVG")).collect()[0]["max_value"] == -2.0


def test_calendar_dupes_last_write_wins(spark):
    s = series(spark, [("2024-01-01 10:00:00", 1.0), ("2024-01-01 10:00:00", 4.0),
                       ("2024-01-01 10:30:00", 2.0)])
    cells = cal.calendar_cells(s, "day", "hour").collect()
    v = {c["cell_start"]: c["value"] for c in cells if c["value"] is not None}
    assert v == {datetime(2024, 1, 1, 10): 6.0}
    assert len(cells) == 24


def test_calendar_month_week_and_missing_as_zero(spark):
    s = series(spark, [("2024-01-31 10:00:00", 1.0), ("2024-02-01 10:00:00", 2.0)])
    cells = cal.calendar_cells(s, "month", "week", missing_as_zero=True).collect()
    jan = [c for c in cells if c["domain_start"] == datetime(2024, 1, 1)]
    assert min(c["cell_start"] for c in jan) == datetime(2024, 1, 1)   # a Monday
    assert len(jan) == 5
    assert all(c["value"] is not None for c in cells)
    feb = {c["cell_start"]: c["value"] for c in cells if c["domain_start"] == datetime(2024, 2, 1)}
    assert feb[datetime(2024, 1, 29)] == 2.0                   # week starting in January


def _js_thresholds(data, cell_of):
    cells = {}
    for t, v in data:
        cells[cell_of(t)] = cells.get(cell_of(t), 0) + v
    vals = list(cells.values())
    c, s, ss = len(vals), sum(vals), sum(v * v for v in vals)
    avg = s / c
    sd = ((ss - avg * avg) / c) ** 0.5
    lo, hi = max(min(vals), avg - sd * 1.5), min(max(vals), avg + sd * 1.5)
    return [lo + (hi - lo) / 8 * i for i in range(9)]


def test_thresholds_and_classes_brute_force(spark):
    base = datetime(2024, 1, 1)
    data = [(base + timedelta(minutes=37 * i), float((i * 7) % 11) - 2) for i in range(200)]
    s = series(spark, data)
    got = [r["threshold"] for r in cal.thresholds(s, "hour").orderBy("i").collect()]
    want = _js_thresholds(data, lambda t: t.replace(minute=0, second=0))
    assert all(abs(a - b) < 1e-9 for a, b in zip(got, want))
    cells = cal.calendar_cells(s, "day", "hour")
    for r in cal.classify(cells, cal.thresholds(s, "hour")).collect():
        v = r["value"]
        if v is None:
            assert r["class"] is None
            continue
        if want[0] > 0 and v < 0:
            exp = 1
        else:
            exp = next((i + 1 for i, c in enumerate(want) if v <= c), len(want) + 1)
        assert r["class"] == exp
        assert r["bin"] == sum(1 for c in want if c <= min(v, want[-1]))
        assert r["zero"] == (v == 0)


def test_week_numbers_match_strftime(spark):
    from quartier.functions import timefns as tf
    days = [date(2023, 12, 24) + timedelta(days=i) for i in range(0, 800, 3)]
    days += [date(2024, 2, 29), date(2023, 12, 31), date(2024, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for r in df.select("d", tf.week_of_year_monday("d").alias("w"),
                       tf.week_of_year_sunday("d").alias("u"),
                       tf.days_in_month("d").alias("dim"), tf.is_leap_year("d").alias("leap")
                       ).collect():
        d = r["d"]
        assert r["w"] == int(d.strftime("%W")) and r["u"] == int(d.strftime("%U"))
        nxt = (d.replace(day=28) + timedelta(days=4)).replace(day=1)
        assert r["dim"] == (nxt - timedelta(days=1)).day
        assert r["leap"] == (d.year % 4 == 0 and (d.year % 100 != 0 or d.year % 400 == 0))


def test_auto_domain(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), datetime(2024, 1, 1, 20)),
                                (datetime(2024, 1, 1), datetime(2024, 1, 5)),
                                (datetime(2024, 1, 1), datetime(2024, 3, 5))], "a timestamp, b timestamp")
    days, dom = cal.auto_domain(F.col("a"), F.col("b"))
    got = [(r[0], r[1]) for r in df.select(days, dom).collect()]
    assert got == [(1, "hour"), (5, "day"), (65, "month")]


def test_tag_filters_and_aggregators(spark):
    store = spark.createDataFrame(
        [("t", 60, 1.0, "Brussels", 1, 5, "RAW"), ("t", 70, 3.0, "Brussels", 1, 6, "RAW"),
         ("t", 65, 10.0, "Brussels", 2, 7, "RAW"), ("t", 61, 99.0, "Brussels", None, None, "MAX"),
         ("h", 60, 5.0, "Brussels", 1, 5, "RAW")],
        "metric string, timestamp long, value double, city string, municipality int, "
        "space int, aggregate string")
    out = tq.tsquery(store, "t", {"_aggregate": "RAW", "municipality": "iliteral_or(1|2)"},
                     group_by=["municipality"], downsample="1 minute", ds_agg="avg",
                     aggregator="sum").collect()
    assert {(r["municipality"], r["value"]) for r in out} == {(1, 4.0), (2, 10.0)}
    out = tq.tsquery(store, "t", {"city": "iliteral_or(BRUSSELS)"}, downsample="1 minute",
                     ds_agg="max", aggregator="max").collect()
    assert [r["value"] for r in out] == [99.0]
    out = tq.tsquery(store, "t", {"city": "literal_or(brussels)"}).collect()
    assert out == []


def test_negative_value_with_positive_cuts_is_class_one_overflow(spark):
    cells = spark.createDataFrame([(datetime(2024, 1, 1), datetime(2024, 1, 1), -3.0),
                                   (datetime(2024, 1, 1), datetime(2024, 1, 1, 1), 0.0),
                                   (datetime(2024, 1, 1), datetime(2024, 1, 1, 2), 50.0),
                                   (datetime(2024, 1, 1), datetime(2024, 1, 1, 3), None)],
                                  "domain_start timestamp, cell_start timestamp, value double")
    cuts = spark.createDataFrame([(i, 10.0 * (i + 1)) for i in range(9)], "i int, threshold double")
    got = {r["cell_start"].hour: (r["class"], r["overflow"], r["zero"], r["bin"])
           for r in cal.classify(cells, cuts).collect()}
    assert got[0] == (1, True, False, 0)
    assert got[1] == (1, False, True, 0)
    assert got[2] == (5, False, False, 5)      # 50 <= cut[4] = 50
    assert got[3] == (None, None, None, None)


def test_calendar_ordered_output(spark):
    s = series(spark, [("2024-01-03 10:00:00", 1.0), ("2024-01-01 05:00:00", 2.0)])
    got = [(r["domain_start"], r["cell_start"]) for r in
           cal.calendar_cells(s, "day", "hour", ordered=True).collect()]
    assert got == sorted(got) and len(got) == 3 * 24


def test_tag_filter_syntax_and_table_selection(spark):
    df = spark.createDataFrame([("Brussels", 1), ("Bruges", 2), ("Gent", 3)], "city string, municipality int")
    pick = lambda spec: sorted(r["city"] for r in df.filter(tq.tag_predicate("city", spec)).collect())
    assert pick("wildcard(Bru*)") == ["Bruges", "Brussels"]
    assert pick("iwildcard(bru*)") == ["Bruges", "Brussels"]
    assert pick("*") == ["Bruges", "Brussels", "Gent"]
    assert pick("literal_or(Gent|Bruges)") == ["Bruges", "Gent"]
    assert pick("Gent") == ["Gent"]
    assert tq.aggregate_values(None) is None
    assert tq.aggregate_values({"_aggregate": "iliteral_or(max|raw)"}) == {"MAX", "RAW"}
    assert tq.aggregate_values({"_aggregate": "SUM"}) == {"SUM"}
    assert tq.aggregate_values({"_aggregate": "*"}) is None

"""Query 3: frequent temperatures (windowed and per-batch modes)."""

from datetime import datetime, timedelta

from quartier.operators import frequent as fq


def test_two_batches_modes_differ(make_readings):
    # value A (20) five times in one 10 s batch; value B (30) three times in each of two batches
    base = datetime(2024, 1, 1, 12, 0, 0)
    rows = [(base + timedelta(seconds=1 + i), 0, 1, 0, 20.0) for i in range(5)]
    rows += [(base + timedelta(seconds=20 + i), 0, 1, 0, 30.0) for i in range(3)]
    rows += [(base + timedelta(seconds=30 + i), 0, 1, 0, 30.0) for i in range(3)]
    r = make_readings(rows)
    per_batch = {row["window_start"]: row for row in fq.frequent_per_batch(r).collect()}
    # the 60 s window starting at 12:00:00 holds all three batches: largest single batch is A
    w = per_batch[base]
    assert (w["temperature"], w["n"]) == (20.0, 5)
    win = {row["window_start"]: row for row in
           fq.frequent_top(r, k=1, size="60 seconds", slide="10 seconds").collect()}
    w = win[base]
    assert (w["temperature"], w["n"]) == (30.0, 6)


def test_half_even_rounding_and_precision(make_readings):
    base = "2024-01-01 12:00:0"
    r = make_readings([(base + "1", 0, 1, 0, 0.5), (base + "2", 0, 1, 0, 1.5),
                       (base + "3", 0, 1, 0, 2.5), (base + "4", 0, 1, 0, -0.3),
                       (base + "5", 0, 1, 0, 19.42), (base + "6", 0, 1, 0, 19.439)])
    got = sorted(row["temperature"] for row in fq.temperatures(r).collect())
    assert got == [-0.0, 0.0, 2.0, 2.0, 19.0, 19.0]
    one = sorted(row["temperature"] for row in fq.temperatures(r, 1).collect())
    assert one.count(19.4) == 2


def test_theta_and_topk_brute_force(spark):
    from collections import Counter
    from quartier.sources import fixtures
    r = fixtures.readings(spark, "/root/testdata/sf0.001")
    temps = [(row["time"], round(row["data"])) for row in
             r.filter("data_id = 0").select("time", "data").collect()]
    counts = {}
    for t, v in temps:
        es = int((t - datetime(1970, 1, 1)).total_seconds())
        pane = es - es % 600
        for j in range(6):
            counts.setdefault(pane - j * 600, Counter())[v] += 1
    theta = {(int((row["window_start"] - datetime(1970, 1, 1)).total_seconds()),
              row["temperature"], row["n"]) for row in fq.frequent_theta(r, 2).collect()}
    brute = {(w, float(v), n) for w, c in counts.items() for v, n in c.items() if n >= 2}
    assert theta == brute
    top = {int((row["window_start"] - datetime(1970, 1, 1)).total_seconds()):
           (row["temperature"], row["n"]) for row in fq.frequent_top(r, 1).collect()}
    for w, c in counts.items():
        best = sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[0]
        assert top[w] == (float(best[0]), best[1])


def test_frequent_points_members(spark):
    from quartier.sources import fixtures
    r = fixtures.readings(spark, "/root/testdata/sf0.001")
    p = fq.frequent_points(r)
    win = {row["window_start"]: row["n"] for row in fq.frequent_top(r, 1).collect()}
    per = {row["window_start"]: row["c"] for row in
           p.groupBy("window_start", "metric").count().withColumnRenamed("count", "c")
            .filter("metric = 'occurence.temperature'").collect()}
    assert per == win

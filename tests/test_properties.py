"""Property tests (hypothesis) against pure-Python brute force."""

import math
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quartier.functions import parse
from quartier.operators import rollup

BASE = datetime(2024, 1, 1, 10, 0, 0)
EPOCH = datetime(1970, 1, 1)
SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

reading = st.tuples(
    st.integers(0, 179),                         # seconds after BASE (3 minutes)
    st.integers(0, 3),                           # mun
    st.integers(0, 5),                           # room
    st.integers(0, 3),                           # data_id
    st.one_of(st.sampled_from([1.0, 2.0, 2.0, -1.5, float("nan")]),
              st.floats(-50, 50, allow_nan=False).map(lambda x: round(x, 2))),
)


def _eq(a, b):
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
        return True
    return a == b


@SETTINGS
@given(st.lists(st.tuples(reading, st.floats(0, 5, allow_nan=False)), min_size=1, max_size=25))
def test_format_parse_round_trip(spark, rows):
    from pyspark.sql import functions as F
    data = [(i, BASE + timedelta(seconds=r[0]), r[1], r[2], r[3], r[4], v)
            for i, (r, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, time timestamp, mun int, room_id int, "
                                     "data_id int, data double, voltage double")
    lines = df.select("id", parse.format_line(F.col("time"), F.col("mun"), F.col("room_id"),
                                              F.col("data_id"), F.col("data"),
                                              F.col("voltage")).alias("value"))
    back = {r["id"]: r for r in parse.parse_lines(lines).collect()}
    assert len(back) == len(data)
    for i, t, mun, room, did, d, v in data:
        r = back[i]
        assert (r["time"], r["mun"], r["room_id"], r["data_id"]) == (t, mun, room, did)
        assert _eq(r["data"], d) and r["voltage"] == v


def _brute(rows):
    """Expected roll-up points keyed by (bucket, data_id, level, group key, op)."""
    out = {}
    groups = {}
    for t, mun, room, did, d in rows:
        b = t.replace(second=0)
        for level, key in (("city", None), ("municipality", mun), ("space", room)):
            groups.setdefault((b, did, level, key), []).append((t, mun, room, d))
    for (b, did, level, key), g in groups.items():
        ok = [x for x in g if not math.isnan(x[3])]
        first = min(g, key=lambda x: (x[0], x[2]))
        mx = min(ok, key=lambda x: (-x[3], x[0], x[2])) if ok else first
        mn = min(ok, key=lambda x: (x[3], x[0], x[2])) if ok else first
        s = sum(x[3] for x in g)
        for op, rep, val in (("MAX", mx, mx[3]), ("MIN", mn, mn[3]), ("SUM", first, s),
                             ("COUNT", first, float(len(g)))):
            out[(b, did, level, key, op)] = (rep[0], val, rep[2])
    return out


@SETTINGS
@given(st.lists(reading, min_size=1, max_size=30))
def test_rollup_matches_brute_force(spark, make_readings, rows):
    rs = [(BASE + timedelta(seconds=s), mun, room, did, d) for s, mun, room, did, d in rows]
    got = {}
    for r in rollup.rollup(make_readings(rs)).collect():
        key = r["municipality"] if r["level"] == "municipality" else (
            r["space"] if r["level"] == "space" else None)
        got[(r["bucket"], r["data_id"], r["level"], key, r["aggregate"])] = (
            EPOCH + timedelta(seconds=r["timestamp"]), r["value"], r["arg_room"])
    want = _brute(rs)
    assert got.keys() == want.keys()
    for k, (t, v, room) in want.items():
        gt, gv, groom = got[k]
        assert gt == t and groom == room, k
        assert _eq(gv, v) or (not math.isnan(v) and math.isclose(gv, v, rel_tol=1e-12, abs_tol=1e-12)), k

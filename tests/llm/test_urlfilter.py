import numpy as np
from pyspark.sql import functions as F

from quartier.llm import urlfilter as u

RULES = [u.UrlRule("allow", "org", "/"), u.UrlRule("block", "example.org", "/es/"),
         u.UrlRule("block", "com", "/de/")]


def test_rules_hosts_and_edges(spark):
    rows = [(1, "http://A.Example.ORG/es/x?y#z"), (2, "https://example.org"), (3, None), (4, "no-url"),
            (5, "http://bad.com/de/1"), (6, "http://bad.com/1"), (7, "http://good.com/1"),
            (None, "http://good.com/1"), (6, "http://bad.com/1"), (8, "x://h/a://b/c"),
            (9, "http://notorg/"), (10, "http://org/"), (11, "")]
    df = spark.createDataFrame([(i, x, "k") for i, x in rows], "page_id long, url string, key string")
    out = sorted((tuple(r) for r in u.judge(df, RULES, F.col("host") == "bad.com").collect()), key=str)
    want = [(1, "a.example.org", "/es/x", "example.org/es/", "block"), (2, "example.org", "", None, "allow"),
            (3, "", "", None, "allow"), (4, "", "", None, "allow"),
            (5, "bad.com", "/de/1", "com/de/", "block"), (6, "bad.com", "/1", None, "block"),
            (6, "bad.com", "/1", None, "block"), (7, "good.com", "/1", None, "allow"),
            (None, "good.com", "/1", None, "allow"), (8, "h", "/a://b/c", None, "allow"),
            (9, "notorg", "/", None, "allow"), (10, "org", "/", "org/", "allow"), (11, "", "", None, "allow")]
    assert out == sorted(want, key=str)


def test_membership_is_exact_over_the_universe(spark, monkeypatch):
    monkeypatch.setattr(u, "SHARD_KEYS", 400)
    monkeypatch.setattr(u, "BROADCAST_BYTES", 700)  # several passes
    df = spark.range(3000).select((F.col("id") % 2500).cast("string").alias("k"))
    table, n = u.build_cascade(df, "k", F.crc32("k") % 5 == 0)
    assert n == 8
    got = u.probe(df, "k", table, n).select("k", "is_listed", (F.crc32("k") % 5 == 0).alias("w")).collect()
    assert len(got) == 3000 and all(r["is_listed"] == r["w"] for r in got)


def test_more_listed_than_not_and_none(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    for cond in (F.col("k") != "7", F.lit(False), F.lit(True)):
        table, n = u.build_cascade(df, "k", cond)
        assert all(r["is_listed"] == r["w"] for r in
                   u.probe(df, "k", table, n).withColumn("w", cond).collect())
    none = df.filter("false")
    table, n = u.build_cascade(none, "k", F.lit(True))
    assert u.probe(none, "k", table, n).count() == 0


def test_levels_alternate():
    rng = np.random.default_rng(1)
    h1, h2 = (rng.integers(0, 2**63, 5000).astype(np.uint64) for _ in range(2))
    listed = rng.random(5000) < 0.2
    levels = u._levels(u._build(listed, h1, h2))
    assert len(levels) > 2 and (u._member(levels, h1, h2) == listed).all()

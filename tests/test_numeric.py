"""Sums that do not depend on order, keep full precision and never overflow."""

import math

from pyspark.sql import functions as F

from quartier.functions.numeric import exact_sum, max_number, min_number
from quartier.functions.timefns import js_round


def _sum(spark, vals, parts=1):
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(parts)
    return df.agg(exact_sum("x").alias("s")).collect()[0]["s"]


def test_order_independent_and_correctly_rounded(spark):
    vals = [0.1] * 10 + [21.55, 36.52999999999997, -3.3333, 1e-9, 1 / 3] * 7
    assert {_sum(spark, vals, p) for p in (1, 3, 7)} == {math.fsum(vals)}
    assert _sum(spark, [1 / 3] * 6) == 2.0


def test_small_values_and_large_totals(spark):
    df = spark.range(1_000_000).select(F.lit(0.00004).alias("x"))
    assert math.isclose(df.agg(exact_sum("x").alias("s")).first()[0], 40.0, rel_tol=1e-15)
    assert _sum(spark, [9e11] * 2000) == 1.8e15


def test_non_finite_values_propagate(spark):
    assert math.isnan(_sum(spark, [1.0, float("nan")]))
    assert _sum(spark, [1.0, float("inf")]) == float("inf")
    assert math.isnan(_sum(spark, [float("inf"), float("-inf")]))
    assert _sum(spark, [1e300, 1.5]) == 1e300 + 1.5


def test_sums_of_sums(spark):
    df = spark.createDataFrame([(i % 7, 0.25 * (i % 13)) for i in range(500)], "k int, x double")
    part = df.groupBy("k").agg(exact_sum("x").alias("s"))
    assert (part.agg(exact_sum("s").alias("t")).first()[0]
            == df.agg(exact_sum("x").alias("t")).first()[0])


def test_extremes_skip_nan_and_display_rounding_keeps_it(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 5.0), ("a", nan), ("b", nan)], "k string, x double")
    got = {r["k"]: r for r in df.groupBy("k").agg(max_number("x").alias("hi"),
                                                  min_number("x").alias("lo")).collect()}
    assert (got["a"]["hi"], got["a"]["lo"]) == (5.0, 5.0) and math.isnan(got["b"]["hi"])
    r = spark.createDataFrame([(nan,), (1e18,), (2.345,), (-0.5,)], "x double").select(
        js_round("x", 2).alias("y")).collect()
    assert math.isnan(r[0]["y"]) and [x["y"] for x in r[1:]] == [1e18, 2.35, -0.5]

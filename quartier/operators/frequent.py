"""Query 3: frequent temperature values in sliding windows.

Sliding windows are evaluated pane-wise: readings are first counted per
(slide-sized pane, rounded value) -- a map-side combined aggregate -- and only
these counts are fanned out to the size/slide windows that contain the pane.
Raw rows are never replicated per window, and a hot window holds one row per
distinct rounded value, not its readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefns import epoch_seconds, parse_duration, to_ntz
from ..schema import CITY, FREQ_COUNT_METRIC, FREQ_VALUE_METRIC


def _epoch_floor(es: Column, width: int) -> Column:
    return es - F.pmod(es, F.lit(width))


def _starts(pane: Column, k: int, width: int) -> Column:
    """Start times (epoch s) of the k windows that contain a pane."""
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: pane - j * width)


def temperatures(readings: DataFrame, digits: int = 0) -> DataFrame:
    """Temperature readings with their value rounded half-even to ``digits``
    (19.439 and 19.42 count as the same measurement at one decimal)."""
    return (readings.filter(F.col("data_id") == 0)
                    .select(epoch_seconds("time").alias("es"), "time", "data",
                            F.bround("data", digits).alias("temperature"),
                            *[c for c in ("event_id",) if c in readings.columns]))


def pane_counts(readings: DataFrame, slide: str = "10 minutes", digits: int = 0) -> DataFrame:
    """(pane epoch s, temperature, n): counts per slide-sized pane."""
    w = parse_duration(slide)
    t = temperatures(readings, digits)
    return (t.groupBy(_epoch_floor(F.col("es"), w).alias("pane"), "temperature")
             .agg(F.count(F.lit(1)).alias("n")))


def window_counts(panes: DataFrame, size: str = "1 hour", slide: str = "10 minutes") -> DataFrame:
    """Fan pane counts out to the windows [start, start+size) containing them
    (starts aligned to multiples of ``slide``, as ``window()`` does)."""
    s, w = parse_duration(size), parse_duration(slide)
    if s % w:
        raise ValueError("window size must be a multiple of the slide")
    k = s // w
    fan = panes.select(F.explode(_starts(F.col("pane"), k, w)).alias("ws"), "temperature", "n")
    return (fan.groupBy("ws", "temperature").agg(F.sum("n").alias("n"))
               .withColumn("we", F.col("ws") + s))


def _out(df: DataFrame) -> DataFrame:
    return df.select(to_ntz(F.timestamp_seconds("ws")).alias("window_start"),
                     to_ntz(F.timestamp_seconds("we")).alias("window_end"),
                     "temperature", F.col("n").cast("long").alias("n"),
                     *[c for c in ("rank",) if c in df.columns])


def top_k(counts: DataFrame, k: int = 1) -> DataFrame:
    """Most frequent values per window; ties -> lower temperature first.

    ``row_number() <= k`` is planned with a WindowGroupLimit, so each task
    keeps only k candidates per window before the final ranking.
    """
    w = Window.partitionBy("ws").orderBy(F.desc("n"), F.asc("temperature"))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def frequent_top(readings: DataFrame, k: int = 1, size: str = "1 hour",
                 slide: str = "10 minutes", digits: int = 0) -> DataFrame:
    return _out(top_k(window_counts(pane_counts(readings, slide, digits), size, slide), k))


def frequent_theta(readings: DataFrame, theta: int, size: str = "1 hour",
                   slide: str = "10 minutes", digits: int = 0) -> DataFrame:
    """Every value occurring at least ``theta`` times in a window."""
    c = window_counts(pane_counts(readings, slide, digits), size, slide)
    return _out(c.filter(F.col("n") >= theta))


def frequent_per_batch(readings: DataFrame, batch: str = "10 seconds", size: str = "60 seconds",
                       digits: int = 0) -> DataFrame:
    """The reference's coded behaviour: values are grouped per batch before
    windowing, so each window's winner is the largest single-batch group among
    the window's batches (ties: lower temperature, then earlier batch)."""
    return per_batch_winners(pane_counts(readings, batch, digits), batch, size)


def per_batch_winners(batch_counts: DataFrame, batch: str = "10 seconds",
                      size: str = "60 seconds") -> DataFrame:
    """Winners per window from (pane = batch start epoch s, temperature, n)."""
    b, s = parse_duration(batch), parse_duration(size)
    k = s // b
    fan = batch_counts.select(F.explode(_starts(F.col("pane"), k, b)).alias("ws"), "pane",
                              "temperature", "n")
    win = fan.groupBy("ws").agg(F.max_by(
        F.struct("temperature", "n", "pane"),
        F.struct(F.col("n"), -F.col("temperature"), -F.col("pane"))).alias("w"))
    return win.select(to_ntz(F.timestamp_seconds("ws")).alias("window_start"),
                      to_ntz(F.timestamp_seconds(F.col("ws") + s)).alias("window_end"),
                      F.col("w.temperature").alias("temperature"),
                      F.col("w.n").cast("long").alias("n"),
                      to_ntz(F.timestamp_seconds("w.pane")).alias("batch_start"))


def frequent_points(readings: DataFrame, size: str = "1 hour", slide: str = "10 minutes",
                    digits: int = 0) -> DataFrame:
    """Datapoints of each window's winning value: every member reading yields
    ``temperature.occurence`` (its value) and ``occurence.temperature`` (the
    winner's count), both at the reading's own time, tagged with the city.

    Members are found by an equi-join of the winners, fanned out to their
    panes, with the readings on (pane, rounded value): no group is collected.
    """
    winners = top_k(window_counts(pane_counts(readings, slide, digits), size, slide), 1)
    return winner_points(winners, temperatures(readings, digits), size, slide)


def winner_points(winners: DataFrame, temps: DataFrame, size: str = "1 hour",
                  slide: str = "10 minutes") -> DataFrame:
    """The points of windows' winners (ws, temperature, n) from the readings
    (es, data, temperature) that may be their members."""
    s, w = parse_duration(size), parse_duration(slide)
    panes = winners.select("ws", "n", "temperature",
                           F.explode(F.transform(F.sequence(F.lit(0), F.lit(s // w - 1)),
                                                 lambda j: F.col("ws") + j * w)).alias("pane"))
    t = temps.withColumn("pane", _epoch_floor(F.col("es"), w))
    m = t.join(panes, ["pane", "temperature"])
    pts = F.explode(F.array(
        F.struct(F.lit(FREQ_VALUE_METRIC).alias("metric"), F.col("data").alias("value")),
        F.struct(F.lit(FREQ_COUNT_METRIC).alias("metric"), F.col("n").cast("double").alias("value"))))
    return m.select(to_ntz(F.timestamp_seconds("ws")).alias("window_start"),
                    F.col("es").alias("timestamp"), pts.alias("p")).select(
        "window_start", F.col("p.metric").alias("metric"), "timestamp",
        F.col("p.value").alias("value"), F.lit(CITY).alias("city"))

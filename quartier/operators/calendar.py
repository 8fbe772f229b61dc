"""Calendar heatmap re-bucketing: domains (hour/day/week/month/year) split into
sub-domain cells (min/hour/day/week/month), cell = sum of its values.

Steps: last write wins per timestamp, NaN values skipped, domains limited to
[start domain, start domain + range), cells summed, and the full cell grid of
every domain left-joined so empty cells are NULL (or 0 when missing data
counts as zero).  Thresholds and classes follow the heatmap legend rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_sum
from ..functions.timefns import sunday_week_start, to_ntz
from .points import last_write_wins

# Allowed sub-domains per domain.
SUB_DOMAINS = {"hour": ["min"], "day": ["hour"], "week": ["day", "hour"],
               "month": ["day", "week"], "year": ["month", "week", "day"]}
THRESHOLD_STEPS = 9


def _unit(name: str) -> str:
    return {"min": "minute", "minute": "minute"}.get(name, name)


def trunc(col: Column, unit: str, week_start_monday: bool = True) -> Column:
    u = _unit(unit)
    if u == "week" and not week_start_monday:
        return sunday_week_start(col)
    return F.date_trunc(u, col.cast("timestamp"))


def _step(unit: str, n: Column | int = 1) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    u = _unit(unit)
    z = F.lit(0)
    if u == "minute":
        return F.make_interval(z, z, z, z, z, n)
    if u == "hour":
        return F.make_interval(z, z, z, z, n)
    if u == "day":
        return F.make_interval(z, z, z, n)
    if u == "week":
        return F.make_interval(z, z, n)
    if u == "month":
        return F.make_interval(z, n)
    if u == "year":
        return F.make_interval(n)
    raise ValueError(unit)


def domain_count(start: Column, end: Column, domain: str,
                 week_start_monday: bool = True) -> Column:
    """Number of domains from the one containing ``start`` to the one
    containing ``end`` (inclusive)."""
    s, e = trunc(start, domain, week_start_monday), trunc(end, domain, week_start_monday)
    u = _unit(domain)
    if u in ("month", "year"):
        months = (F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)
        n = months if u == "month" else F.year(e) - F.year(s)
    else:
        sec = {"minute": 60, "hour": 3600, "day": 86400, "week": 604800}[u]
        n = F.floor((F.unix_seconds(e) - F.unix_seconds(s)) / sec)
    return n.cast("int") + 1


def auto_domain(start: Column, end: Column) -> tuple[Column, Column]:
    """(days, domain) chosen for a time range: month if more than 31 days,
    day if more than 3, otherwise hour; days = whole days between + 1."""
    days = (F.floor((F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp")))
                    / 86400) + 1).cast("int")
    domain = F.when(days > 31, F.lit("month")).when(days > 3, F.lit("day")).otherwise(F.lit("hour"))
    return days, domain


def dedupe(series: DataFrame) -> DataFrame:
    """One value per timestamp of a series: the one written last (largest seq).

    A ``series`` column, if there is one, names the series of a row."""
    keys = ["series", "ts"] if "series" in series.columns else ["ts"]
    return last_write_wins(series.select(*keys, "value", "seq"), keys=keys, order="seq")


def calendar_cells(series: DataFrame, domain: str, sub_domain: str, start=None, end=None,
                   range_n: int | None = None, week_start_monday: bool = True,
                   missing_as_zero: bool = False, ordered: bool = False) -> DataFrame:
    """series(ts, value, seq[, series]) -> (domain_start, cell_start, value).

    Covers every domain from ``start`` to ``end`` (default: the data's first and
    last time), or ``range_n`` domains from ``start``."""
    if sub_domain not in SUB_DOMAINS[domain]:
        raise ValueError(f"sub-domain {sub_domain} not allowed in domain {domain}")
    spark = series.sparkSession
    ts = F.col("ts").cast("timestamp")
    lo = (series.select(F.min(ts)).scalar() if start is None
          else F.lit(start).cast("timestamp"))
    hi = (series.select(F.max(ts)).scalar() if end is None
          else F.lit(end).cast("timestamp"))
    n = F.lit(range_n) if range_n else domain_count(lo, hi, domain, week_start_monday)
    d0 = trunc(lo, domain, week_start_monday)
    d_end = d0 + _step(domain, n)

    vals = (dedupe(series).filter(~F.isnan("value"))
            .filter((ts >= d0) & (ts < d_end))
            .groupBy(trunc(ts, domain, week_start_monday).alias("domain_start"),
                     trunc(ts, sub_domain, week_start_monday).alias("cell_start"))
            .agg(exact_sum("value").alias("value")))
    doms = spark.range(1).select(F.explode(
        F.sequence(d0, d0 + _step(domain, n - 1), _step(domain))).alias("domain_start"))
    # one row per domain, spread before it becomes its cells
    grid = doms.repartition("domain_start").select("domain_start", F.explode(F.sequence(
        trunc(F.col("domain_start"), sub_domain, week_start_monday),
        F.col("domain_start") + _step(domain) - F.expr("INTERVAL 1 SECOND"),
        _step(sub_domain))).alias("cell_start"))
    out = grid.join(vals, ["domain_start", "cell_start"], "left")
    value = F.coalesce(F.col("value"), F.lit(0.0)) if missing_as_zero else F.col("value")
    out = out.select(to_ntz("domain_start").alias("domain_start"),
                     to_ntz("cell_start").alias("cell_start"), value.alias("value"))
    # time-ordered output for display (a range sort of the bounded grid)
    return out.orderBy("domain_start", "cell_start") if ordered else out


def _threshold_cell(ts: Column, sub_domain: str) -> Column:
    u = _unit(sub_domain)
    if u == "week":  # the legend's own cell splitter starts weeks on Sunday
        return sunday_week_start(ts)
    if u not in ("minute", "hour", "day"):
        raise ValueError("thresholds need a min, hour, day or week sub-domain")
    return F.date_trunc(u, ts)


def thresholds(series: DataFrame, sub_domain: str) -> DataFrame:
    """Nine legend cuts from the cell sums of the whole series.

    count, sum, sum of squares, min and max of the cell sums;
    sd = sqrt((sumsq - avg^2) / count) (kept as defined, it is not the
    textbook deviation); bounds clamped to avg +- 1.5 sd; cuts evenly spaced.
    Output: (i, threshold) for i = 0..8.
    """
    ts = F.col("ts").cast("timestamp")
    cells = (dedupe(series).filter(~F.isnan("value"))
             .groupBy(_threshold_cell(ts, sub_domain).alias("cell"))
             .agg(exact_sum("value").alias("v")))
    st = cells.groupBy(F.lit(1).alias("_k")).agg(
        F.count(F.lit(1)).alias("c"), exact_sum("v").alias("s"),
        exact_sum(F.col("v") * F.col("v")).alias("ss"),
        F.min("v").alias("mn"), F.max("v").alias("mx"))
    avg = F.col("s") / F.col("c")
    sd = F.sqrt((F.col("ss") - avg * avg) / F.col("c"))
    lo = F.greatest(F.col("mn"), avg - sd * 1.5)
    hi = F.least(F.col("mx"), avg + sd * 1.5)
    return st.select(lo.alias("lo"), hi.alias("hi")).select(
        F.explode(F.sequence(F.lit(0), F.lit(THRESHOLD_STEPS - 1))).alias("i"), "lo", "hi") \
        .select(F.col("i").cast("int").alias("i"),
                (F.col("lo") + (F.col("hi") - F.col("lo")) / 8 * F.col("i")).alias("threshold"))


def classify(cells: DataFrame, cuts: DataFrame) -> DataFrame:
    """Legend class of each cell value.

    class = first i with value <= cut[i], plus one (len+1 when above all);
    a negative value when the first cut is positive is class 1 with the
    ``overflow`` flag; ``zero`` flags value 0.  ``bin`` is the colour-scale
    bin: number of cuts <= min(value, last cut).
    """
    arr = cuts.select(F.array_sort(F.collect_list(F.struct("i", "threshold")))).scalar()
    # Attach the cut array once (one scalar subquery, run once); the class
    # expressions then read the column, so lambdas see no subquery.
    staged = cells.select("*", arr.alias("_cuts"))
    cut = F.transform(F.col("_cuts"), lambda s: s["threshold"])
    v = F.col("value")
    n_below = F.size(F.filter(cut, lambda c: c < v))
    overflow = (F.try_element_at(cut, F.lit(1)) > 0) & (v < 0)
    cls = F.when(v.isNull() | F.isnan(v), F.lit(None)) \
           .when(overflow, F.lit(1)).otherwise(n_below + 1)
    b = F.size(F.filter(cut, lambda c: c <= F.least(v, F.try_element_at(cut, F.lit(-1)))))
    return staged.select(*cells.columns, cls.cast("int").alias("class"),
                         F.when(v.isNotNull(), overflow).alias("overflow"),
                         F.when(v.isNotNull(), v == 0).alias("zero"),
                         F.when(v.isNotNull(), b).cast("int").alias("bin"))

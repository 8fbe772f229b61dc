"""Two-column series files (calendar data sources) and the Avro-shaped record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import AVRO_VALUE, AVRO_VALUE_DEFAULTS


def read_series(spark: SparkSession, path: str, fmt: str = "csv",
                multi_line: bool = False) -> DataFrame:
    """A10: (epoch seconds, value) series from json / csv / tsv / txt.

    csv / tsv / txt: first column is the key (epoch seconds), second the value,
    an optional third the write sequence (last write wins on equal keys);
    rows whose key or value is not numeric are skipped.  json: objects mapping
    epoch keys to values, whole objects per line (``{"1704067200": 3, ...}``); with
    ``multi_line`` objects may spread over lines, and each file is one row of one task.
    Without it a line that is no object is an error.
    Output: ts (TIMESTAMP), value (DOUBLE), seq (BIGINT; the key when absent),
    and series if the files lie in one folder per series.
    """
    fmt = fmt.lower()
    if fmt in ("csv", "tsv", "txt"):
        sep = {"csv": ",", "tsv": "\t", "txt": " "}[fmt]
        raw = spark.read.option("sep", sep).schema("k string, v string, s string").csv(path)
        keys = [c for c in ("series",) if c in raw.columns]
        df = raw.select(raw.k.try_cast("double").alias("k"), raw.v.try_cast("double").alias("value"),
                        raw.s.try_cast("long").alias("s"), *keys).filter(
            F.col("k").isNotNull() & F.col("value").isNotNull())
    elif fmt == "json":
        raw = spark.read.text(path, wholetext=multi_line)
        if not multi_line:
            raw = raw.filter(F.trim("value") != "").select(
                F.when(F.col("value").rlike(r"^\s*\{.*\}\s*$"), F.col("value")).otherwise(
                    F.raise_error(F.lit("a line is no JSON object: multi_line=True reads "
                                        "objects that spread over lines"))).alias("value"))
        # several objects of one line or file are cut apart
        raw = raw.select(F.explode(F.split("value", r"(?<=\})\s*(?=\{)")).alias("value"))
        m = F.from_json(F.col("value"), "map<string,double>")
        df = (raw.select(F.explode(m).alias("k", "value"))
                 .select(F.col("k").try_cast("double").alias("k"), "value",
                         F.lit(None).cast("long").alias("s"))
                 .filter(F.col("k").isNotNull() & F.col("value").isNotNull()))
    else:
        raise ValueError(fmt)
    return df.select(F.timestamp_micros((F.col("k") * 1_000_000).cast("long")).alias("ts"),
                     "value", F.coalesce(F.col("s"), F.col("k").cast("long")).alias("seq"),
                     *[c for c in ("series",) if c in df.columns])


def write_series_csv(series: DataFrame, path: str) -> None:
    """Write (ts, value, seq) as 'epoch,value,seq' CSV lines (distributed, no
    header); a ``series`` column becomes one folder per series."""
    keys = [c for c in ("series",) if c in series.columns]
    out = series.select(F.unix_seconds(F.col("ts").cast("timestamp")).cast("string").alias("k"),
                        F.col("value").cast("string").alias("v"),
                        F.col("seq").cast("string").alias("s"), *keys)
    (out.hint("rebalance", *keys) if keys else out).write.partitionBy(*keys) \
        .mode("overwrite").csv(path)


def with_avro_defaults(df: DataFrame) -> DataFrame:
    """Shape rows like the declared Avro value record, filling its defaults."""
    cols = []
    for f in AVRO_VALUE.fields:
        c: Column = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if f.name in AVRO_VALUE_DEFAULTS:
            c = F.coalesce(c, F.lit(AVRO_VALUE_DEFAULTS[f.name]).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def parse_threshold_list(col: Column | str) -> Column:
    """G25: '10, 20,30' -> array<double> as a column expression."""
    c = F.col(col) if isinstance(col, str) else col
    return F.transform(F.split(F.trim(c), r"\s*,\s*"), lambda x: x.try_cast("double"))

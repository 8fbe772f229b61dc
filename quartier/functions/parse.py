"""Reading-line parser and formatter as native column expressions.

Wire format (whitespace separated)::

    2019-02-01 10:15:10 8-46-0 19.4391 2.6312
    date       time     mun-room-type value voltage

Rules kept from the reference consumer: whitespace is stripped and runs of
whitespace split fields; fields after the fifth and id parts after the third
are ignored; month/day/hour may be unpadded; fractional seconds, non-integer
ids and non-numeric values make the whole line a reject.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import MUNICIPALITY_MODULUS

# Accepted literal forms.
TIME_PATTERN = "yyyy-M-d H:m:s"
CANONICAL_TIME_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
INT_RE = r"^[+-]?[0-9]+$"
NUMBER_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
SPECIAL_RE = r"^[+-]?([iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])$"

PARSED_COLUMNS = ["time", "mun", "room_id", "data_id", "data", "voltage"]


def _to_int(s: Column) -> Column:
    return F.when(s.rlike(INT_RE), s.try_cast("int"))


def _to_float(s: Column) -> Column:
    # Spark also casts '1d' / '1f'; the regex keeps to the literal forms the
    # reference accepts.  Plain numbers take one regex and a cast; only the
    # rare inf/nan spellings reach the slower branch.
    lowered = F.lower(s)
    special = (F.when(lowered.startswith("-") & lowered.contains("inf"), F.lit(float("-inf")))
                .when(lowered.contains("inf"), F.lit(float("inf")))
                .otherwise(F.lit(float("nan"))))
    return (F.when(s.rlike(NUMBER_RE), s.try_cast("double"))
             .when(s.rlike(SPECIAL_RE), special))


def _parse_time(date_s: Column, time_s: Column, allow_fraction: bool) -> Column:
    if not allow_fraction:
        txt = F.concat_ws(" ", date_s, time_s)
        # zero-padded text (the common case) goes through the native cast, far
        # cheaper than a pattern formatter; other forms use the pattern
        return F.when(txt.rlike(CANONICAL_TIME_RE), txt.try_cast("timestamp")) \
                .otherwise(F.try_to_timestamp(txt, F.lit(TIME_PATTERN)))
    frac = F.regexp_extract(time_s, r"\.([0-9]{1,6})$", 1)
    whole = F.regexp_replace(time_s, r"\.[0-9]{1,6}$", "")
    base = F.try_to_timestamp(F.concat_ws(" ", date_s, whole), F.lit(TIME_PATTERN))
    micros = F.when(frac == "", F.lit(0)).otherwise(F.rpad(frac, 6, "0").cast("long"))
    return F.timestamp_micros(F.unix_micros(base) + micros)


def annotate(lines: DataFrame, col: str = "value", id_parts: int = 3,
             allow_fraction: bool = False) -> DataFrame:
    """Add the parsed reading columns and a ``reject`` reason (NULL when valid).

    Built in stages (split once, then extract fields, then convert) so that no
    expensive expression is repeated per field; Catalyst keeps the stages as
    separate projections instead of inlining the split into every field.
    """
    if id_parts not in (2, 3):
        raise ValueError("id_parts must be 2 or 3")
    stripped = F.regexp_replace(F.col(col), r"^\s+|\s+$", "")
    s1 = lines.select("*", F.split(stripped, r"\s+").alias("_f"),
                      (F.col(col).isNull() | (stripped == "")).alias("_empty"))
    f = F.col("_f")
    s2 = s1.select("*", F.size(f).alias("_nf"),
                   *[F.get(f, i).alias(n) for i, n in enumerate(["_d", "_t", "_id", "_v", "_vo"])],
                   F.split(F.get(f, 2), "-").alias("_p"))
    p = F.col("_p")
    if id_parts == 3:
        mun, room, dtype = (_to_int(F.get(p, i)) for i in range(3))
    else:
        room, dtype = (_to_int(F.get(p, i)) for i in range(2))
        mun = F.lit(0)
    s3 = s2.select("*",
                   _parse_time(F.col("_d"), F.col("_t"), allow_fraction).alias("time"),
                   mun.cast("int").alias("mun"), room.alias("room_id"), dtype.alias("data_id"),
                   _to_float(F.col("_v")).alias("data"), _to_float(F.col("_vo")).alias("voltage"),
                   (F.size(p) >= id_parts).alias("_id_ok"))
    if id_parts == 2:
        s3 = s3.withColumn("mun", F.pmod(F.col("room_id"), F.lit(MUNICIPALITY_MODULUS)))
    c = F.col
    reject = (F.when(c("_empty"), F.lit("empty"))
               .when(c("_nf") < 5, F.lit("fields"))
               .when(c("time").isNull(), F.lit("time"))
               .when(~c("_id_ok") | c("mun").isNull() | c("room_id").isNull()
                     | c("data_id").isNull(), F.lit("id"))
               .when(c("data").isNull(), F.lit("value"))
               .when(c("voltage").isNull(), F.lit("voltage")))
    return s3.select("*", reject.alias("reject")).drop(
        "_f", "_empty", "_nf", "_d", "_t", "_id", "_v", "_vo", "_p", "_id_ok")


def parse_lines(lines: DataFrame, col: str = "value", **opts) -> DataFrame:
    """Valid readings only; other columns of ``lines`` are passed through.

    Like the reference's ``flatMap(parse)`` each line yields zero or one
    reading: ``inline`` of a zero/one-element array.  Being a generator, it is
    not inlined into a pushed-down filter, so each field is parsed once.
    """
    a = annotate(lines, col, **opts)
    keep = [c for c in lines.columns if c != col]
    one = F.when(F.col("reject").isNull(), F.array(F.struct(*PARSED_COLUMNS)))
    return a.select(*keep, F.inline(one))


def rejected_lines(lines: DataFrame, col: str = "value", **opts) -> DataFrame:
    """The complement of ``parse_lines``: raw line plus its reject reason."""
    a = annotate(lines, col, **opts)
    keep = [c for c in lines.columns if c != col]
    one = F.when(F.col("reject").isNotNull(),
                 F.array(F.struct(F.col(col).alias(col), F.col("reject"))))
    return a.select(*keep, F.inline(one))


def format_line(time: Column, mun: Column, room: Column, dtype: Column,
                data: Column, volt: Column) -> Column:
    """Inverse of the parser: render one reading as a wire line.

    Doubles are rendered with Spark's shortest round-trip form, so parsing
    the line back yields the identical value.
    """
    return F.concat_ws(
        " ", F.date_format(time, "yyyy-MM-dd HH:mm:ss"),
        F.concat_ws("-", mun.cast("string"), room.cast("string"), dtype.cast("string")),
        data.cast("string"), volt.cast("string"))

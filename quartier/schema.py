"""Typed schemas and fixed vocabulary of the sensor data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results:
# city tag, measure names by data_id (0..3), roll-up operator names, space
# levels, metric names of the frequent-temperature points (spelling kept),
# the day/night temperature threshold and the municipality count used to
# derive a municipality from a room id in the two-part wire format.
# ---------------------------------------------------------------------------
CITY = "Brussels"
MEASURES = ["temperature", "humidity", "light", "motion"]
OPS = ["MAX", "MIN", "SUM", "COUNT"]
LEVELS = ["city", "municipality", "space"]
FREQ_VALUE_METRIC = "temperature.occurence"
FREQ_COUNT_METRIC = "occurence.temperature"
DAY_NIGHT_THRESHOLD = 19.0
MUNICIPALITY_MODULUS = 19
RAW_TAG = "RAW"

READING = T.StructType([
    T.StructField("time", T.TimestampType()),
    T.StructField("mun", T.IntegerType()),
    T.StructField("room_id", T.IntegerType()),
    T.StructField("data_id", T.IntegerType()),
    T.StructField("data", T.DoubleType()),
    T.StructField("voltage", T.DoubleType()),
])

# Flat datapoint: the store document with its tag map spread into columns.
DATAPOINT = T.StructType([
    T.StructField("metric", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("city", T.StringType()),
    T.StructField("municipality", T.IntegerType()),
    T.StructField("space", T.IntegerType()),
    T.StructField("aggregate", T.StringType()),
])

# Declared (but unused by the reference code) Avro value record, with defaults.
AVRO_VALUE = T.StructType([
    T.StructField("timestamp", T.IntegerType()),
    T.StructField("room_id", T.IntegerType()),
    T.StructField("data_id", T.IntegerType()),
    T.StructField("data", T.FloatType()),
    T.StructField("voltage", T.FloatType()),
])
AVRO_VALUE_DEFAULTS = {"room_id": -1, "data_id": -1, "data": -999.0, "voltage": -999.0}
AVRO_KEY = T.StructType([T.StructField("room_id", T.IntegerType())])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

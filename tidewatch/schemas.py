"""Schemas of the streams and tables the operators exchange."""

from __future__ import annotations

from pyspark.sql import types as T

TAGS = T.MapType(T.StringType(), T.StringType())

# Every field is read as text first, so one odd token never voids its siblings.
WIRE_ELEMENT = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("tags", TAGS),
        T.StructField("type", T.StringType()),
        T.StructField("reaction", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

METRIC_POINT = T.StructType(
    [
        T.StructField("series_key", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("tags", TAGS),
        T.StructField("uuid", T.StringType()),
        T.StructField("type", T.ShortType()),
        T.StructField("reaction", T.IntegerType()),
        T.StructField("is_special", T.BooleanType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("seq", T.StringType()),
    ]
)

CONTROL = T.StructType(
    [
        T.StructField("ts_ms", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("action", T.StringType()),
        T.StructField("hash", T.LongType()),
        T.StructField("uuid", T.StringType()),
        T.StructField("changedata", T.StringType()),
    ]
)

LEVEL_RULE = T.StructType(
    [
        T.StructField("min_weight", T.DoubleType()),
        T.StructField("min_pct", T.DoubleType()),
        T.StructField("min_value", T.DoubleType()),
        T.StructField("min_predict_pct", T.DoubleType()),
        T.StructField("rec_count", T.IntegerType()),
    ]
)

LEVELS_JSON = T.MapType(T.StringType(), LEVEL_RULE)

ALERT_LEVELS = T.StructType(
    [T.StructField("uuid", T.StringType()), T.StructField("level", T.IntegerType()), *LEVEL_RULE.fields]
)

BASELINE = T.StructType(
    [
        T.StructField("series_key", T.StringType()),
        T.StructField("slot_ms", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("avg", T.DoubleType()),
        T.StructField("dev", T.DoubleType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
    ]
)

CATALOG = T.StructType(
    [
        T.StructField("series_key", T.StringType()),
        T.StructField("series_hash", T.LongType()),
        T.StructField("uuid", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("tags", TAGS),
        T.StructField("type", T.ShortType()),
        T.StructField("is_special", T.BooleanType()),
        T.StructField("first_ts_ms", T.LongType()),
        T.StructField("last_ts_ms", T.LongType()),
        T.StructField("last_seq", T.LongType()),
    ]
)

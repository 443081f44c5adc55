"""Explicit schemas (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# One element of a platform response's status list: every field is text.
STATUS = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("datasetId", T.StringType()),
])

# Body of a platform response (the text after ``body=``).
RESPONSE_BODY = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("desc", T.StringType()),
    T.StructField("deviceStatusList", T.ArrayType(STATUS)),
])

# The same with the text of a body that is not such an object.
CORRUPT = "_corrupt"
RESPONSE_BODY_OR_CORRUPT = T.StructType([*RESPONSE_BODY.fields, T.StructField(CORRUPT, T.StringType())])

# Result tables.
WINDOW_EXTREMES = T.StructType([
    T.StructField("dataset_id", T.StringType()),
    T.StructField("win_start", T.TimestampType()),
    T.StructField("win_end", T.TimestampType()),
    T.StructField("max_value", T.DoubleType()),
    T.StructField("min_value", T.DoubleType()),
    T.StructField("n", T.LongType()),
])

RISING_STREAK = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("start_ms", T.LongType()),
    T.StructField("counts", T.LongType()),
])

# Keyed state of the streaming streak detector (one row per device).
STREAK_STATE = T.StructType([
    T.StructField("start_ms", T.LongType()),
    T.StructField("prev", T.DoubleType()),
    T.StructField("cnt", T.LongType()),
])

"""Streaming inputs in the reading schema, with an event-time watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.operators.cleaning import lines_to_readings
from tidewatch.sources.files import text_stream
from tidewatch.sources.tables import events_as_readings

#: Files a micro-batch takes at most: a backlog becomes several batches, not one.
FILES_PER_TRIGGER = 100


def with_event_time(df: DataFrame, delay: str = "0 seconds", ts_col: str = "ts") -> DataFrame:
    """Watermark on ``ts`` (cast to a session-zone timestamp; watermarks
    reject ``timestamp_ntz``).  A zero delay follows the maximum event time
    exactly, as an ascending-timestamp source does."""
    return df.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, delay)


def line_readings_stream(spark: SparkSession, directory: str, delay: str = "0 seconds",
                         deny=config.DENY_MARKERS, allow=config.ALLOW_MARKERS,
                         max_files_per_trigger: int | None = FILES_PER_TRIGGER) -> DataFrame:
    """Directory of rolled line files -> watermarked readings."""
    lines = text_stream(spark, directory, max_files_per_trigger)
    return with_event_time(lines_to_readings(lines, deny, allow), delay)


def events_stream(spark: SparkSession, directory: str, delay: str = "0 seconds",
                  max_files_per_trigger: int | None = FILES_PER_TRIGGER) -> DataFrame:
    """Directory of ``events``-schema parquet files -> watermarked readings."""
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return with_event_time(events_as_readings(reader.load(directory)), delay)

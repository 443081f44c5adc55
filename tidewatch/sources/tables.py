"""Parquet tables and the mapping of the ``events`` table onto readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.timefmt import to_ts, ts_to_ms


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, e.g. ``load_table(spark, dir, "events")``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_as_readings(events: DataFrame) -> DataFrame:
    """``events`` in the reading schema.

    device_id <- user_id, dataset_id <- event_type, ts <- ts (as a
    session-zone timestamp), value <- value, seq <- event_id.  Only a
    projection: Catalyst prunes whatever a later operator does not use.
    """
    ts = to_ts("ts")
    return events.select(
        F.col("user_id").cast("string").alias("device_id"),
        F.col("event_type").alias("dataset_id"),
        ts_to_ms(ts).alias("ts_ms"),
        F.col("value").cast("double").alias("value"),
        ts.alias("ts"),
        F.col("event_id").cast("long").alias("seq"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_readings(load_table(spark, sf_dir, "events"))


def result_table(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                 **options) -> DataFrame:
    """Read a result table back: parquet/orc path, or ``fmt="jdbc"`` with options.

    JDBC options (url, dbtable or query, user, password, ...) are supplied
    by the caller; nothing is built into the library.
    """
    reader = spark.read.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()

"""Rising-streak alarm, batch form.

Per device, in (ts, order) order: a reading starts a new run when it is the
device's first or when the previous value is >= it; otherwise it extends the
run.  A run's count is its length so far (the first reading counts 1).
Every reading whose count reaches ``limit`` emits (device, run start, count).

The scan is :func:`tidewatch.operators.scan.ordered_scan` with the rising
rule.  Rows are range-sliced on (device, ts, seq), so a device holding a
third of all rows is spread over a third of the slices.  Each slice is
scanned in order by the vectorised kernel ``scan.advance_runs``, which is also
what the streaming operator applies to each micro-batch, and runs crossing
slice edges are resolved on a table of at most one row per slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.config import READING_COLS, Cols
from tidewatch.operators.scan import RISING, ordered_scan


def streak_counts(df: DataFrame, cols: Cols = READING_COLS, slices: int | None = None,
                  min_count: int | None = None) -> DataFrame:
    """Readings with their run start and count (only ``counts >= min_count`` if given).

    Output: ``device_id, ts_ms, seq, value, start_ms, counts``.
    """
    rows = df.select(
        F.col(cols.device).cast("string").alias("device_id"), F.col(cols.ts_ms).cast("long").alias("ts_ms"),
        F.col(cols.order).cast("long").alias("seq"), F.col(cols.value).cast("double").alias("value"),
    )
    return ordered_scan(rows, "device_id", "ts_ms", "seq", "value", rule=RISING, slices=slices,
                        min_count=min_count)


def rising_streaks(df: DataFrame, limit: int = config.STREAK_LIMIT, cols: Cols = READING_COLS,
                   slices: int | None = None) -> DataFrame:
    """Alerts: ``device_id, start_ms, counts, ts_ms`` for readings with count >= limit."""
    return streak_counts(df, cols, slices, min_count=limit).select("device_id", "start_ms", "counts", "ts_ms")


def streak_table(alerts: DataFrame) -> DataFrame:
    """What a replace-by-key sink holds after all alerts: one row per
    (device, start) with the highest count."""
    return alerts.groupBy("device_id", "start_ms").agg(F.max("counts").alias("counts"))

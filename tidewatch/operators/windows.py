"""Event-time sliding-window extremes per dataset.

``F.window`` with a slide would copy each reading into size/slide windows (an
``Expand``) before aggregating.  For batch inputs the readings are instead
aggregated once into panes, tumbling windows of gcd(size, slide), and only
the small pane table is fanned out to windows.  ``max``/``min``/``count``
aggregate partially before each shuffle, so a hot dataset is combined
map-side.  Columns are pruned to (dataset, ts, value) at the scan.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import config
from tidewatch.config import READING_COLS, Cols


_UNIT_MS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000,
            "week": 604_800_000}


def interval_ms(text: str) -> int | None:
    """``"10 minutes"`` -> 600000; None for forms this parser does not know."""
    parts = text.strip().lower().split()
    if len(parts) != 2:
        return None
    num, unit = parts
    unit = unit[:-1] if unit.endswith("s") else unit
    if unit not in _UNIT_MS or not num.isdigit():
        return None
    return int(num) * _UNIT_MS[unit]


def _long(v: int):
    return F.lit(v).cast("long")


def window_column(ts_col: str, size: str, slide: str | None):
    return F.window(F.col(ts_col), size, slide) if slide else F.window(F.col(ts_col), size)


def _direct_extremes(df: DataFrame, size: str, slide: str, cols: Cols) -> DataFrame:
    return (
        df.select(cols.dataset, cols.ts, cols.value)
        .groupBy(F.col(cols.dataset).alias("dataset_id"), window_column(cols.ts, size, slide).alias("w"))
        .agg(
            F.max(cols.value).alias("max_value"),
            F.min(cols.value).alias("min_value"),
            F.count(F.lit(1)).alias("n"),
        )
        .select(
            "dataset_id",
            F.col("w.start").alias("win_start"),
            F.col("w.end").alias("win_end"),
            "max_value", "min_value", "n",
        )
    )


def pane_partials(df: DataFrame, size_ms: int, slide_ms: int, cols: Cols = READING_COLS, salt=None) -> DataFrame:
    """Per (dataset, pane): ``_max``, ``_min``, ``_n`` of the readings.

    A pane is a tumbling window of gcd(size, slide), named by its start in epoch
    microseconds.  The partials merge: max of maxima, min of minima, sum of counts.
    """
    g = math.gcd(size_ms, slide_ms) * 1000
    us = F.unix_micros(F.col(cols.ts).cast("timestamp"))
    salt_cols = [salt.alias("_salt")] if salt is not None else []
    return (
        df.where(F.col(cols.ts).isNotNull())
        .select(F.col(cols.dataset).alias("dataset_id"), (us - F.pmod(us, _long(g))).alias("_pane"),
                F.col(cols.value).alias("_v"), *salt_cols)
        .groupBy(*(["_salt"] if salt is not None else []), "dataset_id", "_pane")
        .agg(F.max("_v").alias("_max"), F.min("_v").alias("_min"), F.count(F.lit(1)).alias("_n"))
    )


def last_window_start(pane, slide_ms: int):
    """Start (epoch microseconds) of the last window that covers a pane or time."""
    return pane - F.pmod(pane, _long(slide_ms * 1000))


def panes_in_windows(panes: DataFrame, size_ms: int, slide_ms: int) -> DataFrame:
    """Each pane once per window covering it, with the window's start ``_s``.  A
    pane lies inside a window exactly when its start does.  Integer arithmetic."""
    per_pane = -(-size_ms // slide_ms)                    # windows a pane can belong to
    return (
        panes.select("*", F.explode(F.sequence(_long(0), _long(per_pane - 1))).alias("_j"))
        .withColumn("_s", last_window_start(F.col("_pane"), slide_ms) - F.col("_j") * _long(slide_ms * 1000))
        .where(F.col("_s") + _long(size_ms * 1000) > F.col("_pane"))
    )


def windows_of_panes(panes: DataFrame, size_ms: int, slide_ms: int, ts_type=T.TimestampType()) -> DataFrame:
    """Sliding-window extremes merged from pane partials."""
    def as_ts(c):
        t = F.timestamp_micros(c)
        return t.cast("timestamp_ntz") if isinstance(ts_type, T.TimestampNTZType) else t

    return (
        panes_in_windows(panes, size_ms, slide_ms).groupBy("dataset_id", "_s")
        .agg(F.max("_max").alias("max_value"), F.min("_min").alias("min_value"), F.sum("_n").alias("n"))
        .select("dataset_id", as_ts(F.col("_s")).alias("win_start"),
                as_ts(F.col("_s") + _long(size_ms * 1000)).alias("win_end"), "max_value", "min_value", "n")
    )


def _pane_extremes(df: DataFrame, size_ms: int, slide_ms: int, cols: Cols, salt=None) -> DataFrame:
    """Sliding extremes through panes: each reading is aggregated once, into its
    pane, instead of being copied into every window that covers it; the small pane
    table is fanned out and merged.  With ``salt`` the pane aggregate is also keyed
    by the salt, and the window merge combines salts and panes in one step."""
    panes = pane_partials(df, size_ms, slide_ms, cols, salt)
    return windows_of_panes(panes, size_ms, slide_ms, df.schema[cols.ts].dataType)


def sliding_extremes(df: DataFrame, size: str = config.WINDOW_SIZE, slide: str = config.WINDOW_SLIDE,
                     cols: Cols = READING_COLS, panes: bool | None = None) -> DataFrame:
    """Per (dataset, window): max, min and count of values.

    Windows are epoch-aligned ``[start, end)``; the label of a result is its
    grouping key.  Batch inputs go through panes (:func:`_pane_extremes`), so
    a reading is aggregated once rather than once per covering window.
    Streams use ``F.window`` directly, whose watermark handling a single
    stateful aggregate keeps simple (add a watermark first for append mode).
    """
    size_ms, slide_ms = interval_ms(size), interval_ms(slide) if slide else interval_ms(size)
    if panes is None:
        panes = not df.isStreaming
    if panes and size_ms and slide_ms:
        return _pane_extremes(df, size_ms, slide_ms, cols)
    return _direct_extremes(df, size, slide, cols)


def salted_extremes(df: DataFrame, n_salts: int = 8, size: str = config.WINDOW_SIZE,
                    slide: str = config.WINDOW_SLIDE, cols: Cols = READING_COLS) -> DataFrame:
    """Two-phase form of :func:`sliding_extremes` spreading each key over salts.

    Phase 1 groups by (salt, dataset, window), phase 2 merges by (dataset,
    window): max of maxima, min of minima, sum of counts.  Batch inputs use
    panes for phase 1 (salt, dataset, pane), as :func:`sliding_extremes` does.  The salt is a hash
    of the row's order column, not ``rand()``, so a retried task assigns the
    same salts.  Spark's partial aggregation already combines hot keys
    map-side; the explicit salt additionally splits a hot key's *final*
    aggregation over ``n_salts`` reducers.
    """
    salt = F.pmod(F.xxhash64(F.col(cols.order)), F.lit(n_salts))
    size_ms, slide_ms = interval_ms(size), interval_ms(slide) if slide else interval_ms(size)
    if not df.isStreaming and size_ms and slide_ms:
        return _pane_extremes(df, size_ms, slide_ms, cols, salt=salt)
    phase1 = (
        df.select(cols.dataset, cols.ts, cols.value, salt.alias("_salt"))
        .groupBy("_salt", F.col(cols.dataset).alias("dataset_id"), window_column(cols.ts, size, slide).alias("w"))
        .agg(
            F.max(cols.value).alias("_max"),
            F.min(cols.value).alias("_min"),
            F.count(F.lit(1)).alias("_n"),
        )
    )
    return (
        phase1.groupBy("dataset_id", "w")
        .agg(F.max("_max").alias("max_value"), F.min("_min").alias("min_value"), F.sum("_n").alias("n"))
        .select("dataset_id", F.col("w.start").alias("win_start"), F.col("w.end").alias("win_end"),
                "max_value", "min_value", "n")
    )

"""Stream forms of the windowed, histogram and dedup operators.

These reuse the batch operators unchanged; what differs is the output mode
and the watermark contract:

* windows in ``append`` mode are emitted once the watermark passes their
  end, so with bounded input the still-open windows are never emitted;
  ``update`` mode (to an upsert sink) emits them as they change;
* a row is dropped as late when its event time is behind the watermark of
  the *previous* micro-batch (Spark's late-event watermark), not judged per
  record;
* the running histogram is an ``update``-mode aggregate keyed by bin.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.config import READING_COLS, Cols
from tidewatch.operators import histogram as hist_ops
from tidewatch.operators import windows


def stream_sliding_extremes(readings: DataFrame, size: str = config.WINDOW_SIZE,
                            slide: str = config.WINDOW_SLIDE, cols: Cols = READING_COLS,
                            panes: bool = False) -> DataFrame:
    """Watermarked readings -> window extremes (append or update mode).

    ``panes=True`` (append mode only) aggregates each reading once into its
    pane, a tumbling window of gcd(size, slide), then builds the sliding
    windows from the panes' event time (``window_time``).  It uses two chained
    stateful aggregates in place of copying every reading into size/slide
    windows.
    """
    if not panes:
        return windows.sliding_extremes(readings, size, slide, cols, panes=False)
    size_ms, slide_ms = windows.interval_ms(size), windows.interval_ms(slide)
    if not (size_ms and slide_ms):
        raise ValueError(f"pane windows need simple durations, got {size!r} / {slide!r}")
    pane = f"{math.gcd(size_ms, slide_ms)} milliseconds"
    per_pane = (
        readings.groupBy(F.col(cols.dataset).alias("dataset_id"), F.window(cols.ts, pane).alias("_p"))
        .agg(F.max(cols.value).alias("_max"), F.min(cols.value).alias("_min"), F.count(F.lit(1)).alias("_n"))
    )
    return (
        per_pane.groupBy("dataset_id", F.window(F.window_time("_p"), size, slide).alias("w"))
        .agg(F.max("_max").alias("max_value"), F.min("_min").alias("min_value"), F.sum("_n").alias("n"))
        .select("dataset_id", F.col("w.start").alias("win_start"), F.col("w.end").alias("win_end"),
                "max_value", "min_value", "n")
    )


def stream_salted_extremes(readings: DataFrame, n_salts: int = 8, size: str = config.WINDOW_SIZE,
                           slide: str = config.WINDOW_SLIDE, cols: Cols = READING_COLS) -> DataFrame:
    """Two-phase salted form.  It chains two stateful aggregates, which Spark
    accepts in ``append`` mode only (update and complete are rejected for a
    possible late-row correctness issue), so windows are emitted once closed;
    for running results use :func:`stream_sliding_extremes` in update mode.
    Streaming aggregation already combines a hot dataset map-side, so the
    salt matters only when one (dataset, window) overloads its reducer."""
    return windows.salted_extremes(readings, n_salts, size, slide, cols)


def stream_histogram(readings: DataFrame, start: float = config.BIN_START, step: float = config.BIN_STEP,
                     count: int = config.BIN_COUNT, cols: Cols = READING_COLS) -> DataFrame:
    """Running per-bin counts; run with ``outputMode("update")``."""
    return hist_ops.histogram(readings, start, step, count, cols)


def stream_drop_repeated_polls(readings: DataFrame, cols: Cols = READING_COLS) -> DataFrame:
    """Drop repeated (device, dataset, ts) within the watermark delay.

    State for a key is kept until the watermark passes its timestamp plus
    the delay; choose the delay to cover how long a platform keeps
    re-serving its latest reading.
    """
    return readings.dropDuplicatesWithinWatermark([cols.device, cols.dataset, cols.ts_ms])

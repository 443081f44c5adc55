"""Mergeable partial results that a ``foreachBatch`` stream carries between batches.

* bin counts: at most one row per bin; a batch's counts are added;
* pane extremes: max, min and count per (dataset, pane), for the panes that a window
  not yet closed can still need; a batch's partials are merged;
* the watermark: the largest event time seen, less the allowed lateness.

(Runs of devices are carried by :mod:`.streaks`.)  A batch aggregates its readings
once per analysis, with map-side partial aggregation, and only those small results
meet the carried ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.config import READING_COLS, Cols
from tidewatch.operators import histogram as hist_ops
from tidewatch.operators import windows

BIN_STATE = "bin double, cnt bigint"
PANE_STATE = "dataset_id string, _pane bigint, _max double, _min double, _n bigint"
CLOCK_STATE = "watermark_us bigint"
#: The watermark before the first reading.
NO_WATERMARK = -(1 << 62)


# -- bins ---------------------------------------------------------------------

def add_counts(state: DataFrame, counts: DataFrame) -> DataFrame:
    """Carried bin counts with a batch's counts added."""
    return state.unionByName(counts).groupBy("bin").agg(F.sum("cnt").alias("cnt"))


def changelog(readings: DataFrame, state: DataFrame, start: float = config.BIN_START, step: float = config.BIN_STEP,
              count: int = config.BIN_COUNT, cols: Cols = READING_COLS, slices: int | None = None) -> DataFrame:
    """The updated count after each reading of a batch, the carried counts included.

    The batch runs through the range-sliced scan, so a hot bin spans many tasks;
    the carried counts (at most ``count`` rows) join as a broadcast.
    """
    counted = hist_ops.histogram_changelog(readings, start, step, count, cols, slices)
    carried = F.broadcast(state.select(F.col("bin").alias("_bin"), F.col("cnt").alias("_carried")))
    return counted.join(carried, F.col("bin") == F.col("_bin"), "left").withColumn(
        "cnt", F.col("cnt") + F.coalesce("_carried", F.lit(0))).drop("_bin", "_carried")


# -- windows ------------------------------------------------------------------

@dataclass(frozen=True)
class WindowStep:
    """What one micro-batch makes of the carried panes."""

    results: DataFrame          # windows to emit
    late: DataFrame             # readings all of whose windows were closed before the batch
    panes: DataFrame            # panes to carry on
    watermark_us: int           # watermark after the batch


def _milliseconds(text: str) -> int:
    ms = windows.interval_ms(text)
    if ms is None:
        raise ValueError(f"windows of carried panes need simple durations, got {text!r}")
    return ms


def is_late(watermark_us: int, size: str, slide: str, cols: Cols = READING_COLS):
    """Readings that no open window covers: the end of the last window around them
    is not after the watermark, or they have no event time at all."""
    us = F.unix_micros(F.col(cols.ts).cast("timestamp"))
    end = windows.last_window_start(us, _milliseconds(slide)) + F.lit(_milliseconds(size) * 1000)
    return F.coalesce(end <= F.lit(watermark_us), F.lit(True))


def advance_windows(readings: DataFrame, panes: DataFrame, watermark_us: int, size: str = config.WINDOW_SIZE,
                    slide: str = config.WINDOW_SLIDE, lateness: str = "0 seconds", mode: str = "append",
                    cols: Cols = READING_COLS) -> WindowStep:
    """One micro-batch of readings (persisted by the caller) with the carried panes.

    ``watermark_us`` is the watermark after the batch before.  A window is closed
    when the watermark reaches its end, and never changes after that; a reading none
    of whose windows is open is late, and every other one is counted in its open
    windows.  ``append`` emits the windows that this batch closes, ``update`` the
    open ones that it changes.
    """
    size_ms, slide_ms = _milliseconds(size), _milliseconds(slide)
    newest = readings.agg(F.max(F.unix_micros(F.col(cols.ts).cast("timestamp")))).first()[0]
    after = watermark_us if newest is None else max(watermark_us, newest - _milliseconds(lateness) * 1000)
    late = is_late(watermark_us, size, slide, cols)
    added = windows.pane_partials(readings.where(~late), size_ms, slide_ms, cols)
    merged = panes.unionByName(added).groupBy("dataset_id", "_pane").agg(
        F.max("_max").alias("_max"), F.min("_min").alias("_min"), F.sum("_n").alias("_n"))
    whole = windows.windows_of_panes(merged, size_ms, slide_ms)
    end = F.unix_micros("win_end")
    if mode == "append":
        results = whole.where((end > F.lit(watermark_us)) & (end <= F.lit(after)))
    elif mode == "update":
        touched = windows.panes_in_windows(added, size_ms, slide_ms).select(
            F.col("dataset_id").alias("_d"), F.timestamp_micros("_s").alias("_start")).distinct()
        results = whole.where(end > F.lit(watermark_us)).join(
            touched, F.col("dataset_id").eqNullSafe(F.col("_d")) & (F.col("win_start") == F.col("_start")), "left_semi")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    needed = windows.last_window_start(F.col("_pane"), slide_ms) + F.lit(size_ms * 1000) > F.lit(after)
    return WindowStep(results, readings.where(late), merged.where(needed), after)

"""Running histogram of values over fixed stepwise bins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.config import READING_COLS, Cols
from tidewatch.functions.bins import assign_bin
from tidewatch.operators.scan import ordered_running_count


def with_bin(df: DataFrame, start: float = config.BIN_START, step: float = config.BIN_STEP,
             count: int = config.BIN_COUNT, cols: Cols = READING_COLS, out: str = "bin") -> DataFrame:
    return df.withColumn(out, assign_bin(cols.value, start, step, count))


def histogram(df: DataFrame, start: float = config.BIN_START, step: float = config.BIN_STEP,
              count: int = config.BIN_COUNT, cols: Cols = READING_COLS) -> DataFrame:
    """Count of readings per bin: ``bin double, cnt bigint``.

    Keyed by the bin only.  There are at most ``count`` keys, so the
    map-side partial count leaves at most ``count`` rows per task to
    shuffle.  On a stream this is a running count (``update`` mode).
    """
    return (
        df.select(assign_bin(cols.value, start, step, count).alias("bin"))
        .where(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def histogram_changelog(df: DataFrame, start: float = config.BIN_START, step: float = config.BIN_STEP,
                        count: int = config.BIN_COUNT, cols: Cols = READING_COLS,
                        slices: int | None = None) -> DataFrame:
    """The stream of updated counts a running histogram emits, one per reading.

    For each reading, in (ts, order) order: its bin and the bin's count
    including it.  There are only ``count`` bins, so a plain per-bin window
    would put a bin's whole history in one task.  Instead the rows are
    range-sliced on (bin, ts, order) and numbered within balanced slices
    (see :mod:`tidewatch.operators.scan`); a hot bin spans many slices.
    """
    binned = (
        df.select(cols.device, cols.dataset, cols.ts_ms, cols.order,
                  assign_bin(cols.value, start, step, count).alias("bin"))
        .where(F.col("bin").isNotNull())
    )
    return ordered_running_count(binned, "bin", cols.ts_ms, cols.order, out="cnt", slices=slices)

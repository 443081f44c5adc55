"""Removing repeated polls.

A polling collector receives the platform's latest reading again and again
until a new one arrives, so the same (device, dataset, timestamp) shows up
many times.  A reading is dropped when its timestamp equals the previous
reading's of the same (device, dataset); the key must include the dataset
because temperature and humidity share timestamps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import READING_COLS, Cols


def drop_repeated_polls(df: DataFrame, cols: Cols = READING_COLS) -> DataFrame:
    """Keep the first arrival (lowest order value) of each (device, dataset, ts).

    Ordered by timestamp, readings with one timestamp are adjacent, so
    "drop if equal to the previous timestamp" keeps exactly the first of
    each timestamp.  That is a keyed aggregate, not a sorted scan: the
    partial ``min_by`` collapses copies map-side, so even a copy group
    holding a large share of the rows shuffles one row per task.
    """
    keys = [cols.device, cols.dataset, cols.ts_ms]
    return pick_by(df, keys, cols.order, "min")


def pick_by(df: DataFrame, keys, order: str, how: str = "min") -> DataFrame:
    """Per key, the fields of the row with the smallest (or largest) ``order``.

    One ``min_by``/``max_by`` per column rather than over a packed struct:
    fixed-width buffers keep the plan a hash aggregate with map-side partial
    aggregation (a struct buffer falls back to a sort-based aggregate).
    ``order`` must identify a row within its key (or tied rows must be
    copies), as a reading's sequence number does.
    """
    keys = list(keys)
    pick = F.min_by if how == "min" else F.max_by
    rest = [c for c in df.columns if c not in keys]
    aggs = [(F.min(order) if how == "min" else F.max(order)).alias(c) if c == order
            else pick(F.col(c), F.col(order)).alias(c) for c in rest]
    return df.groupBy(*keys).agg(*aggs).select(*df.columns)


def distinct_readings(df: DataFrame, cols: Cols = READING_COLS) -> DataFrame:
    """Exact-copy removal on (device, dataset, ts), keeping an arbitrary copy.

    Cheaper than :func:`drop_repeated_polls` when copies are identical,
    which is the case for re-served polls.
    """
    return df.dropDuplicates([cols.device, cols.dataset, cols.ts_ms])

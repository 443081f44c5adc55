"""Rising streaks as a stateful processor: typed value state, event-time timers.

Each device has one value state (run start, last value, count, time of the last
reading) in the RocksDB state store, which writes only what a batch changed.  With an
idle time, a timer per device clears its state when the watermark passes its last
reading by that much, so the store holds active devices only; the device's next
reading then starts a run.  The state can be read back as a table
(:func:`read_streak_state`).

A device's rows of one micro-batch come to one task, as batches in no order; they are
sorted, and the run arithmetic is the batch operator's kernel.  Where one device may
hold a large share of a batch, use :func:`tidewatch.streaming.streaks.streak_writer`.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch import config
from tidewatch.operators.scan import not_null
from tidewatch.session import ship_package
from tidewatch.streaming.streaks import OUTPUT_SCHEMA, advance_streaks

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
STATE = "run"
STATE_FIELDS = "start_ms bigint, prev double, cnt bigint, last_ms bigint"


class StreakProcessor(StatefulProcessor):
    """The streak rule per device; ``idle_ms`` None keeps a device for ever."""

    def __init__(self, limit: int, idle_ms: int | None):
        self.limit, self.idle_ms = limit, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState(STATE, STATE_FIELDS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [p[["ts_ms", "seq", "value"]] for p in rows]
        table = pd.concat(parts, ignore_index=True).sort_values(["ts_ms", "seq"], kind="stable")
        ts = table["ts_ms"].to_numpy("int64")
        held = self.run.get() if self.run.exists() else None
        if held is not None and self.idle_ms is not None and ts[0] - held[3] > self.idle_ms:
            held = None                 # the timer was due, whether or not it has fired yet
        start, counts, after = advance_streaks(ts, table["value"].to_numpy("float64"), held[:3] if held else None)
        last = int(ts[-1]) if held is None else max(int(ts[-1]), held[3])
        self.run.update((*after, last))
        if self.idle_ms is not None:
            for due in list(self.handle.listTimers()):
                self.handle.deleteTimer(due)
            self.handle.registerTimer(last + self.idle_ms)
        hit = counts >= self.limit
        if hit.any():
            yield pd.DataFrame({"device_id": key[0], "start_ms": start[hit], "counts": counts[hit], "ts_ms": ts[hit]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.run.clear()
        return iter(())

    def close(self) -> None:
        pass


def stateful_streaks(readings: DataFrame, limit: int = config.STREAK_LIMIT, idle: int | None = None) -> DataFrame:
    """Alerts (device_id, start_ms, counts, ts_ms) from a watermarked stream of
    readings (append mode).  ``idle`` is in milliseconds.  Needs the RocksDB state
    store provider.  With an idle time Spark drops readings that are not after the
    watermark, so the watermark's delay must cover how far readings come out of order."""
    spark = readings.sparkSession
    if not (spark.conf.get(PROVIDER, "") or "").endswith("RocksDBStateStoreProvider"):
        raise ValueError(f"set {PROVIDER} to {ROCKSDB}: typed state needs it")
    ship_package(spark)
    slim = readings.select(F.col("device_id").cast("string").alias("device_id"), "ts_ms", "seq", "value", "ts").where(
        not_null(["device_id", "ts_ms", "seq", "value"]))
    return slim.groupBy("device_id").transformWithStateInPandas(
        StreakProcessor(limit, idle), OUTPUT_SCHEMA, "append", "EventTime" if idle is not None else "None")


def read_streak_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The devices' states as a table: ``device_id, start_ms, prev, cnt, last_ms``."""
    rows = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    return rows.select(F.col("key.device_id").alias("device_id"), *[
        F.col(f"value.{c.split()[0]}").alias(c.split()[0]) for c in STATE_FIELDS.split(", ")])

"""Rising-streak alarm on a stream, with per-device state.

``applyInPandasWithState`` keeps one small state row per device (run start,
last value, run length) in the checkpointed state store, so restarts and
lost executors resume exactly where the committed batch left off.  Within a
micro-batch a device's rows arrive as Arrow batches in no particular order;
they are sorted by (ts, seq) and the run arithmetic is vectorised with
numpy, with no per-row Python loop.  The rows of one device per micro-batch
are bounded by the trigger size (``maxFilesPerTrigger`` /
``maxOffsetsPerTrigger``); the state itself is constant per device.

Event-time order holds within a batch; across batches rows are taken in
batch order, as an ascending source delivers them.

That operator puts a device's rows of one micro-batch into one task.  Where a
device may hold a large share of a batch, :func:`streak_writer` runs each
micro-batch through the range-sliced scan of the batch operator instead, and
carries the devices' states in a small state table, one row per device.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewatch import config, schemas
from tidewatch.operators.scan import advance_runs, not_null
from tidewatch.operators.streaks import streak_counts
from tidewatch.sinks.owner import claim, query_id
from tidewatch.sinks.upsert import first_per_key
from tidewatch.sinks.versions import read_version, write_version
from tidewatch.session import ship_package

OUTPUT_SCHEMA = "device_id string, start_ms bigint, counts bigint, ts_ms bigint"
STATE_SCHEMA = schemas.STREAK_STATE


def advance_streaks(ts_ms: np.ndarray, values: np.ndarray, state: tuple | None):
    """Run the streak rule over one device's rows, already in order.

    ``state`` is (start_ms, prev, cnt) carried from earlier rows, or None.
    Returns per-row (start_ms, counts) and the new state.  The rule itself is
    the batch operator's kernel, so batch and stream cannot disagree.
    """
    carried = None if state is None else (None, *state)
    start, counts, (_, s, prev, cnt) = advance_runs(None, None, None, ts_ms, values, carried)
    return start, counts, (s, prev, cnt)


def _streak_function(limit: int):
    def step(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        parts = [p[["ts_ms", "seq", "value"]] for p in pdfs]
        rows = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]
        rows = rows.sort_values(["ts_ms", "seq"], kind="stable")
        old = state.get if state.exists else None
        start, counts, new_state = advance_streaks(
            rows["ts_ms"].to_numpy("int64"), rows["value"].to_numpy("float64"), old)
        state.update(new_state)
        hit = counts >= limit
        if hit.any():
            yield pd.DataFrame({
                "device_id": key[0],
                "start_ms": start[hit],
                "counts": counts[hit],
                "ts_ms": rows["ts_ms"].to_numpy("int64")[hit],
            })
    return step


def stream_rising_streaks(readings: DataFrame, limit: int = config.STREAK_LIMIT,
                          device_col: str = "device_id") -> DataFrame:
    """Alerts (device_id, start_ms, counts, ts_ms) from a stream of readings.

    Input needs ``ts_ms``, ``seq`` and ``value``; NaN values must already be
    quarantined.  Output mode is append; state never times out, as the rule
    keeps the last value of a device indefinitely.
    """
    ship_package(readings.sparkSession)
    slim = readings.select(readings[device_col].cast("string").alias("device_id"), "ts_ms", "seq", "value").where(
        not_null(["device_id", "ts_ms", "seq", "value"]))      # as in the batch scan
    return slim.groupBy("device_id").applyInPandasWithState(
        _streak_function(limit), OUTPUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)


_BEFORE = -(1 << 62)        # stands before every timestamp: the row that carries a device's state in
RUN_STATE = "device_id string, start_ms bigint, prev double, cnt bigint, last_ms bigint"


def advance_batch(batch: DataFrame, state: DataFrame | None, slices: int | None = None) -> tuple[DataFrame, DataFrame]:
    """One micro-batch through the range-sliced scan.

    A device's state enters as a row before its first one; rows of the run that
    starts there continue the carried run.  Returns the batch's rows with run
    start and count, and the new state of its devices.
    """
    rows = batch.select(F.col("device_id").cast("string").alias("device_id"), "ts_ms", "seq", "value").where(
        not_null(["device_id", "ts_ms", "seq", "value"]))
    if state is None:
        counted = streak_counts(rows, slices=slices)
    else:
        present = state.join(rows.select("device_id").distinct(), "device_id", "left_semi")
        first = present.select("device_id", F.lit(_BEFORE).alias("ts_ms"), F.lit(_BEFORE).alias("seq"), F.col("prev").alias("value"))
        carried = present.select("device_id", F.col("start_ms").alias("_start"), F.col("cnt").alias("_cnt"))
        goes_on = F.col("start_ms") == _BEFORE
        counted = (
            streak_counts(rows.unionByName(first), slices=slices).where(F.col("ts_ms") > _BEFORE)
            .join(carried, "device_id", "left")
            .withColumn("counts", F.when(goes_on, F.col("counts") - 1 + F.col("_cnt")).otherwise(F.col("counts")))
            .withColumn("start_ms", F.when(goes_on, F.col("_start")).otherwise(F.col("start_ms")))
            .drop("_start", "_cnt")
        )
    return counted, run_ends(counted)


def run_ends(counted: DataFrame) -> DataFrame:
    """Every device's state after its last counted row.  Every copy of a device's
    last reading restarts the run, so the shortest count is that of the last copy."""
    last = first_per_key(counted, ["device_id"], [F.col("ts_ms").desc(), F.col("seq").desc(), F.col("counts").asc()])
    return last.select("device_id", "start_ms", F.col("value").alias("prev"), F.col("counts").alias("cnt"), F.col("ts_ms").alias("last_ms"))


def merged_runs(state: DataFrame, after: DataFrame, idle_ms: int | None = None) -> DataFrame:
    """The state of all devices: ``after`` replaces its devices' rows.  With
    ``idle_ms``, devices whose last reading is that much older than the newest one
    are forgotten; their next reading starts a run."""
    table = state.join(after.select("device_id"), "device_id", "left_anti").unionByName(after)
    if idle_ms is None:
        return table
    newest = table.agg(F.max("last_ms").alias("_newest"))           # one row
    return table.join(F.broadcast(newest), F.col("last_ms") >= F.col("_newest") - F.lit(idle_ms)).drop("_newest")


def streak_writer(state_root: str, sink, limit: int = config.STREAK_LIMIT, slices: int | None = None, idle_ms: int | None = None):
    """``foreachBatch`` function: alerts of each micro-batch to ``sink`` (itself a
    ``foreachBatch`` function), the devices' states to the state table at
    ``state_root``.

    A batch reads the state as of the batch before it, one row per device, however
    many batches there were; a replayed one therefore makes the same alerts again.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        claim(spark, state_root, query_id(batch))
        state = read_version(spark, state_root, RUN_STATE, before=batch_id)
        counted, _ = advance_batch(batch, state, slices)
        counted = counted.persist()
        try:
            sink(counted.where(F.col("counts") >= limit).select("device_id", "start_ms", "counts", "ts_ms"), batch_id)
            write_version(merged_runs(state, run_ends(counted), idle_ms), state_root, batch_id)
        finally:
            counted.unpersist()
    return write

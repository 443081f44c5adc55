"""The rows a dashboard shows, kept up to date by the stream that makes them.

A page that refreshes every few seconds must not sort whole result tables.  Per
micro-batch, the newest windows of each dataset and the newest streak are chosen from
the rows kept so far and the rows the batch changed: at most ``n`` per dataset, and
one.  That is exact, because a window's place in the order is its fixed start, and a
streak only moves up when its count grows: a row that was left out can come in again
only with a change of its own, and then it is among the batch's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.operators import serving
from tidewatch.sinks.upsert import BATCH, first_per_key, resolve
from tidewatch.sinks.versions import read_version, write_version
from tidewatch.streaming.partials import BIN_STATE

WINDOW_ROWS = "dataset_id string, win_start timestamp, max_value double"
STREAK_ROWS = "device_id string, start_ms bigint, counts bigint"


def newest_windows(kept: DataFrame, changed: DataFrame, n: int = config.LATEST_WINDOWS) -> DataFrame:
    """The ``n`` newest windows of each dataset; of a window in both, the changed row."""
    columns = ["dataset_id", "win_start", "max_value"]
    both = kept.select(*columns, F.lit(0).alias(BATCH)).unionByName(changed.select(*columns, F.lit(1).alias(BATCH)))
    return serving.latest_windows(resolve(both, ["dataset_id", "win_start"]), n).select(
        "dataset_id", "win_start", F.col("value").alias("max_value"))


def newest_streak(kept: DataFrame, changed: DataFrame) -> DataFrame:
    """The newest streak of both: by start, then count, then device."""
    columns = ["device_id", "start_ms", "counts"]
    return serving.latest_streak(kept.select(*columns).unionByName(changed.select(*columns))).select(*columns)


def refresh(spark: SparkSession, root: str, batch_id: int, windows: DataFrame, alerts: DataFrame,
            n: int = config.LATEST_WINDOWS) -> None:
    """Bring the kept rows up to date with a micro-batch's windows and alerts."""
    kept = read_version(spark, f"{root}/windows", WINDOW_ROWS, batch_id)
    write_version(newest_windows(kept, windows, n), f"{root}/windows", batch_id)
    best = first_per_key(alerts, ["device_id", "start_ms"], [F.col("counts").desc()])
    write_version(newest_streak(read_version(spark, f"{root}/streak", STREAK_ROWS, batch_id), best), f"{root}/streak", batch_id)


def read_dashboard(spark: SparkSession, state_root: str, temperature: str = config.TEMPERATURE,
                   humidity: str = config.HUMIDITY, n: int = config.LATEST_WINDOWS) -> DataFrame:
    """The one-row dashboard from the kept rows of a combined stream (its
    ``state_root``): bins, ``n`` windows per dataset and one streak are all it reads."""
    root = state_root.rstrip("/")
    return serving.dashboard_snapshot(
        read_version(spark, f"{root}/bins", BIN_STATE),
        read_version(spark, f"{root}/dashboard/windows", WINDOW_ROWS),
        read_version(spark, f"{root}/dashboard/streak", STREAK_ROWS), temperature, humidity, n)

"""Throughput of the ordered scan and of the pane-based sliding windows.

    python tests/scan_throughput.py [rows] [slices]

Writes ``rows`` synthetic readings (a third on one device) to a scratch
folder, then times, warm: the range exchange with sorting, the same plus one
Arrow pass, the full streak alerts, a ``Window.partitionBy(device)`` scan that
keeps the hot device in one task, and the 1 h / 10 min sliding extremes in
pane form and in ``F.window`` form.  The synthetic rows exist only for these
timings; no registered query uses them.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidewatch.operators import scan, streaks, windows  # noqa: E402
from tidewatch.session import local_session, ship_package  # noqa: E402


def main(rows: int, slices: int) -> None:
    scratch = tempfile.mkdtemp(prefix="tidewatch-thru-")
    spark = local_session(8, slices, scratch=scratch)
    ship_package(spark)
    base = spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.xxhash64("id") % 2000).cast("string"))
        .alias("device_id"),
        (F.col("id") * 7 % 100_000_000).alias("ts_ms"), F.col("id").alias("seq"),
        ((F.xxhash64("id", F.lit(1)) % 1000) / 10.0).alias("value"),
        (F.col("id") % 5).cast("string").alias("dataset_id"),
        F.timestamp_millis((F.col("id") * 431) % (30 * 86_400_000)).alias("ts"))
    path = os.path.join(scratch, "rows")
    base.repartition(32).write.parquet(path)
    df = spark.read.parquet(path)

    placed = df.repartitionByRange(slices, "device_id", "ts_ms", "seq").withColumn("_slice", F.spark_partition_id())
    ordered = placed.sortWithinPartitions("device_id", "ts_ms", "seq")
    cols = scan._Cols("device_id", "ts_ms", "seq", "value")
    seg = ("_slice int, k string, is_first boolean, chk bigint, n bigint, first_v double, first_ts bigint, "
           "last_v double, last_start bigint, last_cnt bigint")
    w = Window.partitionBy("device_id").orderBy("ts_ms", "seq")
    plans = {
        "range exchange + sort": ordered,
        "+ one Arrow pass (summary)": ordered.mapInArrow(scan._summarize(cols, scan.RISING), seg),
        "streak alerts (ordered scan)": streaks.rising_streaks(df, 3, slices=slices),
        "per-device window (hot device in one task)": df.select(
            "device_id", F.lag("value").over(w).alias("p"), F.row_number().over(w).alias("r")),
        "sliding extremes, panes": windows.sliding_extremes(df, "1 hour", "10 minutes", panes=True),
        "sliding extremes, F.window": windows.sliding_extremes(df, "1 hour", "10 minutes", panes=False),
    }
    for name, plan in plans.items():
        best = float("inf")
        for _ in range(2):
            t0 = time.perf_counter()
            plan.write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        print(f"{name}: {best:.2f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000, int(sys.argv[2]) if len(sys.argv) > 2 else 64)

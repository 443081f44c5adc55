"""A hot key (a third of all rows) must not land in one task."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import brute_changelog, brute_streaks
from tidewatch.functions.timefmt import ms_to_ts
from tidewatch.operators import histogram, streaks

HOUR = 3_600_000
SLICES = 24


def _hot_readings(spark, n=6000, seed=5, burst=False):
    """A third of the rows belong to device "hot".  With ``burst`` all of its
    rows share one timestamp, which no split by time can break up."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        dev = "hot" if hot else f"d{rnd.randint(0, 199)}"
        ts = 7 * HOUR if (burst and hot) else rnd.randint(0, 48 * HOUR)
        rows.append((dev, "temperature_data", ts, round(rnd.uniform(20, 40), 1), i))
    df = spark.createDataFrame(rows, "device_id string, dataset_id string, ts_ms long, value double, seq long")
    return rows, df.withColumn("ts", ms_to_ts("ts_ms"))


def _with_static_plan(spark, fn):
    keys = ["spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("burst", [False, True])
def test_hot_device_is_split_across_tasks(spark, burst):
    rows, df = _hot_readings(spark, burst=burst)

    def shares():
        out = streaks.streak_counts(df, slices=SLICES)
        per_task = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        hot = out.where(F.col("device_id") == "hot").groupBy(F.spark_partition_id().alias("p")).count().collect()
        return [r["count"] for r in per_task], [r["count"] for r in hot]

    per_task, hot = _with_static_plan(spark, shares)
    total = sum(per_task)
    assert total == len(rows)
    assert len(hot) >= 6                      # the hot device spans many tasks
    assert max(per_task) / total < 0.25       # no task holds the hot device's third

    alerts = streaks.rising_streaks(df, 3, slices=SLICES)
    got = sorted(tuple(r) for r in alerts.select("device_id", "start_ms", "counts", "ts_ms").collect())
    assert got == brute_streaks([(d, t, s, v) for d, _, t, v, s in rows], 3)


@pytest.mark.parametrize("burst", [False, True])
def test_hot_bin_changelog_is_split(spark, burst):
    rows, df = _hot_readings(spark, burst=burst)
    df = df.withColumn("value", F.lit(30.2))     # every reading in one bin

    def shares():
        out = histogram.histogram_changelog(df, slices=SLICES)
        return [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()], out

    per_task, out = _with_static_plan(spark, shares)
    assert len(per_task) >= 6 and max(per_task) / sum(per_task) < 0.3
    got = sorted((r.seq, r.bin, r.cnt) for r in out.collect())
    assert got == brute_changelog([(s, t, 30.2) for _, _, t, _, s in rows], 25.5, 0.5, 20)


def test_scan_refuses_mismatched_slicing(spark):
    """Without exchange reuse the two passes sample their own slice bounds;
    the scan must fail rather than return wrong counts."""
    _, df = _hot_readings(spark)
    keys = {"spark.sql.exchange.reuse": "false",
            "spark.sql.execution.rangeExchange.sampleSizePerPartition": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        with pytest.raises(Exception, match="different range slices"):
            streaks.streak_counts(df, slices=SLICES).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("batch_rows", ["10000", "7"])
def test_run_spanning_many_slices(spark, batch_rows):
    """One device rising for 1000 readings crosses every slice: each slice is
    all open rows, and the carry must chain through all of them (and through
    every Arrow batch of a slice)."""
    rows = [("up", "temperature_data", t, float(t), t) for t in range(1000)]
    rows += [(f"d{i}", "temperature_data", i, 1.0, 5000 + i) for i in range(50)]
    df = spark.createDataFrame(rows, "device_id string, dataset_id string, ts_ms long, value double, seq long")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    try:
        out = streaks.streak_counts(df.withColumn("ts", ms_to_ts("ts_ms")), slices=16)
        got = {r.seq: (r.start_ms, r.counts) for r in out.where("device_id = 'up'").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == {t: (0, t + 1) for t in range(1000)}


def test_running_count_string_keys_any_slicing(spark):
    from tidewatch.operators import scan
    rnd = random.Random(11)
    rows = [(rnd.choice(["a", "b", "hot", "hot", "hot"]), rnd.randint(0, 20), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, ts long, seq long")
    want = {}
    seen = {}
    for k, t, s in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        seen[k] = seen.get(k, 0) + 1
        want[s] = seen[k]
    for slices in (1, 5, 23):
        got = {r.seq: r.n for r in scan.ordered_running_count(df, "k", "ts", "seq", out="n", slices=slices).collect()}
        assert got == want


@pytest.mark.parametrize("slices", [1, 3, 8])
def test_state_carries_across_arrow_batches(spark, slices):
    """Tiny Arrow batches: a slice arrives in many batches, so segments and
    runs must carry from batch to batch inside the slice."""
    rows, df = _hot_readings(spark, n=900, seed=9)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for limit in (1, 2, 3):
            got = sorted(tuple(r) for r in streaks.rising_streaks(df, limit, slices=slices)
                         .select("device_id", "start_ms", "counts", "ts_ms").collect())
            assert got == brute_streaks([(d, t, s, v) for d, _, t, v, s in rows], limit)
        binned = df.withColumn("value", F.lit(25.0) + (F.col("seq") % 7) * 0.5)
        got = sorted((r.seq, r.bin, r.cnt) for r in histogram.histogram_changelog(binned, slices=slices).collect())
        want = brute_changelog([(s, t, 25.0 + (s % 7) * 0.5) for _, _, t, _, s in rows], 25.5, 0.5, 20)
        assert got == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def _default_conf(spark):
    """Adaptive settings as a user finds them, on data that they would merge."""
    keys = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "24k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
            "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    return old


def test_scans_meet_in_a_union_at_default_slices(spark):
    """Two scans in one union: adaptive execution must not resize the slices of
    either pass (the count is explicit)."""
    rows, df = _hot_readings(spark, n=6000, seed=13)
    other_rows, other = _hot_readings(spark, n=5000, seed=14, burst=True)
    old = _default_conf(spark)
    try:
        cols = ["device_id", "start_ms", "counts", "ts_ms"]
        both = streaks.rising_streaks(df, 2).select(*cols).unionByName(streaks.rising_streaks(other, 2).select(*cols))
        got = sorted(tuple(r) for r in both.collect())
        counted = histogram.histogram_changelog(df).select("seq", "bin", "cnt").unionByName(
            histogram.histogram_changelog(other).select("seq", "bin", "cnt"))
        logs = sorted((r.seq, r.bin, r.cnt) for r in counted.collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)

    def plain(some):
        return [(d, t, s, v) for d, _, t, v, s in some]
    assert got == sorted(brute_streaks(plain(rows), 2) + brute_streaks(plain(other_rows), 2))
    want = [brute_changelog([(s, t, v) for _, _, t, v, s in some], 25.5, 0.5, 20) for some in (rows, other_rows)]
    assert logs == sorted(want[0] + want[1])


def test_copies_of_one_tuple_are_split(spark):
    """Half of the rows are copies of one (device, ts, seq): no slice holds them all."""
    n = 6000
    rows = [("hot", "temperature_data", 5, 30.0, 7) for _ in range(n // 2)]
    rows += [(f"d{i % 50}", "temperature_data", i, float(i % 9), 10 + i) for i in range(n // 2)]
    df = spark.createDataFrame(rows, "device_id string, dataset_id string, ts_ms long, value double, seq long")

    def shares():
        out = streaks.streak_counts(df, slices=SLICES)
        return [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()], out

    per_task, out = _with_static_plan(spark, shares)
    assert sum(per_task) == n and max(per_task) < 3 * n / SLICES
    got = sorted((r.device_id, r.start_ms, r.counts, r.ts_ms) for r in out.collect())
    assert got == brute_streaks([(d, t, s, v) for d, _, t, v, s in rows], 1)


def test_rows_without_a_place_in_the_order_are_returned(spark):
    from tidewatch.operators.scan import unordered_rows
    rows = [("a", 1, 1, 1.0), ("a", None, 2, 2.0), (None, 3, 3, 3.0), ("a", 4, 4, None), ("a", 5, None, 5.0)]
    df = spark.createDataFrame(rows, "device_id string, ts_ms long, seq long, value double")
    left = unordered_rows(df, "device_id", "ts_ms", "seq", "value")
    assert left.count() == 4
    assert streaks.streak_counts(df, slices=3).count() == 1

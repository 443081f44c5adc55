"""S3: growing files; T1/U5 on typed state; Q6 as a stream-stream join."""

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from test_streaming import _events_dir, run_to_memory, write_line_files
from tidewatch.config import EVENTS
from tidewatch.operators import serving, streaks, windows
from tidewatch.plans import jobs
from tidewatch.sinks.upsert import read_table
from tidewatch.sources import growing
from tidewatch.sources.tables import readings
from tidewatch.streaming import stateful
from tidewatch.streaming.joins import stream_temp_humi
from tidewatch.streaming.readers import events_stream, line_readings_stream, with_event_time
from tidewatch.operators.cleaning import lines_to_readings


def append(path, text):
    with open(path, "a") as f:
        f.write(text)


def read_on(spark, folder, ck, **options):
    """Run what is there to read; returns the lines of the run."""
    seen = []
    q = (growing.growing_lines(spark, folder, **options).writeStream.foreachBatch(lambda b, _: seen.extend(r.value for r in b.collect()))
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    return seen


def test_appended_bytes_are_read_once_across_restarts(spark, tmp_dir):
    folder, ck = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "ck")
    os.makedirs(folder)
    log = os.path.join(folder, "readings.log")
    append(log, "one\ntwo\nthr")
    assert read_on(spark, folder, ck) == ["one", "two"]             # the last line is still being written
    assert read_on(spark, folder, ck) == []
    append(log, "ee\r\nfour é\n")
    assert read_on(spark, folder, ck) == ["three", "four é"]
    append(log, "five\n")
    append(os.path.join(folder, "other.log"), "six\nseven\n")
    append(os.path.join(folder, "empty.log"), "")
    assert sorted(read_on(spark, folder, ck)) == ["five", "seven", "six"]
    assert read_on(spark, folder, ck) == []


def test_rotation_goes_on_at_the_position(spark, tmp_dir):
    folder, ck = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "ck")
    os.makedirs(folder)
    log = os.path.join(folder, "a.log")
    append(log, "first\nsecond\n")
    assert read_on(spark, folder, ck, suffix=".log") == ["first", "second"]
    append(log, "third\n")
    os.rename(log, os.path.join(folder, "a.1.log"))
    append(log, "new first\nnew second\n")
    assert sorted(read_on(spark, folder, ck, suffix=".log")) == ["new first", "new second", "third"]
    append(log, "new third\n")
    assert read_on(spark, folder, ck, suffix=".log") == ["new third"]


def test_a_backlog_is_cut_into_partitions_at_any_byte(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "log")
    os.makedirs(folder)
    rnd = random.Random(1)
    lines = ["x" * rnd.choice((0, 1, 5, 200, 70_000)) + str(k) for k in range(120)]
    append(os.path.join(folder, "a.log"), "\n".join(lines) + "\n")
    for size in (1000, 65536):
        reader = growing.GrowingLinesReader({"path": folder, "partitionBytes": str(size)})
        end = reader.latestOffset()
        parts = reader.partitions({}, end)
        assert len(parts) > 10
        assert [t[0] for p in parts for t in reader.read(p)] == lines
    assert growing.position(end) == {os.path.join(folder, "a.log"): os.path.getsize(os.path.join(folder, "a.log"))}
    stream = read_on(spark, folder, os.path.join(tmp_dir, "ck"), partitionBytes=100_000)
    assert sorted(stream) == sorted(lines)


def test_files_of_the_same_first_line_are_told_apart(tmp_dir):
    for name in ("a.log", "b.log"):
        append(os.path.join(tmp_dir, name), f"header\n{name}\n")
    reader = growing.GrowingLinesReader({"path": tmp_dir})
    end = reader.latestOffset()
    assert len(end) == 2
    assert sorted(t[0] for p in reader.partitions({}, end) for t in reader.read(p)) == ["a.log", "b.log", "header", "header"]


def test_growing_files_feed_a_job(spark, tmp_dir):
    folder, root, ck = (os.path.join(tmp_dir, n) for n in ("log", "hist", "ck"))
    os.makedirs(folder)
    log = os.path.join(folder, "r.log")

    def run():
        lines = growing.growing_lines(spark, folder)
        jobs.start_histogram_stream(with_event_time(lines_to_readings(lines)), root, checkpoint_root=ck, trigger={"availableNow": True}).awaitTermination()
        return {r.bin: r.cnt for r in read_table(spark, root).collect()}

    append(log, "dev-1,temperature_data,1648607463508,30.1\ndev-1,temperature_da")
    assert run() == {30.5: 1}
    append(log, "ta,1648607465903,26.0\n")
    assert run() == {30.5: 1, 26.0: 1}


# -- T1 on typed state --------------------------------------------------------

@pytest.fixture()
def rocksdb(spark):
    old = spark.conf.get(stateful.PROVIDER, None)
    spark.conf.set(stateful.PROVIDER, stateful.ROCKSDB)
    yield
    spark.conf.set(stateful.PROVIDER, old) if old else spark.conf.unset(stateful.PROVIDER)


def run_streaks(df, name, ck):
    q = (df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_typed_state_equals_batch_and_is_read_back(spark, tmp_dir, rocksdb):
    src, ck = _events_dir(spark, tmp_dir), os.path.join(tmp_dir, "ck")
    stream = events_stream(spark, src, max_files_per_trigger=1).where(F.col("dataset_id") == EVENTS.temperature)
    run_streaks(stateful.stateful_streaks(stream, EVENTS.streak_limit), "typed", ck)
    temp = readings(spark, SF_SMALL).where(F.col("dataset_id") == EVENTS.temperature)
    alerts = streaks.rising_streaks(temp, EVENTS.streak_limit)
    want = sorted(tuple(r) for r in alerts.select("device_id", "start_ms", "counts", "ts_ms").collect())
    assert sorted(tuple(r) for r in spark.table("typed").collect()) == want and want
    held = {r.device_id: (r.start_ms, r.prev, r.cnt, r.last_ms) for r in stateful.read_streak_state(spark, ck).collect()}
    ends = {}
    for r in streaks.streak_counts(temp).orderBy("ts_ms", "seq").collect():
        ends[r.device_id] = (r.start_ms, r.value, r.counts, r.ts_ms)
    assert held == ends


def test_idle_devices_expire(spark, tmp_dir, rocksdb):
    first = 1_000_000

    def ln(dev, ms, v):
        return f"{dev},temperature_data,{first + ms},{v}"
    src, ck = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "ck")
    write_line_files(src, [[ln("a", 0, 1), ln("b", 1000, 1)], [ln("a", 60_000, 2)], [ln("a", 70_000, 3)], [ln("b", 71_000, 2), ln("a", 72_000, 4)]])
    stream = line_readings_stream(spark, src, max_files_per_trigger=1)
    run_streaks(stateful.stateful_streaks(stream, 2, idle=65_000), "idle", ck)
    got = sorted((r.device_id, r.start_ms - first, r.counts) for r in spark.table("idle").collect())
    assert got == [("a", 0, 2), ("a", 0, 3), ("a", 0, 4)]           # b was idle for 70 s: its run starts anew
    held = {r.device_id: (r.start_ms - first, r.cnt) for r in stateful.read_streak_state(spark, ck).collect()}
    assert held == {"a": (0, 4), "b": (71_000, 1)}


def test_typed_state_needs_its_provider(spark):
    old = spark.conf.get(stateful.PROVIDER, None)
    spark.conf.set(stateful.PROVIDER, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        with pytest.raises(ValueError, match="RocksDB"):
            stateful.stateful_streaks(readings(spark, SF_SMALL))
    finally:
        spark.conf.set(stateful.PROVIDER, old) if old else spark.conf.unset(stateful.PROVIDER)


# -- Q6 on streams ------------------------------------------------------------

def test_stream_join_equals_batch_on_closed_windows(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    rnd = random.Random(6)
    lines = []
    for t in range(0, 600, 7):
        if not 200 < t < 320:
            lines.append((t, f"dev-1,temperature_data,{t * 1000},{20 + rnd.random() * 9}"))
        if not 380 < t < 500:
            lines.append((t, f"dev-1,humidity_data,{t * 1000 + 3},{40 + rnd.random() * 9}"))
    cut = [[x for t, x in lines if lo <= t < lo + 200] for lo in (0, 200, 400)]
    write_line_files(src, cut)
    q = run_to_memory(stream_temp_humi(line_readings_stream(spark, src, max_files_per_trigger=1)), "paired")
    got = sorted((r.win_start, r.winstart, r.temp_max, r.humi_max) for r in spark.table("paired").collect())
    r = lines_to_readings(spark.createDataFrame([(x,) for _, x in lines], "value string"))
    whole = {x.win_start: tuple(x) for x in serving.temp_humi_by_window(windows.sliding_extremes(r)).collect()}
    assert got and len({g[0] for g in got}) == len(got)
    assert all(whole[g[0]] == g for g in got)
    assert any(g[2] is None for g in got) and any(g[3] is None for g in got) and any(None not in g for g in got)
    # every window that closed well before the end is there, and the state holds open ones only
    last = max(t for t, _ in lines) * 1000
    assert {w for w in whole if w.timestamp() * 1000 + 120_000 < last} <= {g[0] for g in got}
    held = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in q.recentProgress if p["stateOperators"]]
    assert held[-1] <= 60

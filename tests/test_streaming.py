import os
import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewatch.config import EVENTS
from tidewatch.operators import dedup, histogram, streaks, windows
from tidewatch.plans import jobs
from tidewatch.sinks.upsert import read_table
from tidewatch.sources.tables import load_table, readings
from tidewatch.streaming.operators import stream_drop_repeated_polls, stream_salted_extremes, stream_sliding_extremes
from tidewatch.streaming.readers import events_stream, line_readings_stream
from tidewatch.streaming.streaks import advance_streaks, stream_rising_streaks

import numpy as np


def write_line_files(directory, batches):
    """One text file per micro-batch, with increasing modification times."""
    os.makedirs(directory, exist_ok=True)
    now = time.time() - 1000
    for i, rows in enumerate(batches):
        path = os.path.join(directory, f"part-{i:03d}.txt")
        with open(path, "w") as f:
            f.write("\n".join(rows) + "\n")
        os.utime(path, (now + i * 10, now + i * 10))


def run_to_memory(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def test_advance_streaks_carries_state():
    ts = np.array([0, 1, 2, 3], dtype="int64")
    v = np.array([1.0, 2.0, 3.0, 3.0])
    s, c, st = advance_streaks(ts, v, None)
    assert list(c) == [1, 2, 3, 1] and list(s) == [0, 0, 0, 3] and st == (3, 3.0, 1)
    s2, c2, st2 = advance_streaks(np.array([4, 5], dtype="int64"), np.array([4.0, 5.0]), st)
    assert list(c2) == [2, 3] and list(s2) == [3, 3] and st2 == (3, 5.0, 3)


def test_stream_streaks_three_batches_two_devices(spark, tmp_dir):
    vals = [(0, 1.0), (1, 2.0), (2, 3.0), (3, 3.0), (4, 4.0), (5, 5.0), (6, 6.0), (7, 2.0)]
    def line(dev, t, v):
        return f"{dev},temperature_data,{1_000_000 + t * 1000},{v}"
    rows = [line("a", t, v) for t, v in vals] + [line("b", t, 10 - v) for t, v in vals]
    order = sorted(rows, key=lambda r: int(r.split(",")[2]))
    # split after ts 1 and after ts 4 (both devices interleaved in each file)
    cut = lambda r: int(r.split(",")[2])
    b1 = [r for r in order if cut(r) <= 1_001_000]
    b2 = [r for r in order if 1_001_000 < cut(r) <= 1_004_000]
    b3 = [r for r in order if cut(r) > 1_004_000]
    src = os.path.join(tmp_dir, "in")
    write_line_files(src, [b1, b2, b3])
    r = line_readings_stream(spark, src, max_files_per_trigger=1)
    q = run_to_memory(stream_rising_streaks(r, 3), "streak_out")
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    got = sorted((x.device_id, x.start_ms - 1_000_000, x.counts) for x in spark.table("streak_out").collect())
    assert got == [("a", 0, 3), ("a", 3000, 3), ("a", 3000, 4)]


def test_g5_late_rows_use_previous_batch_watermark(spark, tmp_dir):
    def ln(ms, v):
        return f"dev-1,humidity_data,{ms},{v}"
    src = os.path.join(tmp_dir, "in")
    write_line_files(src, [
        [ln(0, 1), ln(61000, 2), ln(130000, 3)],
        [ln(5000, 9), ln(125000, 4)],
        [ln(5001, 9.5), ln(300000, 5)],
    ])
    r = line_readings_stream(spark, src, delay="0 seconds", max_files_per_trigger=1)
    q = run_to_memory(stream_sliding_extremes(r), "late_out")
    out = spark.table("late_out").collect()
    maxima = {x.max_value for x in out}
    assert 9.0 in maxima          # late row of batch 2 still counted
    assert 9.5 not in maxima      # late row of batch 3 dropped
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                  if p["stateOperators"])
    assert dropped == 6           # its six windows


def _events_dir(spark, tmp_dir, parts=4):
    """The sf0.001 events table copied into ``parts`` files in time order."""
    e = load_table(spark, SF_SMALL, "events")
    lo, hi = e.agg(F.min("event_id"), F.max("event_id")).first()
    step = (hi - lo) // parts + 1
    d = os.path.join(tmp_dir, "events")
    now = time.time() - 1000
    for i in range(parts):
        sub = os.path.join(tmp_dir, f"tmp{i}")
        e.where((F.col("event_id") >= lo + i * step) & (F.col("event_id") < lo + (i + 1) * step)) \
            .coalesce(1).write.parquet(sub)
        os.makedirs(d, exist_ok=True)
        for f in os.listdir(sub):
            if f.endswith(".parquet"):
                target = os.path.join(d, f"p{i}.parquet")
                os.link(os.path.join(sub, f), target)
                os.utime(target, (now + i * 10, now + i * 10))
    return d


def test_streaming_jobs_equal_batch(spark, tmp_dir):
    src = _events_dir(spark, tmp_dir)
    p = jobs.JobParams(temperature=EVENTS.temperature, bin_start=EVENTS.bin_start, bin_step=EVENTS.bin_step,
                       bin_count=EVENTS.bin_count, window_size=EVENTS.window_size,
                       window_slide=EVENTS.window_slide, streak_limit=EVENTS.streak_limit)
    stream = events_stream(spark, src, max_files_per_trigger=1)
    roots = {k: os.path.join(tmp_dir, k) for k in ("histogram", "windows", "streaks")}
    ck = os.path.join(tmp_dir, "ck")
    qs = [
        jobs.start_histogram_stream(stream, roots["histogram"], p, ck, {"availableNow": True}),
        jobs.start_window_stream(stream, roots["windows"], p, ck, {"availableNow": True}, mode="update"),
        jobs.start_streak_stream(stream, roots["streaks"], p, ck, {"availableNow": True}),
    ]
    for q in qs:
        q.awaitTermination()
        assert q.exception() is None

    batch = readings(spark, SF_SMALL)
    temp = batch.where(F.col("dataset_id") == EVENTS.temperature)

    h_stream = sorted(tuple(r) for r in read_table(spark, roots["histogram"]).collect())
    h_batch = sorted(tuple(r) for r in histogram.histogram(temp, p.bin_start, p.bin_step, p.bin_count).collect())
    assert h_stream == h_batch

    w_stream = sorted(tuple(r) for r in read_table(spark, roots["windows"]).select(
        "dataset_id", "win_start", "max_value", "min_value", "n").collect())
    w_batch = sorted(tuple(r) for r in windows.sliding_extremes(batch, p.window_size, p.window_slide).select(
        "dataset_id", "win_start", "max_value", "min_value", "n").collect())
    assert w_stream == w_batch

    s_stream = sorted(tuple(r) for r in read_table(spark, roots["streaks"]).select(
        "device_id", "start_ms", "counts").collect())
    s_batch = sorted(tuple(r) for r in streaks.streak_table(streaks.rising_streaks(temp, p.streak_limit)).select(
        "device_id", "start_ms", "counts").collect())
    assert s_stream == s_batch and len(s_batch) > 0


def test_stream_dedup_within_watermark(spark, tmp_dir):
    rows = [f"dev-1,humidity_data,{1_000_000 + 2000 * (i // 3)},{40 + i // 3}" for i in range(30)]
    src = os.path.join(tmp_dir, "in")
    write_line_files(src, [rows[:10], rows[10:20], rows[20:]])
    r = line_readings_stream(spark, src, delay="10 minutes", max_files_per_trigger=1)
    run_to_memory(stream_drop_repeated_polls(r), "dedup_out")
    got = spark.table("dedup_out")
    assert got.count() == 10
    batch = dedup.drop_repeated_polls(spark.createDataFrame(
        [(x.split(",")[0], x.split(",")[1], int(x.split(",")[2]), float(x.split(",")[3]), i)
         for i, x in enumerate(rows)], "device_id string, dataset_id string, ts_ms long, value double, seq long"))
    assert sorted(r.ts_ms for r in got.collect()) == sorted(r.ts_ms for r in batch.collect())


def test_salted_stream_equals_plain_stream_in_append_mode(spark, tmp_dir):
    src = os.path.join(tmp_dir, "ev")
    load_table(spark, SF_SMALL, "events").write.parquet(src)
    r = events_stream(spark, src, delay="10 minutes")
    run_to_memory(stream_sliding_extremes(r, EVENTS.window_size, EVENTS.window_slide), "plain_out")
    run_to_memory(stream_salted_extremes(r, 4, EVENTS.window_size, EVENTS.window_slide), "salted_out")
    plain = sorted(tuple(x) for x in spark.table("plain_out").collect())
    salted = sorted(tuple(x) for x in spark.table("salted_out").collect())
    assert plain and salted == plain


def test_tail_source_resumes_from_checkpoint(spark, tmp_dir):
    """S3: files dropped into a folder are read once; a restart with the same
    checkpoint reads only the new file."""
    from tidewatch.sources.files import tail_source
    folder, ck = os.path.join(tmp_dir, "drop"), os.path.join(tmp_dir, "ck")
    os.makedirs(folder)
    seen = []

    def collect(batch, _id):
        seen.extend(r.value for r in batch.collect())

    def run():
        q = (tail_source(spark, folder, max_files_per_trigger=1).writeStream.foreachBatch(collect)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()

    with open(os.path.join(folder, "a.txt"), "w") as fh:
        fh.write("dev-1,temperature_data,1,30.0\n")
    run()
    with open(os.path.join(folder, "b.txt"), "w") as fh:
        fh.write("dev-1,temperature_data,2,31.0\n")
    run()
    assert seen == ["dev-1,temperature_data,1,30.0", "dev-1,temperature_data,2,31.0"]


def test_pane_stream_equals_plain_stream_in_append_mode(spark, tmp_dir):
    src = os.path.join(tmp_dir, "ev")
    load_table(spark, SF_SMALL, "events").write.parquet(src)
    r = events_stream(spark, src, delay="10 minutes")
    run_to_memory(stream_sliding_extremes(r, EVENTS.window_size, EVENTS.window_slide), "direct_win")
    run_to_memory(stream_sliding_extremes(r, EVENTS.window_size, EVENTS.window_slide, panes=True), "pane_win")
    direct = sorted(tuple(x) for x in spark.table("direct_win").collect())
    pane = sorted(tuple(x) for x in spark.table("pane_win").collect())
    assert direct and pane == direct


def test_window_job_append_mode_equals_batch_closed_windows(spark, tmp_dir):
    """J3 in append mode (pane form) writes each closed window once, with the
    same values the batch job computes for it."""
    from tidewatch.sinks.append import read_appended
    src = _events_dir(spark, tmp_dir)
    p = jobs.JobParams(window_size=EVENTS.window_size, window_slide=EVENTS.window_slide)
    stream = events_stream(spark, src, delay="0 seconds", max_files_per_trigger=1)
    root = os.path.join(tmp_dir, "win_append")
    q = jobs.start_window_stream(stream, root, p, os.path.join(tmp_dir, "ck"), {"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    cols = ["dataset_id", "win_start", "max_value", "min_value", "n"]
    got = sorted(tuple(r) for r in read_appended(spark, root).select(*cols).collect())
    batch = {tuple(r)[:2]: tuple(r) for r in windows.sliding_extremes(
        readings(spark, SF_SMALL), p.window_size, p.window_slide).select(*cols).collect()}
    assert got and len(set(got)) == len(got)
    assert all(batch[g[:2]] == g for g in got)


def test_g5_late_rows_same_in_pane_form(spark, tmp_dir):
    """The append-mode pane form keeps and drops the same late rows as F.window."""
    def ln(ms, v):
        return f"dev-1,humidity_data,{ms},{v}"
    got = {}
    for panes in (False, True):
        src = os.path.join(tmp_dir, f"in{panes}")
        write_line_files(src, [
            [ln(0, 1), ln(61000, 2), ln(130000, 3)],
            [ln(5000, 9), ln(125000, 4)],
            [ln(5001, 9.5), ln(300000, 5)],
        ])
        r = line_readings_stream(spark, src, delay="0 seconds", max_files_per_trigger=1)
        run_to_memory(stream_sliding_extremes(r, panes=panes), f"g5_{panes}")
        got[panes] = sorted(tuple(x) for x in spark.table(f"g5_{panes}").collect())
    assert got[True] == got[False]
    assert 9.0 in {x[3] for x in got[True]} and 9.5 not in {x[3] for x in got[True]}

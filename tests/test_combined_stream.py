"""J1 as one query with one reader, and what rests on its carried partial results:
late rows (W4), the streaming changelog (A2), maintained dashboard rows (Q1, Q3)."""

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sample_lines import sample_lines
from test_streaming import _events_dir, write_line_files
from tidewatch.config import EVENTS
from tidewatch.operators import histogram, serving, streaks, windows
from tidewatch.plans import jobs, pipelines
from tidewatch.sinks.append import read_appended
from tidewatch.sinks.upsert import first_per_key, read_table
from tidewatch.sinks.versions import read_version, versions
from tidewatch.sources.files import text_stream
from tidewatch.sources.tables import readings
from tidewatch.streaming import combined, maintained, partials
from tidewatch.streaming.readers import events_stream, line_readings_stream

WINDOW = ["dataset_id", "win_start", "max_value", "min_value", "n"]
NAMES = ("histogram", "windows", "streaks", "quarantine", "late", "changelog", "dashboard", "state")
READING = "device_id string, dataset_id string, ts_ms long, value double, ts timestamp, seq long"


def rows_of(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def event_params(**more):
    return jobs.JobParams(temperature=EVENTS.temperature, bin_start=EVENTS.bin_start, bin_step=EVENTS.bin_step,
                          bin_count=EVENTS.bin_count, window_size=EVENTS.window_size, window_slide=EVENTS.window_slide,
                          streak_limit=EVENTS.streak_limit, **more)


def test_input_is_read_once_and_results_equal_batch(spark, tmp_dir):
    src = _events_dir(spark, tmp_dir)
    p = event_params()
    roots = {k: os.path.join(tmp_dir, k) for k in ("histogram", "windows", "streaks", "changelog", "dashboard", "state")}
    stream = events_stream(spark, src, max_files_per_trigger=1)
    q = jobs.start_combined_stream(stream, roots, p, os.path.join(tmp_dir, "ck"), {"availableNow": True}, mode="update")
    q.awaitTermination()
    assert q.exception() is None
    batch = readings(spark, SF_SMALL)
    per_batch = [r["numInputRows"] for r in q.recentProgress if r["numInputRows"]]
    assert len(per_batch) == 4 and sum(per_batch) == batch.count()         # each row once, for all analyses
    temp = batch.where(F.col("dataset_id") == EVENTS.temperature)
    assert rows_of(read_table(spark, roots["histogram"])) == rows_of(histogram.histogram(temp, p.bin_start, p.bin_step, p.bin_count))
    assert rows_of(read_table(spark, roots["windows"]), *WINDOW) == rows_of(windows.sliding_extremes(batch, p.window_size, p.window_slide), *WINDOW)
    alerts = streaks.rising_streaks(temp, p.streak_limit)
    assert rows_of(read_table(spark, roots["streaks"]), "device_id", "start_ms", "counts") == rows_of(streaks.streak_table(alerts))
    log = histogram.histogram_changelog(temp, p.bin_start, p.bin_step, p.bin_count)
    assert rows_of(read_appended(spark, roots["changelog"]).drop("batch"), *log.columns) == rows_of(log)
    # the dashboard's rows equal those of the whole tables, and are few
    whole = pipelines.dashboard_of_tables(histogram.histogram(temp, p.bin_start, p.bin_step, p.bin_count),
                                          windows.sliding_extremes(batch, p.window_size, p.window_slide), streaks.streak_table(alerts), EVENTS)
    shown = maintained.read_dashboard(spark, roots["state"], EVENTS.temperature, EVENTS.humidity)
    assert shown.collect() == whole.collect()
    kept = read_version(spark, f"{roots['state']}/dashboard/windows", maintained.WINDOW_ROWS)
    assert kept.count() == 5 * batch.select("dataset_id").distinct().count()


def test_lines_with_quarantine_and_console(spark, tmp_dir, capsys):
    src = os.path.join(tmp_dir, "in")
    rows = sample_lines()
    bad = ["dev-1,temperature_data,xx,30.0", "dev-1,temperature_data,1648607465903"]
    write_line_files(src, [rows[:60] + bad, rows[60:120], rows[120:]])
    roots = {k: os.path.join(tmp_dir, k) for k in NAMES}
    p = jobs.JobParams(streak_limit=2)
    q = jobs.start_combined_stream(text_stream(spark, src, 1), roots, p, os.path.join(tmp_dir, "ck"), {"availableNow": True}, console=True)
    q.awaitTermination()
    assert q.exception() is None
    assert sum(r["numInputRows"] for r in q.recentProgress) == len(rows) + 2
    batch = jobs.combined_job(spark.createDataFrame([(r,) for r in rows + bad], "value string"), p)
    assert rows_of(read_table(spark, roots["histogram"])) == rows_of(batch["histogram"])
    closed = rows_of(read_appended(spark, roots["windows"]), *WINDOW)
    assert len(closed) == 24 and set(closed) <= set(rows_of(batch["windows"], *WINDOW))
    assert rows_of(read_table(spark, roots["streaks"]), "device_id", "start_ms", "counts") == rows_of(streaks.streak_table(batch["streaks"]))
    assert rows_of(read_appended(spark, roots["quarantine"]), "line", "reason") == rows_of(batch["quarantine"], "line", "reason")
    out = capsys.readouterr().out
    assert "cnt" in out and "counts" in out and "reason" in out and "win_start" in out


def frame(spark, rows):
    """(device, dataset, ms, value) rows as readings."""
    return spark.createDataFrame([(d, s, t, v, k) for k, (d, s, t, v) in enumerate(rows)],
                                 "device_id string, dataset_id string, ts_ms long, value double, seq long").withColumn(
        "ts", F.timestamp_millis("ts_ms"))


def analyses(mode="append", lateness="0 seconds", **more):
    return jobs.analyses(jobs.JobParams(temperature="t", delay=lateness, streak_limit=2, bin_start=0.0, bin_step=10.0, bin_count=10, slices=4, **more), mode)


def sinks_of(got, names):
    def sink(name):
        def write(df, batch_id):
            got.setdefault(name, {})[batch_id] = [r.asDict() for r in df.collect()]
        return write
    return {n: sink(n) for n in names}


def test_a_replayed_batch_repeats_itself(spark, tmp_dir):
    rnd = random.Random(3)
    batches = [[(f"d{rnd.randrange(3)}", "t", 1000 * (100 * b + k), float(rnd.randrange(100))) for k in range(100)] for b in range(4)]
    got, names = {}, ("histogram", "changelog", "windows", "late", "streaks")
    write = combined.combined_writer(analyses(), {**sinks_of(got, names), "dashboard": True}, os.path.join(tmp_dir, "state"))
    for b, rows in enumerate(batches):
        write(frame(spark, rows), b)
    before = {n: [sorted(map(repr, rows)) for _, rows in sorted(got[n].items())] for n in names}
    shown = maintained.read_dashboard(spark, os.path.join(tmp_dir, "state"), "t", "h").collect()
    write(frame(spark, batches[3]), 3)
    assert {n: [sorted(map(repr, rows)) for _, rows in sorted(got[n].items())] for n in names} == before
    assert maintained.read_dashboard(spark, os.path.join(tmp_dir, "state"), "t", "h").collect() == shown
    # only the versions that a replay can need are kept, whatever the number of batches
    for name in ("bins", "panes", "runs", "clock", "dashboard/windows", "dashboard/streak"):
        assert versions(spark, os.path.join(tmp_dir, "state", name)) == [2, 3]


def test_state_rows_do_not_grow_with_batches(spark, tmp_dir):
    """What a batch reads of the carried results depends on bins, open panes and devices only."""
    root = os.path.join(tmp_dir, "state")
    write = combined.combined_writer(analyses(), sinks_of({}, ("histogram", "windows", "streaks")), root)
    sizes = []
    for b in range(6):
        write(frame(spark, [(f"d{k % 5}", "t", 1000 * (200 * b + k), float(k % 7)) for k in range(200)]), b)
        sizes.append(sum(read_version(spark, f"{root}/{n}", s).count() for n, s in (
            ("bins", partials.BIN_STATE), ("panes", partials.PANE_STATE), ("runs", combined.RUN_STATE))))
    assert max(sizes[1:]) <= sizes[1] + 2


def test_idle_devices_are_forgotten(spark, tmp_dir):
    root, got = os.path.join(tmp_dir, "state"), {}
    write = combined.combined_writer(analyses(idle_ms=50_000), sinks_of(got, ("streaks",)), root)
    write(frame(spark, [("a", "t", 0, 1.0), ("b", "t", 1000, 1.0)]), 0)
    write(frame(spark, [("a", "t", 60_000, 2.0)]), 1)
    assert {r["device_id"] for r in read_version(spark, f"{root}/runs", combined.RUN_STATE).collect()} == {"a"}
    write(frame(spark, [("b", "t", 61_000, 2.0)]), 2)
    assert [r["device_id"] for r in got["streaks"][1]] == ["a"] and got["streaks"][2] == []


# -- W4 -----------------------------------------------------------------------

def g5(spark):
    def ln(*rows):
        return frame(spark, [("d", "h", t, v) for t, v in rows])
    return [ln((0, 1.0), (61000, 2.0), (130000, 3.0)), ln((5000, 9.0), (200000, 4.0)), ln((5001, 9.5), (300000, 5.0))]


@pytest.mark.parametrize("mode", ["append", "update"])
@pytest.mark.parametrize("lateness,late", [("0 seconds", {5000, 5001}), ("75 seconds", {5001}), ("10 minutes", set())])
def test_late_readings_are_kept(spark, tmp_dir, mode, lateness, late):
    got = {}
    write = combined.combined_writer(analyses(mode, lateness), sinks_of(got, ("windows", "late")), os.path.join(tmp_dir, "state"))
    for b, rows in enumerate(g5(spark)):
        write(rows, b)
    assert {r["ts_ms"] for rows in got["late"].values() for r in rows} == late
    found = {}
    for _, rows in sorted(got["windows"].items()):
        for r in rows:
            if mode == "append":
                assert (r["dataset_id"], r["win_start"]) not in found           # a closed window comes once
            found[r["dataset_id"], r["win_start"]] = (r["max_value"], r["n"])
    # a reading counts in those of its windows that the watermark before its batch had not closed
    want, watermark = {}, -1
    for batch in g5(spark):
        rows = [(r["ts_ms"], r["value"]) for r in batch.collect()]
        for t, v in rows:
            for start in range(t - t % 10_000 - 50_000, t + 1, 10_000):
                if start + 60_000 > watermark:
                    top, n = want.get(start, (v, 0))
                    want[start] = (max(top, v), n + 1)
        watermark = max(watermark, max(t for t, _ in rows) - windows.interval_ms(lateness))
    if mode == "append":
        want = {s: x for s, x in want.items() if s + 60_000 <= watermark}
    assert {round(k[1].timestamp() * 1000): x for k, x in found.items()} == want


@pytest.mark.parametrize("mode", ["append", "update"])
def test_rows_in_are_counted_or_late(spark, tmp_dir, mode):
    """Tumbling windows: what windows count and what is late add up to the input, row by row."""
    rnd = random.Random(8)
    got, n = {}, 0
    write = combined.combined_writer(analyses(mode, "20 seconds", window_size="30 seconds", window_slide="30 seconds"),
                                     sinks_of(got, ("windows", "late")), os.path.join(tmp_dir, "state"))
    for b in range(5):
        rows = [("d", "h", max(0, 60_000 * b + rnd.randrange(-90_000, 60_000)), float(k)) for k in range(80)]
        write(frame(spark, rows), b)
        n += len(rows)
    write(frame(spark, [("d", "h", 10_000_000, 0.0)]), 5)           # closes all the others
    counted = {}
    for _, rows in sorted(got["windows"].items()):
        counted.update({(r["dataset_id"], r["win_start"]): r["n"] for r in rows})
    last = 1 if mode == "update" else 0
    late = sum(map(len, got["late"].values()))
    assert late > 10 and sum(counted.values()) - last + late == n


def test_lateness_stream_keeps_late_rows(spark, tmp_dir):
    def ln(ms, v):
        return f"dev-1,humidity_data,{ms},{v}"
    src = os.path.join(tmp_dir, "in")
    write_line_files(src, [[ln(0, 1), ln(61000, 2), ln(130000, 3)], [ln(5000, 9), ln(200000, 4)], [ln(5001, 9.5), ln(300000, 5)]])
    root, late = os.path.join(tmp_dir, "w"), os.path.join(tmp_dir, "late")
    q = jobs.start_lateness_stream(line_readings_stream(spark, src, max_files_per_trigger=1), root, late, jobs.JobParams(delay="75 seconds"),
                                   os.path.join(tmp_dir, "ck"), {"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    assert rows_of(read_appended(spark, late), "ts_ms", "value") == [(5001, 9.5)]
    assert 9.0 in {r["max_value"] for r in read_appended(spark, root).collect()}


def test_readings_without_event_time_are_late(spark):
    rows = spark.createDataFrame([("d", "h", None, 1.0, None, 1), ("d", "h", 5, 1.0, None, 2)], READING)
    step = partials.advance_windows(rows, spark.createDataFrame([], partials.PANE_STATE), partials.NO_WATERMARK)
    assert step.late.count() == 2 and step.panes.count() == 0 and step.watermark_us == partials.NO_WATERMARK


# -- A2 -----------------------------------------------------------------------

def test_changelog_stream_equals_batch(spark, tmp_dir):
    src = _events_dir(spark, tmp_dir)
    root = os.path.join(tmp_dir, "log")
    p = event_params()
    q = jobs.start_changelog_stream(events_stream(spark, src, max_files_per_trigger=1), root, p, os.path.join(tmp_dir, "ck"), {"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    temp = readings(spark, SF_SMALL).where(F.col("dataset_id") == EVENTS.temperature)
    log = histogram.histogram_changelog(temp, p.bin_start, p.bin_step, p.bin_count)
    assert rows_of(read_appended(spark, root).drop("batch"), *log.columns) == rows_of(log)


def test_changelog_splits_a_hot_bin(spark):
    rows = frame(spark, [("d", "t", t, 5.0) for t in range(4000)]).repartition(4)
    carried = spark.createDataFrame([(10.0, 100)], partials.BIN_STATE)
    log = partials.changelog(rows, carried, 0.0, 10.0, 10, slices=8)
    assert sorted(r["cnt"] for r in log.collect()) == list(range(101, 4101))
    tasks = [r["n"] for r in log.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(tasks) >= 6 and max(tasks) < 1500


# -- Q1, Q3 -------------------------------------------------------------------

def test_maintained_rows_equal_whole_tables_after_any_batches(spark):
    """Windows change in later batches, streaks grow: the kept rows stay those of the whole tables."""
    rnd = random.Random(4)
    kept = spark.createDataFrame([], maintained.WINDOW_ROWS)
    best = spark.createDataFrame([], maintained.STREAK_ROWS)
    table, alerts = {}, []
    for b in range(5):
        changed = {(rnd.choice("ab"), rnd.randrange(12)): float(rnd.randrange(100)) for _ in range(6)}
        table.update(changed)
        grown = [(f"d{rnd.randrange(3)}", rnd.randrange(4), rnd.randrange(2, 9)) for _ in range(5)]
        alerts += grown

        def windows_frame(rows):
            return spark.createDataFrame([(d, s, v) for (d, s), v in rows.items()], "dataset_id string, s long, max_value double").select(
                "dataset_id", F.timestamp_seconds("s").alias("win_start"), "max_value")

        kept = spark.createDataFrame(maintained.newest_windows(kept, windows_frame(changed), 3).collect(), maintained.WINDOW_ROWS)
        want = serving.latest_windows(windows_frame(table), 3).select("dataset_id", "win_start", F.col("value").alias("max_value"))
        assert rows_of(kept) == rows_of(want)
        grown = spark.createDataFrame(grown, maintained.STREAK_ROWS)
        best = spark.createDataFrame(maintained.newest_streak(best, grown).collect(), maintained.STREAK_ROWS)
        top = first_per_key(spark.createDataFrame(alerts, maintained.STREAK_ROWS), ["device_id", "start_ms"], [F.col("counts").desc()])
        assert rows_of(best) == rows_of(serving.latest_streak(top).select("device_id", "start_ms", "counts"))

"""Whole jobs: ingest -> clean -> analyse -> sink, in batch and streaming form.

Batch jobs return DataFrames (the caller chooses where to write them);
streaming jobs start queries and return their handles.  Every streaming
query gets its own checkpoint folder under ``checkpoint_root`` (default: the
session's shared ``spark.checkpoint.dir``), which is what makes restarts
resume exactly-once with the idempotent sinks.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewatch import config
from tidewatch.operators import cleaning, histogram as hist_ops, responses, streaks, windows
from tidewatch.session import state_path
from tidewatch.sinks.append import append_writer
from tidewatch.sinks.archive import archive_writer
from tidewatch.sinks.outputs import console_writer, fan_out, kafka_writer, write_lines
from tidewatch.sinks.upsert import upsert_writer
from tidewatch.streaming.combined import Analyses, combined_writer
from tidewatch.streaming.operators import stream_histogram, stream_sliding_extremes
from tidewatch.streaming.readers import with_event_time
from tidewatch.streaming.streaks import streak_writer, stream_rising_streaks


@dataclass(frozen=True)
class JobParams:
    deny: tuple = config.DENY_MARKERS
    allow: tuple = config.ALLOW_MARKERS
    temperature: str = config.TEMPERATURE
    bin_start: float = config.BIN_START
    bin_step: float = config.BIN_STEP
    bin_count: int = config.BIN_COUNT
    window_size: str = config.WINDOW_SIZE
    window_slide: str = config.WINDOW_SLIDE
    streak_limit: int = config.STREAK_LIMIT
    # noise of each analysis: none | gaussian | uniform; each draws for itself
    noise_histogram: str = "none"
    noise_windows: str = "none"
    noise_streaks: str = "none"
    delay: str = "0 seconds"       # watermark delay
    idle_ms: int | None = None     # streams forget a device this long after its last reading (None: never)
    slices: int | None = None      # fixed range slices of the batch streak scan (default: the shuffle partitions)

    def noisy(self) -> "JobParams":
        """The same with noise: Gaussian in the histogram, uniform in the others."""
        return replace(self, noise_histogram="gaussian", noise_windows="uniform", noise_streaks="uniform")


# ---------------------------------------------------------------------------
# batch
# ---------------------------------------------------------------------------

def readings_from_lines(lines: DataFrame, p: JobParams = JobParams()) -> DataFrame:
    return cleaning.lines_to_readings(lines, p.deny, p.allow)


def histogram_input(readings: DataFrame, p: JobParams) -> DataFrame:
    return cleaning.add_noise(cleaning.only_dataset(readings, p.temperature), p.noise_histogram, salt="histogram")


def window_input(readings: DataFrame, p: JobParams) -> DataFrame:
    return cleaning.add_noise(readings, p.noise_windows, salt="windows")


def streak_input(readings: DataFrame, p: JobParams) -> DataFrame:
    return cleaning.add_noise(cleaning.only_dataset(readings, p.temperature), p.noise_streaks, salt="streaks")


def histogram_job(lines: DataFrame, p: JobParams = JobParams()) -> DataFrame:
    """J2: temperature readings -> noise -> bins -> counts per bin."""
    return hist_ops.histogram(histogram_input(readings_from_lines(lines, p), p), p.bin_start, p.bin_step, p.bin_count)


def window_job(lines: DataFrame, p: JobParams = JobParams()) -> DataFrame:
    """J3: all readings -> noise -> sliding-window extremes per dataset."""
    return windows.sliding_extremes(window_input(readings_from_lines(lines, p), p), p.window_size, p.window_slide)


def streak_job(lines: DataFrame, p: JobParams = JobParams()) -> DataFrame:
    """J4: temperature readings -> noise -> rising-streak alerts."""
    return streaks.rising_streaks(streak_input(readings_from_lines(lines, p), p), p.streak_limit, slices=p.slices)


def quarantine_job(lines: DataFrame, p: JobParams = JobParams()) -> DataFrame:
    """What the other jobs cannot read: lines that pass their filters and are no
    readings, with the reason.  Every job has it beside its result."""
    return cleaning.job_quarantine(lines, p.deny, p.allow)


def combined_job(lines: DataFrame, p: JobParams = JobParams()) -> dict[str, DataFrame]:
    """J1: one parsed input, three analyses, and the lines that none could read.

    The three plans share the parse; each is a separate action, so Catalyst
    prunes columns per branch (the histogram reads only values).  Persist
    ``lines`` beforehand only when re-reading the source costs more than
    holding it.
    """
    return {"histogram": histogram_job(lines, p), "windows": window_job(lines, p), "streaks": streak_job(lines, p),
            "quarantine": quarantine_job(lines, p)}


def decode_to_lines_job(resp: DataFrame, out_path: str | None = None, quarantine_path: str | None = None) -> DataFrame:
    """J5: captured responses -> readings -> wire lines (written if a path is
    given), and what is no reading to ``quarantine_path`` (Parquet)."""
    classified = responses.classify_responses(resp)
    r = responses.readings_of(classified)
    if out_path and quarantine_path:
        classified = classified.persist()       # one parse for both outputs
    try:
        if out_path:
            write_lines(responses.readings_of(classified), out_path)
        if quarantine_path:
            responses.quarantine_of(classified).write.mode("append").parquet(quarantine_path)
    finally:
        if out_path and quarantine_path:
            classified.unpersist()
    return r


# ---------------------------------------------------------------------------
# streaming
# ---------------------------------------------------------------------------

def _checkpoint(spark: SparkSession, root: str | None, name: str) -> str:
    return f"{root.rstrip('/')}/{name}" if root else state_path(spark, "streams", name)


def _start(result: DataFrame, name: str, mode: str, writers: list, console: bool, checkpoint_root: str | None,
           trigger: dict | None) -> StreamingQuery:
    """Start one query: ``writers`` (and the console) get every micro-batch."""
    writers = writers + ([console_writer()] if console else [])
    sink = writers[0] if len(writers) == 1 else fan_out(writers)
    w = result.writeStream.outputMode(mode).foreachBatch(sink).option(
        "checkpointLocation", _checkpoint(result.sparkSession, checkpoint_root, name))
    return w.trigger(**(trigger or {"processingTime": "2 seconds"})).start()


def start_histogram_stream(readings: DataFrame, table_root: str, p: JobParams = JobParams(),
                           checkpoint_root: str | None = None, trigger: dict | None = None,
                           console: bool = False) -> StreamingQuery:
    """J2 streaming: running bin counts, upserted by bin each micro-batch."""
    counts = stream_histogram(histogram_input(readings, p), p.bin_start, p.bin_step, p.bin_count)
    return _start(counts, "histogram", "update", [upsert_writer(table_root, ["bin"])], console, checkpoint_root, trigger)


def start_window_stream(readings: DataFrame, table_root: str, p: JobParams = JobParams(),
                        checkpoint_root: str | None = None, trigger: dict | None = None,
                        mode: str = "append", console: bool = False) -> StreamingQuery:
    """J3 streaming: window extremes.

    ``append`` writes each closed window once (idempotent by batch id);
    ``update`` upserts changing windows by (dataset, win_start) and so also
    shows windows that are still open.
    """
    # panes chain two stateful aggregates, which Spark allows in append mode only
    ext = stream_sliding_extremes(window_input(readings, p), p.window_size, p.window_slide, panes=(mode == "append"))
    sink = append_writer(table_root) if mode == "append" else upsert_writer(table_root, ["dataset_id", "win_start"])
    return _start(ext, "windows", mode, [sink], console, checkpoint_root, trigger)


def start_streak_stream(readings: DataFrame, table_root: str, p: JobParams = JobParams(),
                        checkpoint_root: str | None = None, trigger: dict | None = None,
                        console: bool = False, keyed_state: bool = False) -> StreamingQuery:
    """J4 streaming: streak alerts, replaced by (device, start), the highest count
    staying.

    Each micro-batch runs through the range-sliced scan, so a hot device is
    spread over tasks; its state table lies beside the result table.
    ``keyed_state=True`` uses the keyed state operator instead (one task per
    device and batch, no state table).
    """
    temp = streak_input(readings, p)
    upserts = upsert_writer(table_root, ["device_id", "start_ms"], order="counts")
    writers = [_without_time(upserts)] + ([console_writer()] if console else [])
    sink = writers[0] if len(writers) == 1 else fan_out(writers)
    if keyed_state:
        return _start(stream_rising_streaks(temp, p.streak_limit), "streaks", "append", [sink], False, checkpoint_root, trigger)
    scan = streak_writer(f"{table_root.rstrip('/')}-state", sink, p.streak_limit, p.slices, p.idle_ms)
    return _start(temp, "streaks", "append", [scan], False, checkpoint_root, trigger)


def start_quarantine_stream(lines: DataFrame, root: str, p: JobParams = JobParams(), checkpoint_root: str | None = None,
                            trigger: dict | None = None, console: bool = False) -> StreamingQuery:
    """The lines that the analyses of the same stream cannot read, with the
    reason, appended once each."""
    return _start(quarantine_job(lines, p), "quarantine", "append", [append_writer(root)], console, checkpoint_root, trigger)


def start_publish_stream(lines: DataFrame, servers: str, topic: str, archive_root: str, checkpoint_root: str | None = None,
                         trigger: dict | None = None, publish=kafka_writer) -> StreamingQuery:
    """K7: every micro-batch of lines both to a topic and to the day/hour archive."""
    return _start(lines, "publish", "append", [publish(servers, topic), archive_writer(archive_root)], False, checkpoint_root, trigger)


def analyses(p: JobParams = JobParams(), mode: str = "append") -> Analyses:
    """The three analyses of a job as the combined stream runs them."""
    return Analyses(
        histogram_input=lambda r: histogram_input(r, p), window_input=lambda r: window_input(r, p),
        streak_input=lambda r: streak_input(r, p), bins=(p.bin_start, p.bin_step, p.bin_count), size=p.window_size, slide=p.window_slide,
        lateness=p.delay, limit=p.streak_limit, mode=mode, slices=p.slices, idle_ms=p.idle_ms, deny=p.deny, allow=p.allow)


def default_sinks(roots: dict[str, str], mode: str = "append") -> dict:
    """Parquet sinks for the results that ``roots`` names."""
    make = {
        "histogram": lambda root: upsert_writer(root, ["bin"]),
        "windows": lambda root: append_writer(root) if mode == "append" else upsert_writer(root, ["dataset_id", "win_start"]),
        "streaks": lambda root: _without_time(upsert_writer(root, ["device_id", "start_ms"], order="counts")),
        "changelog": append_writer, "late": append_writer, "quarantine": append_writer, "dashboard": lambda root: root,
    }
    return {name: make[name](root) for name, root in roots.items() if name != "state"}


def _without_time(sink):
    return lambda batch, batch_id: sink(batch.drop("ts_ms"), batch_id)


def start_combined_stream(source: DataFrame, roots: dict[str, str], p: JobParams = JobParams(),
                          checkpoint_root: str | None = None, trigger: dict | None = None, console: bool = False,
                          sinks: dict | None = None, mode: str = "append") -> StreamingQuery:
    """J1 streaming: one query, one reader of the source.  Every micro-batch of
    ``source`` (a stream of lines, or of readings without a watermark) is read and
    parsed once; the three analyses take it from there with their carried partial
    results (:mod:`tidewatch.streaming.combined`).

    ``roots`` names the folders of the results wanted (see ``combined_writer``) and
    of the carried ``state``; ``sinks`` replaces some of their sinks, for example by
    database upserts.  ``p.delay`` is the allowed lateness of the windows.
    """
    chosen = {**default_sinks(roots, mode), **(sinks or {})}
    if console:
        show = console_writer()
        chosen = {n: fan_out([s, show]) if callable(s) else s for n, s in chosen.items()}
    state = roots.get("state") or state_path(source.sparkSession, "combined-state")
    return _start(source, "combined", "append", [combined_writer(analyses(p, mode), chosen, state)], False, checkpoint_root, trigger)


def start_changelog_stream(readings: DataFrame, root: str, p: JobParams = JobParams(), checkpoint_root: str | None = None,
                           trigger: dict | None = None) -> StreamingQuery:
    """A2 streaming: the updated bin count after every reading, appended once each."""
    sinks = default_sinks({"changelog": root})
    writer = combined_writer(analyses(p), sinks, f"{root.rstrip('/')}-state")
    return _start(readings, "changelog", "append", [writer], False, checkpoint_root, trigger)


def start_lateness_stream(readings: DataFrame, root: str, late_root: str, p: JobParams = JobParams(),
                          checkpoint_root: str | None = None, trigger: dict | None = None, mode: str = "append") -> StreamingQuery:
    """J3 streaming with its late readings kept (W4): a reading none of whose windows
    is open any more goes to ``late_root`` instead of being dropped; every other one
    is counted.  ``p.delay`` is the allowed lateness."""
    sinks = default_sinks({"windows": root, "late": late_root}, mode)
    writer = combined_writer(analyses(p, mode), sinks, f"{root.rstrip('/')}-state")
    return _start(readings, "lateness", "append", [writer], False, checkpoint_root, trigger)


def watermarked(readings: DataFrame, p: JobParams = JobParams()) -> DataFrame:
    return with_event_time(readings, p.delay)

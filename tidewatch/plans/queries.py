"""Registered queries over the driver tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame built only from
library operators over whole tables.  ``events`` stands in for sensor
readings (see :func:`tidewatch.sources.tables.events_as_readings`) with the
parameters of :data:`tidewatch.config.EVENTS`.  Outputs avoid timestamp
columns: times are epoch milliseconds or the result-table text form, so
they compare exactly across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import EVENTS
from tidewatch.functions.routing import route_topic as route_expr
from tidewatch.functions.text import to_line
from tidewatch.functions.timefmt import format_winstart, to_ts, ts_to_ms
from tidewatch.operators import cleaning, dedup, histogram as hist_ops, responses, serving, windows
from tidewatch.plans import pipelines
from tidewatch.session import state_path
from tidewatch.sinks.append import append_batch, read_appended
from tidewatch.sinks.archive import archive_columns, read_archive, write_archive
from tidewatch.sinks.outputs import write_lines
from tidewatch.sinks.upsert import read_table, upsert
from tidewatch.sources.files import text_source
from tidewatch.sources.tables import load_table, readings
from tidewatch.streaming import maintained, partials
from tidewatch.streaming.streaks import advance_batch

P = EVENTS


def _extremes_out(df: DataFrame) -> DataFrame:
    return df.select(
        "dataset_id",
        ts_to_ms("win_start").alias("win_start_ms"),
        ts_to_ms("win_end").alias("win_end_ms"),
        format_winstart("win_start").alias("winstart"),
        "max_value", "min_value", "n",
    )


def q_sliding_extremes(spark: SparkSession, sf: str) -> DataFrame:
    return _extremes_out(pipelines.extremes(readings(spark, sf), P))


def q_salted_extremes(spark: SparkSession, sf: str) -> DataFrame:
    return _extremes_out(windows.salted_extremes(readings(spark, sf), 8, P.window_size, P.window_slide))


def q_parse_readings(spark: SparkSession, sf: str) -> DataFrame:
    lines = pipelines.event_lines(spark, sf)
    return cleaning.lines_to_readings(lines, P.deny, P.allow).select("device_id", "dataset_id", "ts_ms", "value")


def q_decode_responses(spark: SparkSession, sf: str) -> DataFrame:
    return responses.decode_responses(pipelines.event_responses(spark, sf)).select(
        "device_id", "dataset_id", "ts_ms", "value")


def q_quarantine_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that are not readings, with the reason.  ``error`` events are sent
    with an unreadable value (``n/a``), as a corrupted transmission would be."""
    e = load_table(spark, sf, "events")
    value = F.when(F.col("event_type") == F.lit("error"), F.lit("n/a")).otherwise(F.col("value").cast("string"))
    lines = e.select(to_line("user_id", "event_type", ts_to_ms(to_ts("ts")), value).alias("value"))
    return cleaning.quarantine_lines(lines)


def q_response_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """OK responses and statuses that are no readings, with the reason (kept, not lost).
    A body may print its numbers in another engine's form, so the response's
    own text stays out of the comparison."""
    return responses.response_quarantine(pipelines.event_responses(spark, sf)).select(
        "device_id", "status_code", "position", "reason")


def q_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return pipelines.temperature_histogram(readings(spark, sf), P)


def q_histogram_changelog(spark: SparkSession, sf: str) -> DataFrame:
    temp = cleaning.only_dataset(readings(spark, sf), P.temperature)
    return hist_ops.histogram_changelog(temp, P.bin_start, P.bin_step, P.bin_count).select(
        F.col("seq").alias("event_id"), "device_id", "ts_ms", "bin", "cnt")


def q_rising_streaks(spark: SparkSession, sf: str) -> DataFrame:
    return pipelines.temperature_streaks(readings(spark, sf), P)


def q_streak_upserts(spark: SparkSession, sf: str) -> DataFrame:
    return pipelines.streak_upserts(pipelines.temperature_streaks(readings(spark, sf), P))


def q_latest_streak(spark: SparkSession, sf: str) -> DataFrame:
    # the newest streak is the top alert: no aggregate over all of them is needed
    alerts = pipelines.temperature_streaks(readings(spark, sf), P).select("device_id", "start_ms", "counts")
    return serving.latest_streak(alerts)


def q_drop_repeated_polls(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.drop_repeated_polls(pipelines.polled_twice(spark, sf)).select(
        "device_id", "dataset_id", "ts_ms", "value", "seq")


def q_distinct_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Which copy is kept is not defined, so only the key is returned."""
    return dedup.distinct_readings(pipelines.polled_twice(spark, sf)).select("device_id", "dataset_id", "ts_ms")


def q_latest_windows(spark: SparkSession, sf: str) -> DataFrame:
    ext = pipelines.extremes(readings(spark, sf), P)
    return serving.latest_windows(ext, 5).select("dataset_id", "winstart", "value", "rn")


def q_latest_windows_10(spark: SparkSession, sf: str) -> DataFrame:
    ext = pipelines.extremes(readings(spark, sf), P)
    return serving.latest_windows_of(ext, P.temperature, 10).select("dataset_id", "winstart", "value")


def q_ordered_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return serving.ordered_histogram(pipelines.temperature_histogram(readings(spark, sf), P))


def q_temp_humi_by_window(spark: SparkSession, sf: str) -> DataFrame:
    ext = pipelines.extremes(readings(spark, sf), P)
    return serving.temp_humi_by_window(ext, P.temperature, P.humidity).select(
        ts_to_ms("win_start").alias("win_start_ms"), "winstart", "temp_max", "humi_max")


def q_dashboard_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return serving.dashboard_text(pipelines.dashboard(readings(spark, sf), P))


def q_dashboard_arrays(spark: SparkSession, sf: str) -> DataFrame:
    ext = pipelines.extremes(readings(spark, sf), P)
    top = serving.latest_windows(ext, 5)
    return (
        top.groupBy("dataset_id")
        .agg(F.array_sort(F.collect_list(F.struct("rn", "winstart", "value"))).alias("_a"))
        .select(
            "dataset_id",
            F.array_join(F.transform("_a", lambda x: x["winstart"]), ";").alias("winstarts"),
            F.array_join(F.transform("_a", lambda x: F.format_string("%.2f", x["value"])), ";").alias("values"),
        )
    )


def q_only_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.only_dataset(readings(spark, sf), P.temperature).select(
        "device_id", "dataset_id", "ts_ms", "value", "seq")


def q_route_topic(spark: SparkSession, sf: str) -> DataFrame:
    lines = pipelines.event_lines(spark, sf, with_seq=True)
    return lines.select("seq", route_expr("value", P.route_marker).alias("topic"))


def q_tag_headers(spark: SparkSession, sf: str) -> DataFrame:
    tagged = cleaning.tag_dataset_header(readings(spark, sf))
    return tagged.select(
        "seq", "device_id",
        F.to_json(F.map_from_arrays(F.col("headers.key"), F.col("headers.value").cast("array<string>")))
        .alias("headers"),
    )


def q_archive_layout(spark: SparkSession, sf: str) -> DataFrame:
    arch = archive_columns(pipelines.event_lines(spark, sf, with_ts=True), time_col="ts")
    return arch.groupBy("day", "hour").agg(F.count(F.lit(1)).alias("lines"))


def q_uniform_noise(spark: SparkSession, sf: str) -> DataFrame:
    r = readings(spark, sf)
    noisy = cleaning.add_noise(r, "uniform")
    return noisy.select("seq", F.round("value", 6).alias("value"))


def q_gaussian_noise(spark: SparkSession, sf: str) -> DataFrame:
    r = readings(spark, sf)
    noisy = cleaning.add_noise(r, "gaussian")
    return noisy.select("seq", F.round("value", 6).alias("value"))


def q_upsert_final_state(spark: SparkSession, sf: str) -> DataFrame:
    return pipelines.latest_per_device(readings(spark, sf)).select("device_id", "value", "seq")


# -- micro-batches: what streams do with carried results, over the whole table in two batches ----------

def _two_batches(spark: SparkSession, sf: str, delayed: bool = False) -> tuple[DataFrame, DataFrame]:
    """All readings in order of arrival, cut in the middle; ``delayed``: every tenth
    of the first batch arrives with the second."""
    r = readings(spark, sf)
    low, high = r.agg(F.min("seq"), F.max("seq")).first()
    first = F.col("seq") < F.lit(((low or 0) + (high or 0)) // 2)
    if delayed:
        first = first & (F.col("seq") % 10 != 3)
    return r.where(first), r.where(~first)


def q_changelog_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """The second batch's changelog, going on from the first batch's counts."""
    bins = (P.bin_start, P.bin_step, P.bin_count)
    before, after = (cleaning.only_dataset(b, P.temperature) for b in _two_batches(spark, sf))
    return partials.changelog(after, hist_ops.histogram(before, *bins), *bins).select("seq", "bin", "cnt")


def q_streaks_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """The second batch's streak alerts, going on from the devices' runs after the first."""
    before, after = (cleaning.only_dataset(b, P.temperature) for b in _two_batches(spark, sf))
    _, runs = advance_batch(before, None)
    counted, _ = advance_batch(after, runs)
    return counted.where(F.col("counts") >= P.streak_limit).select("device_id", "start_ms", "counts", "ts_ms")


def _second_step(spark: SparkSession, sf: str, mode: str) -> partials.WindowStep:
    before, after = _two_batches(spark, sf, delayed=True)
    none = spark.createDataFrame([], partials.PANE_STATE)
    step = partials.advance_windows(before, none, partials.NO_WATERMARK, P.window_size, P.window_slide, P.lateness, mode)
    return partials.advance_windows(after, step.panes, step.watermark_us, P.window_size, P.window_slide, P.lateness, mode)


def q_late_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Readings of the second batch all of whose windows were closed after the first."""
    return _second_step(spark, sf, "append").late.select("seq", "device_id", "dataset_id", "ts_ms", "value")


def q_closed_windows(spark: SparkSession, sf: str) -> DataFrame:
    """The windows that the second batch closes, late readings left out."""
    return _extremes_out(_second_step(spark, sf, "append").results)


def q_maintained_windows(spark: SparkSession, sf: str) -> DataFrame:
    """The newest windows of each dataset, kept over two batches of changed windows."""
    before, after = _two_batches(spark, sf)
    none = spark.createDataFrame([], maintained.WINDOW_ROWS)
    kept = maintained.newest_windows(none, pipelines.extremes(before, P), 5)
    changed = windows.sliding_extremes(before.unionByName(after), P.window_size, P.window_slide)
    kept = maintained.newest_windows(kept, changed, 5)
    return serving.latest_windows(kept, 5).select("dataset_id", "winstart", "value", "rn")


# -- sources and sinks: written below the shared checkpoint folder and read back ------------------------

def _scratch(spark: SparkSession, name: str) -> str:
    return state_path(spark, "queries", f"{name}-{uuid.uuid4().hex}")


def q_lines_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Readings written as lines, read as text and parsed again; the device comes from the request."""
    path = _scratch(spark, "lines")
    write_lines(readings(spark, sf), path)
    back = cleaning.lines_to_readings(text_source(spark, path), P.deny, P.allow)
    return cleaning.with_device_id(back, "dev-1").select("device_id", "dataset_id", "ts_ms", "value")


def q_archive_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Lines archived by their own hour and read back."""
    path = _scratch(spark, "archive")
    write_archive(pipelines.event_lines(spark, sf, with_ts=True), path, time_col="ts")
    return read_archive(spark, path).select("day", "hour", "value")


def q_upsert_table(spark: SparkSession, sf: str) -> DataFrame:
    """The newest reading of each device as the upsert sink holds it after two batches,
    the second applied twice."""
    path = _scratch(spark, "upsert")
    before, after = (b.select("device_id", "value", "seq") for b in _two_batches(spark, sf))
    for batch_id, batch in ((0, before), (1, after), (1, after)):
        upsert(spark, path, batch, batch_id, ["device_id"], order="seq")
    return read_table(spark, path, "device_id string, value double, seq bigint")


def q_append_table(spark: SparkSession, sf: str) -> DataFrame:
    """Windows appended by batch id, one batch replayed, and read back."""
    path = _scratch(spark, "append")
    for batch_id, batch in ((0, 0), (1, 1), (1, 1)):
        append_batch(_extremes_out(pipelines.extremes(_two_batches(spark, sf)[batch], P)), batch_id, path)
    return read_appended(spark, path).withColumn("batch", F.col("batch").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sliding_extremes": q_sliding_extremes,
    "salted_extremes": q_salted_extremes,
    "parse_readings": q_parse_readings,
    "quarantine_lines": q_quarantine_lines,
    "decode_responses": q_decode_responses,
    "response_quarantine": q_response_quarantine,
    "histogram": q_histogram,
    "histogram_changelog": q_histogram_changelog,
    "rising_streaks": q_rising_streaks,
    "streak_upserts": q_streak_upserts,
    "latest_streak": q_latest_streak,
    "drop_repeated_polls": q_drop_repeated_polls,
    "distinct_readings": q_distinct_readings,
    "latest_windows": q_latest_windows,
    "latest_windows_10": q_latest_windows_10,
    "ordered_histogram": q_ordered_histogram,
    "temp_humi_by_window": q_temp_humi_by_window,
    "dashboard_snapshot": q_dashboard_snapshot,
    "dashboard_arrays": q_dashboard_arrays,
    "only_dataset": q_only_dataset,
    "route_topic": q_route_topic,
    "tag_headers": q_tag_headers,
    "archive_layout": q_archive_layout,
    "uniform_noise": q_uniform_noise,
    "gaussian_noise": q_gaussian_noise,
    "upsert_final_state": q_upsert_final_state,
    "changelog_resumed": q_changelog_resumed,
    "streaks_resumed": q_streaks_resumed,
    "late_readings": q_late_readings,
    "closed_windows": q_closed_windows,
    "maintained_windows": q_maintained_windows,
    "lines_round_trip": q_lines_round_trip,
    "archive_round_trip": q_archive_round_trip,
    "upsert_table": q_upsert_table,
    "append_table": q_append_table,
}

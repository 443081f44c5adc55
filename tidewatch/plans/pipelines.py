"""Compositions of operators shared by the registered queries and the jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.config import EventProfile
from tidewatch.functions.text import to_line
from tidewatch.functions.timefmt import to_ts, ts_to_ms
from tidewatch.operators import cleaning, histogram as hist_ops, serving, streaks, windows
from tidewatch.sinks.upsert import BATCH, newest_per_key, resolve
from tidewatch.sources.tables import load_table, readings


def extremes(r: DataFrame, p: EventProfile) -> DataFrame:
    """Sliding-window max/min/count per dataset."""
    return windows.sliding_extremes(r, p.window_size, p.window_slide)


def temperature_histogram(r: DataFrame, p: EventProfile, noise: str = "none") -> DataFrame:
    temp = cleaning.add_noise(cleaning.only_dataset(r, p.temperature), noise)
    return hist_ops.histogram(temp, p.bin_start, p.bin_step, p.bin_count)


def temperature_streaks(r: DataFrame, p: EventProfile, noise: str = "none",
                        slices: int | None = None) -> DataFrame:
    temp = cleaning.add_noise(cleaning.only_dataset(r, p.temperature), noise)
    return streaks.rising_streaks(temp, p.streak_limit, slices=slices)


def dashboard(r: DataFrame, p: EventProfile) -> DataFrame:
    hist = temperature_histogram(r, p)
    ext = extremes(r, p)
    # The newest streak is the top alert by (start desc, counts desc, device):
    # the same row the (device, start) table's top gives, with no aggregate
    # shuffle, since Spark takes a per-partition top-1 first.
    alerts = temperature_streaks(r, p).select("device_id", "start_ms", "counts")
    return serving.dashboard_snapshot(hist, ext, alerts, p.temperature, p.humidity, config.LATEST_WINDOWS)


def dashboard_of_tables(hist: DataFrame, ext: DataFrame, streak_table: DataFrame, p: EventProfile) -> DataFrame:
    """The same payload from maintained result tables (the sinks' bins, windows
    and streaks), which is what a page that refreshes every few seconds reads;
    :func:`dashboard` computes it from all readings."""
    return serving.dashboard_snapshot(hist, ext, streak_table, p.temperature, p.humidity, config.LATEST_WINDOWS)


def latest_per_device(r: DataFrame) -> DataFrame:
    """What a keyed upsert sink holds at the end: the newest reading per device.

    Arrival numbers are cut into micro-batches; each is reduced and then resolved
    as the sink does it."""
    batches = r.withColumn(BATCH, F.floor(F.col("seq") / 1000).cast("long"))
    return resolve(newest_per_key(batches, ["device_id", BATCH], "seq"), ["device_id"])


def streak_upserts(alerts: DataFrame) -> DataFrame:
    """What the streak sink holds after all alerts, in micro-batches of a day:
    reduced and resolved as the sink does it."""
    batches = alerts.select("device_id", "start_ms", "counts", F.floor(F.col("ts_ms") / 86_400_000).cast("long").alias(BATCH))
    return resolve(newest_per_key(batches, ["device_id", "start_ms", BATCH], "counts"), ["device_id", "start_ms"], "counts")


def event_lines(spark: SparkSession, sf_dir: str, with_seq: bool = False, with_ts: bool = False) -> DataFrame:
    """``events`` serialised to the wire format ``device,dataset,epoch_ms,value``."""
    e = load_table(spark, sf_dir, "events")
    ts = to_ts("ts")
    cols = [to_line("user_id", "event_type", ts_to_ms(ts), "value").alias("value")]
    if with_seq:
        cols.append(F.col("event_id").alias("seq"))
    if with_ts:
        cols.append(ts.alias("ts"))
    return e.select(*cols)


def event_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured platform responses, one per event, with the faults a platform shows.

    ``error`` events come back with status 500 and ``signup`` events with a 200
    without a body.  Of the others, by event number modulo 10: 1 has a body cut
    short, 2 an empty status list, 3 no list, 4 a second status with an
    unreadable value, 5 a second good status (one ms later), 6 an unreadable
    timestamp; the rest carry one status.  Every field is text.
    """
    e = load_table(spark, sf_dir, "events")
    ms = ts_to_ms(to_ts("ts"))
    turn = F.col("event_id") % 10

    def status(value, stamp):
        return F.struct(value.alias("value"), stamp.alias("timestamp"), F.col("event_type").alias("datasetId"))

    text = F.col("value").cast("string")
    one = status(text, F.when(turn == 6, F.lit("soon")).otherwise(ms.cast("string")))
    second = status(F.when(turn == 4, F.lit("n/a")).otherwise(text), (ms + 1).cast("string"))
    statuses = F.when(turn.isin(4, 5), F.array(one, second)).when(
        turn == 2, F.slice(F.array(one), 1, 0)).when(turn != 3, F.array(one))
    body = F.to_json(F.struct(F.lit("0").alias("code"), F.lit("ok").alias("desc"), statuses.alias("deviceStatusList")))
    body = F.when(turn == 1, F.lit("{\"code\":\"0\",\"deviceStatus")).otherwise(body)
    code = F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200))
    resp = (
        F.when(F.col("event_type") == "signup", F.concat(F.lit("HTTP "), code.cast("string"), F.lit(" timeout")))
        .otherwise(F.concat(F.lit("HTTP "), code.cast("string"), F.lit(" body="), body))
    )
    return e.select("event_id", F.col("user_id").cast("string").alias("device_id"), code.alias("status_code"), resp.alias("resp"))


def polled_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading served twice, as a polling collector records it: the second
    copy arrives later and, on every third reading, was corrected by half a unit."""
    r = readings(spark, sf_dir)
    value = F.when(F.col("seq") % 3 == 0, F.col("value") + 0.5).otherwise(F.col("value"))
    later = F.col("seq") + 1_000_000_000
    return r.unionByName(r.withColumn("value", value).withColumn("seq", later))

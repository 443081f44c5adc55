"""Dashboard queries over the three result tables.

Every query here reduces before it orders: top-k per group uses
``row_number() <= k`` (Spark plans a per-partition ``WindowGroupLimit``
before the shuffle), a single top row uses ``orderBy().limit()``
(``TakeOrderedAndProject``), and the only arrays collected are over
inputs already bounded by a parameter (bins, k).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.functions.timefmt import format_winstart


def latest_windows(extremes: DataFrame, n: int = config.LATEST_WINDOWS, dataset: str | None = None) -> DataFrame:
    """The ``n`` newest windows per dataset (or of one dataset), newest first.

    Output: ``dataset_id, win_start, winstart, value, rn`` where ``value`` is
    the window maximum and ``winstart`` the result-table text form.  Sorting
    uses the timestamp, not its text.
    """
    base = extremes
    if dataset is not None:
        base = base.where(F.col("dataset_id") == F.lit(dataset))
    w = Window.partitionBy("dataset_id").orderBy(F.col("win_start").desc())
    return (
        base.withColumn("rn", F.row_number().over(w).cast("long"))
        .where(F.col("rn") <= F.lit(n))
        .select("dataset_id", "win_start", format_winstart("win_start").alias("winstart"),
                F.col("max_value").alias("value"), "rn")
    )


def latest_windows_of(extremes: DataFrame, dataset: str, n: int = config.LATEST_WINDOWS_WIDE) -> DataFrame:
    """Single-dataset top-n as ``ORDER BY win_start DESC LIMIT n``."""
    return (
        extremes.where(F.col("dataset_id") == F.lit(dataset))
        .orderBy(F.col("win_start").desc())
        .limit(n)
        .select("dataset_id", "win_start", format_winstart("win_start").alias("winstart"),
                F.col("max_value").alias("value"))
    )


def ordered_histogram(hist: DataFrame) -> DataFrame:
    """All bins ascending with their 1-based position: ``pos, bin, cnt``.

    ``hist`` has at most one row per bin, so the single collected array is
    bounded by the bin count.
    """
    arr = hist.agg(F.array_sort(F.collect_list(F.struct("bin", "cnt"))).alias("_a"))
    return arr.select(F.posexplode("_a").alias("_p", "_e")).select(
        (F.col("_p") + 1).cast("long").alias("pos"), F.col("_e.bin").alias("bin"), F.col("_e.cnt").alias("cnt")
    )


def latest_streak(streaks: DataFrame) -> DataFrame:
    """The newest streak over all devices: ``device_id, start_ms, starttime, counts``.

    Ties on the start are broken by the larger count, then the device id.
    """
    return (
        streaks.orderBy(F.col("start_ms").desc(), F.col("counts").desc(), F.col("device_id").asc())
        .limit(1)
        .select("device_id", "start_ms", format_winstart(F.timestamp_millis("start_ms")).alias("starttime"),
                "counts")
    )


def temp_humi_by_window(extremes: DataFrame, temperature: str = config.TEMPERATURE,
                        humidity: str = config.HUMIDITY) -> DataFrame:
    """Temperature and humidity maxima side by side, aligned on window start.

    A window present for only one dataset has a null on the other side.
    """
    return (
        extremes.where(F.col("dataset_id").isin(temperature, humidity))
        .groupBy("win_start")
        .pivot("dataset_id", [temperature, humidity])
        .agg(F.max("max_value"))
        .select(
            "win_start",
            format_winstart("win_start").alias("winstart"),
            F.col(f"`{temperature}`").alias("temp_max"),
            F.col(f"`{humidity}`").alias("humi_max"),
        )
    )


def dashboard_snapshot(hist: DataFrame, extremes: DataFrame, streaks: DataFrame,
                       temperature: str = config.TEMPERATURE, humidity: str = config.HUMIDITY,
                       n: int = config.LATEST_WINDOWS) -> DataFrame:
    """One row merging the histogram, newest windows per dataset and newest streak.

    The parts are bounded (bins, 2 x n windows, 1 streak); they are tagged,
    unioned and folded by one global aggregate, so no join is involved.
    Output columns: ``starttime, counts, tempinterval, intervalcount,
    tempwinstart, tempvalues, humiwinstart, humivalues``.
    """
    empty_s, empty_d, empty_l = F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(None).cast("long")
    h = hist.select(F.lit("hist").alias("part"), F.lit(0).alias("pos"), empty_s.alias("label"),
                    F.col("bin").cast("double").alias("num"), F.col("cnt").cast("long").alias("cnt"))
    wins = latest_windows(extremes.where(F.col("dataset_id").isin(temperature, humidity)), n)
    w = wins.select(
        F.when(F.col("dataset_id") == F.lit(temperature), F.lit("temp")).otherwise(F.lit("humi")).alias("part"),
        F.col("rn").cast("int").alias("pos"), F.col("winstart").alias("label"),
        F.col("value").cast("double").alias("num"), empty_l.alias("cnt"),
    )
    s = latest_streak(streaks).select(F.lit("streak").alias("part"), F.lit(1).alias("pos"),
                                      F.col("starttime").alias("label"), empty_d.alias("num"),
                                      F.col("counts").cast("long").alias("cnt"))
    parts = h.unionByName(w).unionByName(s)

    def sorted_part(name: str, *fields: str):
        return F.array_sort(F.collect_list(F.when(F.col("part") == F.lit(name), F.struct(*fields))))

    folded = parts.agg(
        sorted_part("hist", "num", "cnt").alias("_h"),
        sorted_part("temp", "pos", "label", "num").alias("_t"),
        sorted_part("humi", "pos", "label", "num").alias("_u"),
        F.max(F.when(F.col("part") == F.lit("streak"), F.col("label"))).alias("starttime"),
        F.max(F.when(F.col("part") == F.lit("streak"), F.col("cnt"))).alias("counts"),
    )
    return folded.select(
        "starttime", "counts",
        F.transform("_h", lambda x: x["num"]).alias("tempinterval"),
        F.transform("_h", lambda x: x["cnt"]).alias("intervalcount"),
        F.transform("_t", lambda x: x["label"]).alias("tempwinstart"),
        F.transform("_t", lambda x: x["num"]).alias("tempvalues"),
        F.transform("_u", lambda x: x["label"]).alias("humiwinstart"),
        F.transform("_u", lambda x: x["num"]).alias("humivalues"),
    )


def dashboard_json(snapshot: DataFrame) -> DataFrame:
    """The snapshot as one JSON text payload (column ``payload``)."""
    return snapshot.select(F.to_json(F.struct(*snapshot.columns)).alias("payload"))


def dashboard_text(snapshot: DataFrame, sep: str = ";") -> DataFrame:
    """The snapshot with arrays joined to text and doubles printed as %.2f."""
    def nums(c):
        return F.array_join(F.transform(c, lambda x: F.format_string("%.2f", x)), sep)

    return snapshot.select(
        "starttime", "counts",
        nums("tempinterval").alias("tempinterval"),
        F.array_join(F.transform("intervalcount", lambda x: x.cast("string")), sep).alias("intervalcount"),
        F.array_join("tempwinstart", sep).alias("tempwinstart"),
        nums("tempvalues").alias("tempvalues"),
        F.array_join("humiwinstart", sep).alias("humiwinstart"),
        nums("humivalues").alias("humivalues"),
    )

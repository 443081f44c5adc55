"""Row filters, parsing and per-row transforms of reading lines and readings.

All of these are narrow (no shuffle) and stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.config import READING_COLS, Cols
from tidewatch.functions.noise import noise
from tidewatch.functions.text import contains_any, contains_none, to_line
from tidewatch.functions.timefmt import ms_to_ts


# -- line filters ------------------------------------------------------------

def drop_lines_containing(df: DataFrame, markers: Iterable[str] = config.DENY_MARKERS,
                          col: str = "value") -> DataFrame:
    """Deny-list: drop lines with any marker anywhere in the text."""
    return df.where(contains_none(col, list(markers)))


def keep_lines_containing(df: DataFrame, markers: Iterable[str] = config.ALLOW_MARKERS,
                          col: str = "value") -> DataFrame:
    """Allow-list: keep lines that mention at least one marker."""
    return df.where(contains_any(col, list(markers)))


#: Outcome of a line that is a reading.
READING = "reading"

# -- parsing -----------------------------------------------------------------

def _parsed(df: DataFrame, col: str, seq: Column | None) -> DataFrame:
    parts = F.split(F.col(col), ",")
    ts_ms = F.expr("try_cast(trim(try_element_at(_p, 3)) AS BIGINT)")
    value = F.expr("try_cast(trim(try_element_at(_p, 4)) AS DOUBLE)")
    return (
        df.withColumn("_p", parts)
        .select(
            F.col(col).alias("line"),
            F.try_element_at("_p", F.lit(1)).alias("device_id"),
            F.try_element_at("_p", F.lit(2)).alias("dataset_id"),
            ts_ms.alias("ts_ms"),
            value.alias("value"),
            (seq if seq is not None else F.xxhash64(F.col(col))).alias("seq"),
            F.size("_p").alias("_nfields"),
        )
        .withColumn("ts", ms_to_ts("ts_ms"))
    )


def _good(parsed: DataFrame) -> Column:
    return (
        (F.col("_nfields") >= 4)
        & F.col("ts_ms").isNotNull()
        & F.col("value").isNotNull()
        & ~F.isnan("value")
    )


def parse_readings(df: DataFrame, col: str = "value", seq: Column | None = None) -> DataFrame:
    """``device,dataset,epoch_ms,value`` lines -> typed readings.

    Fields are positional; extra fields are ignored.  Lines that do not give
    a number in both numeric fields, or give NaN, are not readings: they go
    to :func:`quarantine_lines` instead of failing the job.

    ``seq`` orders readings of one key that share a timestamp.  Lines carry
    no arrival number, so it defaults to a hash of the line text: the same
    on retries, in batch and in streams (where row numbering is not
    available).  Copies of one line tie exactly, and their order changes
    nothing.  Two lines of one device and timestamp with different values are
    ordered by that hash, which need not be their arrival order: a limit for
    streaks over such input.  Where the source numbers its records (a Kafka
    offset, a file's line number), pass that as ``seq``.
    """
    p = _parsed(df, col, seq)
    return p.where(_good(p)).select("device_id", "dataset_id", "ts_ms", "value", "ts", "seq")


def _reason() -> Column:
    return (
        F.when(F.col("line").isNull(), F.lit("no text"))
        .when(F.col("_nfields") < 4, F.lit("too few fields"))
        .when(F.col("ts_ms").isNull(), F.lit("bad timestamp"))
        .when(F.col("value").isNull(), F.lit("bad value"))
        .otherwise(F.lit("NaN value"))
    )


def quarantine_lines(df: DataFrame, col: str = "value", seq: Column | None = None) -> DataFrame:
    """The lines :func:`parse_readings` rejects, with the reason (without the
    deny- and allow-list; :func:`job_quarantine` applies them)."""
    p = _parsed(df, col, seq)
    return p.where(~_good(p) | F.col("line").isNull()).select("line", _reason().alias("reason"))


def classify_parsed(df: DataFrame, deny=config.DENY_MARKERS, allow=config.ALLOW_MARKERS, col: str = "value") -> DataFrame:
    """Every line, parsed once, with its ``outcome``: ``filtered`` (the deny- or
    allow-list leaves it out: housekeeping frames, other datasets), ``reading``,
    or why it is no reading.  The reading columns hold for readings only."""
    parsed = _parsed(df, col, None)
    passed = contains_none("line", list(deny)) & contains_any("line", list(allow))
    outcome = (
        F.when(F.col("line").isNull(), F.lit("no text"))
        .when(~passed, F.lit("filtered"))
        .when(_good(parsed), F.lit(READING))
        .otherwise(_reason())
    )
    return parsed.select("line", "device_id", "dataset_id", "ts_ms", "value", "ts", "seq", outcome.alias("outcome"))


def readings_of_lines(classified: DataFrame) -> DataFrame:
    """The readings among the rows of :func:`classify_parsed`."""
    return classified.where(F.col("outcome") == READING).select("device_id", "dataset_id", "ts_ms", "value", "ts", "seq")


def quarantine_of_lines(classified: DataFrame) -> DataFrame:
    """The lines among those rows that pass the lists (or are null) and are no readings."""
    return classified.where(~F.col("outcome").isin(READING, "filtered")).select("line", F.col("outcome").alias("reason"))


def classify_lines(df: DataFrame, deny=config.DENY_MARKERS, allow=config.ALLOW_MARKERS, col: str = "value") -> DataFrame:
    """Every line with its ``outcome``.  Lines in = readings + filtered + quarantined."""
    return classify_parsed(df, deny, allow, col).select("line", "outcome")


def job_quarantine(df: DataFrame, deny=config.DENY_MARKERS, allow=config.ALLOW_MARKERS, col: str = "value") -> DataFrame:
    """The lines that pass the deny- and allow-list (or are null) and are no
    readings, with the reason: what a job must not lose."""
    return quarantine_of_lines(classify_parsed(df, deny, allow, col))


def lines_to_readings(df: DataFrame, deny=config.DENY_MARKERS, allow=config.ALLOW_MARKERS,
                      col: str = "value", seq: Column | None = None) -> DataFrame:
    """Deny-list, allow-list, then parse: the common front of every job."""
    return parse_readings(keep_lines_containing(drop_lines_containing(df, deny, col), allow, col), col, seq)


# -- reading-level transforms -------------------------------------------------

def only_dataset(df: DataFrame, dataset: str, cols: Cols = READING_COLS) -> DataFrame:
    """Readings of one dataset id (a null id never matches)."""
    return df.where(F.col(cols.dataset) == F.lit(dataset))


def add_noise(df: DataFrame, kind: str = "gaussian", cols: Cols = READING_COLS,
              mode: str = "hashed", seed: int | None = None, salt: str | None = None) -> DataFrame:
    """value += noise.  ``kind`` in {none, gaussian, uniform}.

    The hashed form keys the draw on (device, dataset, order), so a retried
    task or a replayed batch reproduces the same values.  Branches that must
    draw separately pass different ``salt`` values.
    """
    if kind == "none":
        return df
    key = (cols.device, cols.dataset, cols.order)
    return df.withColumn(cols.value, F.col(cols.value) + noise(kind, key, seed=seed, mode=mode, salt=salt))


def with_device_id(df: DataFrame, device_id, col: str = "device_id") -> DataFrame:
    """Attach the device id (a literal, or a column from the request)."""
    value = device_id if isinstance(device_id, Column) else F.lit(device_id)
    return df.withColumn(col, value)


def tag_dataset_header(df: DataFrame, cols: Cols = READING_COLS, col: str = "headers") -> DataFrame:
    """Add the event header ``datasetId`` used by downstream routing.

    The column is an array of (key, binary value) pairs, the form Kafka's
    ``headers`` column takes on write.
    """
    header = F.struct(F.lit("datasetId").alias("key"), F.col(cols.dataset).cast("binary").alias("value"))
    return df.withColumn(col, F.array(header))


def to_lines(df: DataFrame, cols: Cols = READING_COLS, col: str = "value") -> DataFrame:
    """Readings back to ``device,dataset,epoch_ms,value`` lines."""
    return df.select(to_line(cols.device, cols.dataset, cols.ts_ms, cols.value).alias(col))

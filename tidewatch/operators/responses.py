"""Decoding captured platform responses into readings.

A response is the status code plus text whose part after ``body=`` is a
JSON object with a list of device statuses (all fields are strings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import config, schemas
from tidewatch.functions.text import substring_after
from tidewatch.functions.timefmt import ms_to_ts


def only_ok_responses(df: DataFrame, status_col: str = "status_code", ok: int = config.OK_STATUS) -> DataFrame:
    return df.where(F.col(status_col) == F.lit(ok))


def parse_response_body(df: DataFrame, resp_col: str = "resp", out: str = "body") -> DataFrame:
    """Add ``out``: the JSON after ``body=`` as a struct; its ``_corrupt`` field
    holds the text where that is not such an object."""
    text = substring_after(resp_col, config.BODY_MARKER)
    return df.withColumn(out, F.from_json(text, schemas.RESPONSE_BODY_OR_CORRUPT, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}))


def explode_statuses(df: DataFrame, body_col: str = "body", keep=("device_id",)) -> DataFrame:
    """One row per status element with its 1-based ``position``; a response
    without an element keeps one row of nulls.

    The non-outer form would make the optimizer infer a ``size(list) > 0``
    filter and push it below the projection, parsing every body's JSON twice.
    """
    statuses = df.select(*keep, F.posexplode_outer(F.col(f"{body_col}.deviceStatusList")).alias("position", "status"))
    return statuses.withColumn("position", F.col("position") + 1)


def classify_responses(df: DataFrame, resp_col: str = "resp", status_col: str = "status_code") -> DataFrame:
    """OK responses, parsed once: one row per status (or per response without
    one), typed, with the ``reason`` why it is no reading (null for a reading).

    Columns: ``device_id, status_code, resp, position, dataset_id, ts_ms, value,
    reason``.  Readings and quarantine are this table with and without a
    reason, so together they cover every OK response and every status in it.
    """
    ok = parse_response_body(only_ok_responses(df, status_col), resp_col).withColumn(
        "_why", F.when(F.col(resp_col).isNull() | ~F.col(resp_col).contains(config.BODY_MARKER), F.lit("no body"))
        .when(F.col("body").isNull() | F.col(f"body.{schemas.CORRUPT}").isNotNull(), F.lit("unreadable body"))
        .when(F.coalesce(F.size("body.deviceStatusList"), F.lit(0)) < 1, F.lit("no status")))
    rows = explode_statuses(ok, "body", (F.col("device_id").cast("string").alias("device_id"), F.col(status_col).alias("status_code"),
                                         F.col(resp_col).alias("resp"), "_why"))
    typed = rows.select(
        "device_id", "status_code", "resp", "position", F.col("status.datasetId").alias("dataset_id"),
        F.expr("try_cast(status.timestamp AS BIGINT)").alias("ts_ms"), F.expr("try_cast(status.value AS DOUBLE)").alias("value"), "_why")
    reason = (
        F.when(F.col("_why").isNotNull(), F.col("_why"))
        .when(F.col("ts_ms").isNull(), F.lit("bad timestamp"))
        .when(F.col("value").isNull(), F.lit("bad value"))
        .when(F.isnan("value"), F.lit("NaN value"))
    )
    return typed.withColumn("reason", reason).drop("_why")


def readings_of(classified: DataFrame) -> DataFrame:
    """The readings in :func:`classify_responses` rows."""
    return classified.where(F.col("reason").isNull()).select(
        "device_id", "dataset_id", "ts_ms", "value", ms_to_ts("ts_ms").alias("ts"))


def quarantine_of(classified: DataFrame) -> DataFrame:
    """What in :func:`classify_responses` rows is no reading, with the reason."""
    return classified.where(F.col("reason").isNotNull()).select("device_id", "status_code", "resp", "position", "reason")


def decode_responses(df: DataFrame, resp_col: str = "resp", status_col: str = "status_code") -> DataFrame:
    """Responses -> readings: status 200, body JSON, one row per good status
    (:func:`response_quarantine` has the others)."""
    return readings_of(classify_responses(df, resp_col, status_col))


def response_quarantine(df: DataFrame, resp_col: str = "resp", status_col: str = "status_code") -> DataFrame:
    """OK responses without a readable body or a status, and statuses with a bad
    number: ``device_id, status_code, resp, position, reason``."""
    return quarantine_of(classify_responses(df, resp_col, status_col))

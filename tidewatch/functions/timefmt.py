"""Time conversions between epoch milliseconds, timestamps and result text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.functions.text import as_col


def to_ts(col) -> Column:
    """Any time column as a session-zone ``timestamp``.

    Watermarks reject ``timestamp_ntz``; with the session zone pinned to UTC
    the cast keeps the same instant.  Epoch milliseconds (bigint) convert via
    ``timestamp_millis``.
    """
    return as_col(col).cast("timestamp")


def ms_to_ts(col) -> Column:
    return F.timestamp_millis(as_col(col))


def ts_to_ms(col) -> Column:
    """Epoch milliseconds, truncating sub-millisecond digits."""
    return F.unix_millis(as_col(col).cast("timestamp"))


def format_winstart(col, fmt: str = config.WINSTART_FORMAT) -> Column:
    """Result-table text form of a time, e.g. ``2022-03-30:10:05:00``."""
    return F.date_format(as_col(col).cast("timestamp"), fmt)

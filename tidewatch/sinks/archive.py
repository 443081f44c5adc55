"""Raw-line archive laid out as ``<root>/day=<yyyyMMdd>/hour=<HH>/``.

Directory partitions come from a time column: the processing time of the
write (``current_timestamp()``, as an archiving agent stamps files) or the
reading's own event time.  Text files, one line per record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import config


def archive_columns(df: DataFrame, time_col: str | None = None) -> DataFrame:
    """Add ``day`` and ``hour`` text partition columns."""
    t = F.col(time_col).cast("timestamp") if time_col else F.current_timestamp()
    return df.withColumn("day", F.date_format(t, config.ARCHIVE_DAY_FORMAT)).withColumn(
        "hour", F.date_format(t, config.ARCHIVE_HOUR_FORMAT))


def write_archive(lines: DataFrame, root: str, time_col: str | None = None, line_col: str = "value",
                  mode: str = "append") -> None:
    """Write lines under day/hour folders.

    Rows are clustered by (day, hour) so each task writes few files instead of
    one per partition value it happens to hold.  The clustering is a
    ``REBALANCE`` hint, not ``repartition``: with processing-time folders a
    whole batch shares one hour, and AQE splits such an oversized (day, hour)
    partition into advisory-size chunks, so no single task writes the hour.
    """
    arch = archive_columns(lines, time_col).select(line_col, "day", "hour")
    (arch.hint("rebalance", "day", "hour").write.mode(mode).partitionBy("day", "hour").text(root))


def archive_writer(root: str, time_col: str | None = None, line_col: str = "value"):
    """``foreachBatch`` function archiving each batch's lines.  A replayed batch
    is written again: an archive keeps what was received."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_archive(batch, root, time_col, line_col)
    return write


def read_archive(spark, root: str, day: str | None = None, hour: str | None = None) -> DataFrame:
    """Read the archive back; day/hour stay text (no type inference), so
    filters on them prune folders."""
    df = spark.read.format("text").schema("value string, day string, hour string").load(root)
    if day is not None:
        df = df.where(F.col("day") == F.lit(day))
    if hour is not None:
        df = df.where(F.col("hour") == F.lit(hour))
    return df

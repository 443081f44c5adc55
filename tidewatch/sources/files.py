"""Line-oriented file sources, batch and streaming.

A file of ``device,dataset,epoch_ms,value`` lines is the wire format.  The
streaming form follows a directory: Spark's file source picks up new
*files* (rolled logs), remembering which it has seen in the checkpoint; it
does not follow bytes appended to an open file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def text_source(spark: SparkSession, path: str) -> DataFrame:
    """Bounded source: ``value string``, one row per line."""
    return spark.read.text(path)


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded source over a directory of rolled line files, oldest first: a
    watermark would drop older files' rows as late if newer ones came before."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def tail_source(spark: SparkSession, directory: str, max_files_per_trigger: int | None = 100) -> DataFrame:
    """Follow a directory into which a collector drops rolled line files.

    The position of what was read is kept in the query's checkpoint, the
    role a position file plays for a tailing agent.
    """
    return text_stream(spark, directory, max_files_per_trigger=max_files_per_trigger)

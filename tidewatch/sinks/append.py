"""Append sinks made idempotent by the micro-batch id.

Each batch lands in its own ``batch=<id>`` partition, written with dynamic
partition overwrite: replaying a batch id rewrites exactly that partition,
so a restart after a failure cannot duplicate rows.  A query with another
checkpoint, whose ids start anew, is refused (:mod:`.owner`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.sinks.owner import claim, query_id


def append_batch(batch: DataFrame, batch_id: int, root: str, fmt: str = "parquet") -> None:
    (
        batch.withColumn("batch", F.lit(int(batch_id)).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .format(fmt)
        .save(root)
    )


def append_writer(root: str, fmt: str = "parquet"):
    """``foreachBatch`` function for :func:`append_batch`."""
    def write(batch: DataFrame, batch_id: int) -> None:
        claim(batch.sparkSession, root, query_id(batch))
        append_batch(batch, batch_id, root, fmt)
    return write


def read_appended(spark, root: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(root)

"""Tie a sink's folder to the streaming query that fills it.

Micro-batch ids are those of one checkpoint: a query started with a new
checkpoint counts from 0 again.  On an old folder its batches would pass for
replays (an upsert would skip them, an append overwrite older ones).  The first
batch therefore writes the query's id into the folder, and batches of any other
query are refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OWNER = "_owner"


class OtherQueryError(RuntimeError):
    """A folder is filled by another streaming query (another checkpoint)."""


def hadoop_fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = hadoop_fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        out = []
        while (line := lines.readLine()) is not None:
            out.append(line)
        return "\n".join(out)
    finally:
        stream.close()


def query_id(batch: DataFrame) -> str | None:
    """The id of the streaming query whose ``foreachBatch`` runs (None outside)."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def claim(spark: SparkSession, root: str, owner: str | None) -> None:
    """Let ``owner`` fill ``root``; raises if another query does.  Calls outside a
    streaming query (owner None) are not checked: their ids are the caller's."""
    if owner is None:
        return
    path = f"{root.rstrip('/')}/{OWNER}"
    held = read_text(spark, path)
    if held is None:
        write_text(spark, path, owner)
    elif held != owner:
        raise OtherQueryError(f"{root} is filled by streaming query {held}; query {owner} has a checkpoint of its own and "
                              "its batch ids do not continue there: use that query's checkpoint, or a new folder")

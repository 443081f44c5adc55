"""Small state tables of ``foreachBatch`` streams: one Parquet folder per batch id.

``version=<id>`` holds the whole table after that batch.  A batch reads the newest
version before its own id and writes its own, so a replay starts from the same
state and overwrites the same folder.  Only the folders a replay can still need
(the batch's own and the one it read) are kept; how much a batch reads therefore
depends on the size of the state, never on how many batches went before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.sinks.owner import hadoop_fs

_PREFIX = "version="


def versions(spark: SparkSession, root: str) -> list[int]:
    """Ids of the committed versions, ascending (Spark's commit marks a folder)."""
    fs, path = hadoop_fs(spark, root)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    ids = sorted(int(n[len(_PREFIX):]) for n in names if n.startswith(_PREFIX))
    return [v for v in ids if fs.exists(hadoop_fs(spark, f"{root}/{_PREFIX}{v}/_SUCCESS")[1])]


def read_version(spark: SparkSession, root: str, schema, before: int | None = None) -> DataFrame:
    """The newest committed version (with an id below ``before``); an empty frame
    of ``schema`` where there is none."""
    found = [v for v in versions(spark, root) if before is None or v < before]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{_PREFIX}{found[-1]}")


def write_version(table: DataFrame, root: str, batch_id: int) -> None:
    """Write the table as it is after ``batch_id``, then drop versions that no
    replay can need any more."""
    spark = table.sparkSession
    table.write.mode("overwrite").parquet(f"{root}/{_PREFIX}{batch_id}")
    earlier = [v for v in versions(spark, root) if v < batch_id]
    for v in earlier[:-1]:
        fs, path = hadoop_fs(spark, f"{root}/{_PREFIX}{v}")
        fs.delete(path, True)

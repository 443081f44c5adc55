"""Keyed upsert on Parquet: a folder per micro-batch, resolved when read.

Every batch is reduced to one row per key and written to its own ``batch=<id>``
partition with Spark's dynamic partition overwrite, so a replayed batch rewrites
exactly its partition: ``foreachBatch``'s at-least-once replays apply once, and a
write costs O(batch).  A read takes, per key, the row with the largest order
column, else (and among equals) the newest batch.  The keys and the order column
are column metadata of the Parquet schema, so the folder is an ordinary Parquet
table.  Where a database is at hand, :mod:`.jdbc_upsert` keeps the resolved table
itself; merging old folders is left to the platform's table maintenance.

Batches of a query with another checkpoint are refused (:mod:`.owner`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.sinks.append import append_batch
from tidewatch.sinks.owner import claim, hadoop_fs, query_id

BATCH = "batch"
_ROLE = "upsert"


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``.  Spark limits the rank within every
    task before the shuffle, so a hot key sends one row per task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= 1).drop("_rank")


def newest_per_key(batch: DataFrame, keys: Sequence[str], order: str | None) -> DataFrame:
    """One whole row per key: the row with the largest ``order`` (any row if None)."""
    if order is None:
        return batch.dropDuplicates(list(keys))
    return first_per_key(batch, keys, [F.col(order).desc_nulls_last()])


def resolve(rows: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per key of rows with a ``batch``: the largest ``order`` wins, then
    the newest batch.  Drops ``batch``."""
    ranks = ([F.col(order).desc_nulls_last()] if order else []) + [F.col(BATCH).desc()]
    return first_per_key(rows, keys, ranks).drop(BATCH)


def upsert(spark: SparkSession, root: str, batch: DataFrame, batch_id: int, keys: Sequence[str],
           order: str | None = None, owner: str | None = None) -> None:
    """Apply ``batch`` as batch ``batch_id``; applying it again changes nothing."""
    claim(spark, root.rstrip("/"), owner)
    role = {**({order: "order"} if order else {}), **{k: "key" for k in keys}}
    marked = [F.col(c).alias(c, metadata={_ROLE: role[c]}) if c in role else F.col(c) for c in batch.columns]
    append_batch(newest_per_key(batch, keys, order).select(*marked), batch_id, root)


def read_table(spark: SparkSession, root: str, schema=None, upto: int | None = None) -> DataFrame | None:
    """The table after every batch (up to id ``upto``), or ``None`` (or an empty
    frame of ``schema``) before the first."""
    fs, path = hadoop_fs(spark, root)
    if not fs.exists(path) or not any(s.getPath().getName().startswith(f"{BATCH}=") for s in fs.listStatus(path)):
        return spark.createDataFrame([], schema) if schema is not None else None
    rows = spark.read.parquet(root).withColumn(BATCH, F.col(BATCH).cast("long"))
    if upto is not None:
        rows = rows.where(F.col(BATCH) <= upto)             # partition pruning
    roles = {f.name: f.metadata.get(_ROLE) for f in rows.schema.fields}
    keys = [c for c, r in roles.items() if r == "key"]
    order = next((c for c, r in roles.items() if r == "order"), None)
    return resolve(rows, keys, order)


def upsert_writer(root: str, keys: Sequence[str], order: str | None = None):
    """``foreachBatch`` function applying each micro-batch with :func:`upsert`."""
    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch.sparkSession, root, batch, batch_id, keys, order, query_id(batch))
    return write

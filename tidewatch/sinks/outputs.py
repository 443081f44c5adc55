"""Plain outputs: line files, console, Kafka, JDBC, and fan-out to several.

Connection settings (brokers, URLs, credentials) are always supplied by the
caller; the library holds none.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import READING_COLS, Cols
from tidewatch.functions.text import to_line


def write_lines(readings: DataFrame, path: str, cols: Cols = READING_COLS, mode: str = "append") -> None:
    """Readings as ``device,dataset,epoch_ms,value`` text lines."""
    readings.select(to_line(cols.device, cols.dataset, cols.ts_ms, cols.value).alias("value")).write.mode(
        mode).text(path)


def console_writer(n: int = 20, truncate: bool = False):
    """``foreachBatch`` function printing each batch (for development)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        print(f"-- batch {batch_id}")
        batch.show(n, truncate=truncate)
    return write


def kafka_frame(df: DataFrame, value_col: str = "value", topic: str | None = None,
                topic_col: str | None = None, key_col: str | None = None,
                headers_col: str | None = None) -> DataFrame:
    """Shape rows for the Kafka sink: value (+ key, topic, headers)."""
    cols = [F.col(value_col).cast("string").alias("value")]
    if key_col:
        cols.append(F.col(key_col).cast("string").alias("key"))
    if topic_col:
        cols.append(F.col(topic_col).alias("topic"))
    elif topic:
        cols.append(F.lit(topic).alias("topic"))
    if headers_col:
        cols.append(F.col(headers_col).alias("headers"))
    return df.select(*cols)


def write_kafka(df: DataFrame, servers: str, acks: str = "1", **options) -> None:
    """Publish a shaped frame (see :func:`kafka_frame`), ``acks=1`` by default."""
    writer = df.write.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", acks)
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.save()


def kafka_writer(servers: str, topic: str | None = None, write: Callable[..., None] = write_kafka, **shape):
    """``foreachBatch`` function publishing each batch (``shape``: the column
    arguments of :func:`kafka_frame`).  A replayed batch is published again, as
    the broker has no batch ids."""
    def run(batch: DataFrame, batch_id: int) -> None:
        write(kafka_frame(batch, topic=topic, **shape), servers)
    return run


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **properties) -> None:
    """Write through the JDBC source (driver jar supplied by the deployment)."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    for k, v in properties.items():
        writer = writer.option(k, v)
    writer.save()


def fan_out(writers: Sequence[Callable[[DataFrame, int], None]]):
    """``foreachBatch`` function sending every batch to each writer.

    The batch is persisted once so the source is not re-read per writer,
    and released afterwards.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for w in writers:
                w(batch, batch_id)
        finally:
            batch.unpersist()
    return write

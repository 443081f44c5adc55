"""Kafka topic source.

Needs the ``spark-sql-kafka`` package on the classpath (supplied by the
deployment, e.g. ``--packages``).  Consumer-group offsets are replaced by
the streaming checkpoint, which is what makes restarts exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_available(spark: SparkSession) -> bool:
    """True when the Kafka data source can be loaded in this JVM."""
    try:
        jvm = spark.sparkContext._jvm
        jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001 - any failure means "not installed"
        return False


def kafka_reader(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
                 stream: bool = True, **options):
    """The configured (not yet loaded) Kafka reader."""
    base = spark.readStream if stream else spark.read
    reader = (
        base.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("includeHeaders", "true")
    )
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader


def kafka_records(df: DataFrame) -> DataFrame:
    """The source's rows as ``value string`` lines with topic, partition, offset
    (arrival order within a partition), time and, where read, headers."""
    headers = [F.col("headers")] if "headers" in df.columns else []
    return df.select(
        F.col("value").cast("string").alias("value"),
        F.col("topic"), F.col("partition"), F.col("offset"), F.col("timestamp").alias("kafka_ts"), *headers,
    )


def kafka_source(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
                 stream: bool = True, **options) -> DataFrame:
    """Records of ``topic`` as ``value string`` lines (plus Kafka metadata)."""
    if not kafka_available(spark):
        raise RuntimeError("Kafka source not on the classpath; add spark-sql-kafka to the job")
    return kafka_records(kafka_reader(spark, servers, topic, starting_offsets, stream, **options).load())

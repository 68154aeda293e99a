"""Producing Kafka records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of a row group of stored records. A row group is read by one task, however large the file is.
RECORD_GROUP_BYTES = 4 * 1024 * 1024


def kafka_values(df: DataFrame, key: Column | None = None) -> DataFrame:
    """Rows as JSON values, ready for the Kafka sink."""
    value = F.to_json(F.struct("*")).alias("value")
    return df.select(value) if key is None else df.select(key.cast("string").alias("key"), value)


def produce(df: DataFrame, servers: str, topic: str) -> None:
    """Write to Kafka; the job fails unless every record was acknowledged.

    The broker creates a missing topic if it is set up to do so.
    """
    writer = df.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("topic", topic).option("kafka.acks", "all").option("kafka.retries", "3").save()


def kafka_records(
    df: DataFrame,
    value: Column,
    topic: str,
    partition: Column,
    offset: Column,
    timestamp: Column,
    key: Column | None = None,
) -> DataFrame:
    """Rows with the columns of the Kafka source."""
    no_key = F.lit(None).cast("binary")
    return df.select(
        (no_key if key is None else key.cast("string").cast("binary")).alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
    )


def write_records(records: DataFrame, path: str, files: int | None = None) -> str:
    """File-backed twin of a topic; ``files`` sets how many files a stream can pick up one by one."""
    if files is not None:
        records = records.repartition(files)
    records.write.mode("append").option("parquet.block.size", RECORD_GROUP_BYTES).parquet(path)
    return path

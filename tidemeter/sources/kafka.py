"""Kafka reads, and the same records read from files.

The Kafka functions need the Kafka connector on the class path. A record set written by
``tidemeter.sinks.kafka.write_records`` has the columns of the Kafka source, so everything after the
read is the same for both.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tidemeter.functions.columns import split_names
from tidemeter.schemas import KAFKA_RECORD
from tidemeter.session import read_in_small_tasks

MAX_OFFSETS_PER_TRIGGER = 50_000


def kafka_options(
    servers: str,
    topics: str,
    starting: str = "earliest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of a streaming read; ``min_partitions`` lets more tasks share one topic partition."""
    options = {
        "kafka.bootstrap.servers": ",".join(split_names(servers)),
        "subscribe": ",".join(split_names(topics)),
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_incremental(
    spark: SparkSession,
    servers: str,
    topic: str,
    min_partitions: int | None = None,
    max_offsets: int | None = MAX_OFFSETS_PER_TRIGGER,
) -> DataFrame:
    """From the earliest offset, lost offsets tolerated, ``max_offsets`` records per micro-batch (null: all there
    are). A large backlog needs a larger number than the default, or it becomes very many micro-batches."""
    options = kafka_options(servers, topic, "earliest", max_offsets, min_partitions)
    return spark.readStream.format("kafka").options(**options).load()


def kafka_latest(
    spark: SparkSession, servers: str, topic: str, min_partitions: int | None = None
) -> DataFrame:
    """From the latest offset on the first run, no bound per micro-batch."""
    options = kafka_options(servers, topic, "latest", None, min_partitions)
    return spark.readStream.format("kafka").options(**options).load()


def kafka_multi(
    spark: SparkSession, servers: str, topics: str, min_partitions: int | None = None
) -> DataFrame:
    """Several topics given as a comma list; blanks around and between commas are ignored."""
    options = kafka_options(servers, topics, "latest", None, min_partitions)
    return spark.readStream.format("kafka").options(**options).load()


def kafka_bounded(
    spark: SparkSession, servers: str, topic: str, min_partitions: int | None = None
) -> DataFrame:
    """Everything a topic holds now, as a batch; a missing topic gives no rows."""
    options = kafka_options(servers, topic, "earliest", None, min_partitions)
    options["endingOffsets"] = "latest"
    try:
        records = spark.read.format("kafka").options(**options).load()
        records.isEmpty()  # the topic is looked up when the job starts
        return records
    except Exception as error:
        if "UnknownTopicOrPartition" in str(error):
            return spark.createDataFrame([], KAFKA_RECORD)
        raise


def records_stream(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """File-backed twin of the streaming reads; ``max_files`` or ``max_bytes`` bounds a micro-batch.

    Bytes are those of the files; a micro-batch takes at least one file, whatever its size.
    """
    read_in_small_tasks(spark)
    reader = spark.readStream.schema(KAFKA_RECORD).format("parquet")
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def records_bounded(spark: SparkSession, path: str, topics: str | None = None) -> DataFrame:
    """File-backed twin of the bounded read; a missing folder gives no rows."""
    read_in_small_tasks(spark)
    try:
        records = spark.read.schema(KAFKA_RECORD).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], KAFKA_RECORD)
        raise
    if topics is not None:
        records = records.filter(records["topic"].isin(split_names(topics)))
    return records

"""Checkpointed streams that write one batch of a table per micro-batch.

The batch id is made of the stream's name and the micro-batch number, and a batch is written by
overwriting its own partitions. A micro-batch that runs again after a failure therefore leaves the
same rows. A stream that starts over with a new checkpoint needs a new name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemeter.operators.bronze import bronze_events_first_reading, bronze_readings
from tidemeter.operators.points import (
    dead_letter_status,
    documents,
    parse_records,
    points_from_records,
)
from tidemeter.schemas import EVENT_BRONZE, POINTS, READING_BRONZE, TableSpec
from tidemeter.sinks.tables import TableStore

BatchBuilder = Callable[[DataFrame, str], DataFrame]


def batch_name(stream: str, epoch: int) -> str:
    return f"{stream}_{epoch:012d}"


def start_batches(
    records: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    drain: bool = True,
) -> StreamingQuery:
    """Run ``handle`` per micro-batch; ``drain`` stops once everything present is read."""
    writer = records.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer).start()


def stream_to_table(
    records: DataFrame,
    store: TableStore,
    spec: TableSpec,
    build: BatchBuilder,
    checkpoint: str,
    stream: str,
    drain: bool = True,
) -> StreamingQuery:
    """Write ``build(batch, batch_id)`` of every micro-batch that has rows."""
    store.ensure([spec])

    def handle(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        batch_id = batch_name(stream, epoch)
        store.overwrite_batches(build(batch, batch_id), spec, [batch_id])

    return start_batches(records, handle, checkpoint, drain)


def bronze_stream_readings(
    records: DataFrame, store: TableStore, checkpoint: str, stream: str = "readings"
) -> StreamingQuery:
    """Kafka records -> one bronze row per reading."""

    def build(batch: DataFrame, batch_id: str) -> DataFrame:
        return bronze_readings(batch, F.lit(batch_id), F.current_timestamp())

    return stream_to_table(records, store, READING_BRONZE, build, checkpoint, stream)


def bronze_stream_events(
    records: DataFrame, store: TableStore, checkpoint: str, stream: str = "events"
) -> StreamingQuery:
    """Kafka records -> one bronze row per event."""

    def build(batch: DataFrame, batch_id: str) -> DataFrame:
        return bronze_events_first_reading(batch, F.lit(batch_id), F.current_timestamp())

    return stream_to_table(records, store, EVENT_BRONZE, build, checkpoint, stream)


def points_stream(
    records: DataFrame,
    store: TableStore,
    checkpoint: str,
    stream: str = "points",
    processed_at: Column | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Kafka records -> flattened points; invalid messages are dropped."""

    def build(batch: DataFrame, batch_id: str) -> DataFrame:
        at = F.current_timestamp() if processed_at is None else processed_at
        return points_from_records(batch, at).withColumn("batch_id", F.lit(batch_id))

    return stream_to_table(records, store, POINTS, build, checkpoint, stream, drain)


def dead_letter_stream(
    records: DataFrame, path: str, checkpoint: str, stream: str = "letters"
) -> StreamingQuery:
    """Split records into ``status=valid`` and ``status=invalid`` with one write per micro-batch."""

    def handle(batch: DataFrame, epoch: int) -> None:
        marked = dead_letter_status(parse_records(batch)).drop("event")
        marked.withColumn("batch_id", F.lit(batch_name(stream, epoch))).write.mode(
            "overwrite"
        ).option("partitionOverwriteMode", "dynamic").partitionBy("status", "batch_id").parquet(path)

    return start_batches(records, handle, checkpoint)


def documents_stream(
    records: DataFrame, path: str, checkpoint: str, stream: str = "documents"
) -> StreamingQuery:
    """Events as JSON documents, each batch stamped with one ingestion time."""

    def handle(batch: DataFrame, epoch: int) -> None:
        stamped = documents(batch, F.current_timestamp()).select("document")
        stamped.withColumn("batch_id", F.lit(batch_name(stream, epoch))).write.mode(
            "overwrite"
        ).option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").json(path)

    return start_batches(records, handle, checkpoint)

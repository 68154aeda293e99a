"""Bronze -> silver -> gold, batch by batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.operators.gold import gold_events, gold_readings
from tidemeter.operators.serving import row_count, validate_gold_summary
from tidemeter.operators.silver import silver_metric_map, silver_readings
from tidemeter.schemas import EVENT_LAYERS, READING_LAYERS, TableSpec
from tidemeter.sinks.tables import TableStore
from tidemeter.streaming.jobs import bronze_stream_events, bronze_stream_readings

# Batches handled by one job: bounds the id list in the query, not the work that gets done.
BATCHES_PER_JOB = 200


@dataclass(frozen=True)
class LayerReport:
    batches: int
    rows: int


def pending_ids(store: TableStore, upstream: str, downstream: str, n: int) -> list[str]:
    """The first ``n`` batches complete upstream and not downstream, from the commit log."""
    done = store.committed_batches(downstream)
    waiting = store.committed_batches(upstream).join(done, "batch_id", "left_anti")
    return [row.batch_id for row in waiting.orderBy("batch_id").limit(n).collect()]


def refine(
    store: TableStore,
    upstream: TableSpec,
    downstream: TableSpec,
    build: Callable[[DataFrame], DataFrame],
    batches_per_job: int = BATCHES_PER_JOB,
) -> LayerReport:
    """Process all pending batches of a layer.

    The ids come from the small commit log, so a job reads only the partitions of its own batches and
    never joins the tables themselves. A batch that yields no rows is logged like any other and is not
    read again.
    """
    batches = rows = 0
    while ids := pending_ids(store, upstream.name, downstream.name, batches_per_job):
        source = store.scan(upstream.name).filter(F.col("batch_id").isin(*ids))
        rows += store.overwrite_batches(build(source), downstream, ids)
        batches += len(ids)
        if len(ids) < batches_per_job:
            break
    return LayerReport(batches, rows)


def refine_readings(
    store: TableStore, at: Column | None = None, mode: str = "per_field"
) -> tuple[LayerReport, LayerReport]:
    """Silver and gold of the per-reading flow."""
    bronze, silver, gold = READING_LAYERS
    at = F.current_timestamp() if at is None else at
    to_silver = refine(store, bronze, silver, lambda df: silver_readings(df, at))
    to_gold = refine(store, silver, gold, lambda df: gold_readings(df, at, mode))
    return to_silver, to_gold


def refine_events(store: TableStore, at: Column | None = None) -> tuple[LayerReport, LayerReport]:
    """Silver and gold of the per-event flow."""
    bronze, silver, gold = EVENT_LAYERS
    at = F.current_timestamp() if at is None else at
    to_silver = refine(store, bronze, silver, lambda df: silver_metric_map(df, at))
    to_gold = refine(store, silver, gold, lambda df: gold_events(df, at))
    return to_silver, to_gold


def run_readings_medallion(
    records: DataFrame, store: TableStore, checkpoint: str, stream: str = "readings"
) -> DataFrame:
    """Drain the stream into bronze, refine, and summarize the gold table."""
    store.ensure(READING_LAYERS)
    bronze_stream_readings(records, store, checkpoint, stream).awaitTermination()
    refine_readings(store)
    return validate_gold_summary(store.scan(READING_LAYERS[2].name))


def run_events_medallion(
    records: DataFrame, store: TableStore, checkpoint: str, stream: str = "events"
) -> DataFrame:
    """Drain the stream into bronze, refine, and count the gold table."""
    store.ensure(EVENT_LAYERS)
    bronze_stream_events(records, store, checkpoint, stream).awaitTermination()
    refine_events(store)
    return row_count(store.scan(EVENT_LAYERS[2].name))

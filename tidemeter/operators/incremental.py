"""Which batches still have to be processed."""

from __future__ import annotations

from pyspark.sql import DataFrame

def distinct_batches(table: DataFrame) -> DataFrame:
    return table.select("batch_id").distinct()


def pending_batches(upstream: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of the upstream layer whose batch is not among the batches done."""
    return upstream.join(distinct_batches(done), "batch_id", "left_anti")


def has_pending(upstream: DataFrame, done: DataFrame) -> bool:
    return not pending_batches(upstream, done).isEmpty()

"""Wide dataset, collector batches to events, points and data-quality runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemeter.operators.collector import route_batches, routed_events
from tidemeter.operators.quality import gate, load_suites, run_suites
from tidemeter.operators.wide import forward_fill, pivot_bins, present_metrics
from tidemeter.schemas import POINTS, WIDE_BIN_NS, WIDE_METRICS
from tidemeter.sinks.exports import export_csv
from tidemeter.sinks.tables import TableStore
from tidemeter.sources.files import csv_asset
from tidemeter.streaming.jobs import points_stream


def wide_dataset(
    readings: DataFrame, metrics: Sequence[str] = WIDE_METRICS, width: int = WIDE_BIN_NS
) -> DataFrame:
    """Filter, bin, pivot and forward-fill, columns in the order of ``metrics``."""
    return forward_fill(pivot_bins(readings, metrics, width), metrics, width)


def run_wide_dataset(
    readings: DataFrame,
    path: str,
    metrics: Sequence[str] = WIDE_METRICS,
    width: int = WIDE_BIN_NS,
    drop_absent: bool = False,
) -> DataFrame:
    """Write the wide dataset as CSV (replacing an earlier one) and return it.

    ``drop_absent`` leaves out the columns of metrics that never occur.
    """
    wide = wide_dataset(readings, metrics, width)
    if drop_absent:
        present = present_metrics(pivot_bins(readings, metrics, width), metrics)
        wide = wide.drop(*[m for m in metrics if m not in present])
    export_csv(wide, path)
    return wide


def run_collector_to_events(
    batches: DataFrame,
    doc_id: str,
    text: str,
    device_name: Column,
    profile_name: Column,
    origin: Column,
) -> DataFrame:
    """Collector batches -> one event per document and resource.

    Device, profile and origin are expressions on the columns of ``batches``.
    """
    named = batches.select(
        doc_id,
        text,
        device_name.alias("device_name"),
        profile_name.alias("profile_name"),
        origin.alias("origin"),
    )
    keep = [doc_id, "device_name", "profile_name", "origin"]
    routes = route_batches(named, text, keep)
    return routed_events(
        routes, doc_id, F.col("device_name"), F.col("profile_name"), F.col("origin")
    )


def run_realtime_points(
    records: DataFrame,
    store: TableStore,
    checkpoint: str,
    stream: str = "points",
    processed_at: Column | None = None,
) -> DataFrame:
    """Drain a record stream into the point table and return the table."""
    points_stream(records, store, checkpoint, stream, processed_at, drain=True).awaitTermination()
    return store.scan(POINTS.name)


def run_quality(
    spark: SparkSession,
    suite_dir: str,
    data_dir: str,
    schemas: dict[str, T.StructType | str],
    stop_on_failure: bool = False,
    pattern: str = "*.json",
) -> DataFrame:
    """Run all suites of a folder against the CSV assets they name."""
    suites = load_suites(spark, suite_dir, pattern)
    names = [suite["data_asset_name"] for suite in suites]
    assets = {name: csv_asset(spark, data_dir, name, schemas[name]) for name in names}
    results = run_suites(assets, suites)
    if stop_on_failure:
        gate(results)
    return results

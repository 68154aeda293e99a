"""CSV and JSON exports, table preview."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemeter.sinks.tables import TableStore
from tidemeter.sources.files import CSV_OPTIONS


def export_csv(df: DataFrame, path: str) -> str:
    """CSV with header, replacing an earlier export; one part per partition, each with the header, which read
    back as one table."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def latest_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def latest_silver(silver: DataFrame, device_name: str) -> DataFrame:
    """Newest 200 rows of one device, or, if it has none, newest 100 of all."""
    newest = [
        F.col("event_time").desc_nulls_last(),
        F.col("event_id"),
        F.col("resource_name"),
        F.col("metric_value"),
    ]
    own = silver.filter(F.col("device_name") == device_name)
    if own.isEmpty():
        return latest_rows(silver, newest, 100)
    return latest_rows(own, newest, 200)


def latest_gold(gold: DataFrame) -> DataFrame:
    """Newest 100 windows, times as text."""
    newest = [
        F.col("window_start").desc(),
        F.col("device_name"),
        F.col("profile_name"),
        F.col("resource_name"),
        F.col("batch_id"),
    ]
    top = latest_rows(gold, newest, 100)
    for name in ("window_start", "generated_at"):
        if name in gold.columns:
            top = top.withColumn(name, F.col(name).cast("string"))
    return top


def json_records(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("record"))


@dataclass
class Preview:
    status: str  # "ok", "empty" or "not found"
    rows: int
    sample: DataFrame | None


def preview_table(store: TableStore, name: str, n: int = 20) -> Preview:
    """Row count and first rows; a missing or an empty table is reported, not raised."""
    if not store.exists(name):
        return Preview("not found", 0, None)
    table = store.scan(name)
    rows = table.count()
    if rows == 0:
        return Preview("empty", 0, None)
    return Preview("ok", rows, table.limit(n))

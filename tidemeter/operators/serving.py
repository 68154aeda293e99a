"""Queries a dashboard asks of the gold tables.

``as_of`` stands for "now", so that a result can be repeated. ``device_name`` is the device the user
picked; without one a panel answers for every device.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.functions.columns import round_half_up
from tidemeter.functions.time import format_datetime, hour_bucket, minutes_before
from tidemeter.operators.newest import newest_rows
from tidemeter.schemas import DEFAULT_TREND_MINUTES, READING_GOLD, THRESHOLDS
from tidemeter.sinks.tables import TableStore


def _for_device(gold: DataFrame, device_name: str | None) -> DataFrame:
    return gold if device_name is None else gold.filter(F.col("device_name") == device_name)


def _recent(gold: DataFrame, as_of: Column, minutes: int) -> DataFrame:
    """Windows of the last minutes; the day condition lets the scan skip whole partitions."""
    start = minutes_before(as_of, minutes)
    recent = gold.filter(F.col("window_start") >= start)
    if "event_date" in gold.columns:
        recent = recent.filter(F.col("event_date") >= F.to_date(start))
    return recent


def latest_metric(gold: DataFrame, resource_name: str, device_name: str) -> DataFrame:
    """Mean of the newest window of one metric and device; ties settled by batch."""
    rows = gold.filter(
        (F.col("resource_name") == resource_name) & (F.col("device_name") == device_name)
    )
    order = [F.col(c).desc() for c in ("window_start", "batch_id", "profile_name")]
    newest = rows.orderBy(*order).limit(1)
    return newest.select("avg_value")


def latest_metric_by_device(gold: DataFrame, resource_names: Sequence[str]) -> DataFrame:
    """The same answer for every device at once, without ordering the table."""
    rows = gold.filter(F.col("resource_name").isin(*resource_names))
    newest = F.max(F.struct("window_start", "batch_id", "profile_name", "avg_value"))
    groups = rows.groupBy("device_name", "resource_name").agg(newest.alias("n"))
    return groups.select("device_name", "resource_name", "n.window_start", "n.avg_value")


def trend_metric(
    gold: DataFrame,
    resource_name: str,
    as_of: Column,
    minutes: int = DEFAULT_TREND_MINUTES,
    device_name: str | None = None,
) -> DataFrame:
    """Windows of one metric over the last minutes, in time order."""
    rows = _for_device(_recent(gold, as_of, minutes), device_name)
    rows = rows.filter(F.col("resource_name") == resource_name)
    return rows.select(
        F.col("window_start").alias("time"), "device_name", "avg_value", "min_value", "max_value"
    ).orderBy("time", "device_name")


def trend_pair(
    gold: DataFrame,
    resources: Sequence[str],
    as_of: Column,
    minutes: int = DEFAULT_TREND_MINUTES,
    device_name: str | None = None,
) -> DataFrame:
    """Two or more metrics side by side on one time axis, from one scan, with every gold row of each.

    A window of one metric may have several rows, one for each profile and batch. The row of a metric stands beside the row that the
    others have for the same profile and batch, and beside nothing where they have none.
    """
    rows = _for_device(_recent(gold, as_of, minutes), device_name)
    rows = rows.filter(F.col("resource_name").isin(*resources))
    lanes = [
        F.max(F.when(F.col("resource_name") == name, F.col("avg_value"))).alias(name)
        for name in resources
    ]
    keys = ("device_name", "profile_name", "batch_id")
    return rows.groupBy(F.col("window_start").alias("time"), *keys).agg(*lanes).orderBy("time", *keys)


def gold_ledger(
    gold: DataFrame,
    as_of: Column,
    minutes: int = DEFAULT_TREND_MINUTES,
    device_name: str | None = None,
    n: int = 100,
) -> DataFrame:
    """Audit table of the newest windows, values rounded to two digits."""
    rows = _for_device(_recent(gold, as_of, minutes), device_name)
    newest = rows.orderBy(
        F.col("window_start").desc(),
        F.col("resource_name"),
        F.col("device_name"),
        F.col("profile_name"),
        F.col("batch_id"),
    ).limit(n)
    return newest.select(
        format_datetime("window_start").alias("time_window"),
        F.col("resource_name").alias("metric_type"),
        round_half_up("avg_value", 2).alias("average_value"),
        round_half_up("min_value", 2).alias("minimum_value"),
        round_half_up("max_value", 2).alias("maximum_value"),
        "sample_count",
    )


def newest_gold(gold: DataFrame, n: int) -> DataFrame:
    """The newest gold rows, ties settled by the names."""
    order = [F.col(c) for c in ("device_name", "profile_name", "resource_name", "batch_id")]
    return gold.orderBy(F.col("window_start").desc(), *order).limit(n)


def gold_top10(gold: DataFrame) -> DataFrame:
    return newest_gold(gold, 10)


def device_latest50(gold: DataFrame, device_name: str) -> DataFrame:
    return newest_gold(_for_device(gold, device_name), 50)


# -- the same, of a stored gold table, reading its newest days only --


def _named(**names: str | None) -> Column:
    condition = F.lit(True)
    for column, value in names.items():
        if value is not None:
            condition = condition & (F.col(column) == value)
    return condition


def stored_latest_metric(store: TableStore, resource_name: str, device_name: str) -> DataFrame:
    """As ``latest_metric``."""
    order = [F.col(c).desc() for c in ("batch_id", "profile_name")]
    named = _named(resource_name=resource_name, device_name=device_name)
    return newest_rows(store, READING_GOLD, 1, order, named).select("avg_value")


def stored_newest_gold(store: TableStore, n: int, device_name: str | None = None) -> DataFrame:
    """As ``newest_gold``, of one device or all."""
    order = [F.col(c) for c in ("device_name", "profile_name", "resource_name", "batch_id")]
    return newest_rows(store, READING_GOLD, n, order, _named(device_name=device_name)).drop("event_date")


def threshold_state(
    readings: DataFrame, limits: Mapping[str, tuple[float, float]] = THRESHOLDS
) -> DataFrame:
    """Add ``state``: green, yellow or red by the limits of the metric; null for other metrics."""
    state = F.lit(None).cast("string")
    for resource, (yellow, red) in limits.items():
        level = (
            F.when(F.col("avg_value") >= red, "red")
            .when(F.col("avg_value") >= yellow, "yellow")
            .when(F.col("avg_value").isNotNull(), "green")
        )
        state = F.when(F.col("resource_name") == resource, level).otherwise(state)
    return readings.withColumn("state", state)


def legend_reduce(gold: DataFrame) -> DataFrame:
    """Chart legend per series: mean, maximum, minimum and the last non-null value."""
    seen = F.when(F.col("avg_value").isNotNull(), F.struct("window_start", "batch_id", "profile_name"))
    return gold.groupBy("device_name", "resource_name").agg(
        F.avg("avg_value").alias("mean_value"),
        F.max("avg_value").alias("max_value"),
        F.min("avg_value").alias("min_value"),
        F.max_by("avg_value", seen).alias("last_value"),
    )


def validate_gold_summary(gold: DataFrame, n: int = 50) -> DataFrame:
    """Per device and metric: windows, unweighted mean of the window means, last load time."""
    groups = gold.groupBy("device_name", "resource_name").agg(
        F.count(F.lit(1)).alias("total_windows"),
        F.avg("avg_value").alias("overall_avg"),
        F.max("generated_at").alias("last_updated"),
    )
    return groups.orderBy("resource_name", "device_name").limit(n)


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("row_count"))


def count_layers(layers: Mapping[str, DataFrame]) -> DataFrame:
    """One row per layer with its row count."""
    counts = [
        row_count(table).select(F.lit(name).alias("layer"), "row_count")
        for name, table in layers.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def avg_of_avgs(gold: DataFrame) -> DataFrame:
    return gold.agg(F.avg("avg_value").alias("avg_of_avgs"))


def probe_count(gold: DataFrame, device_name: str) -> DataFrame:
    """Rows of one device; more than none means its probe arrived."""
    return row_count(_for_device(gold, device_name)).withColumn("arrived", F.col("row_count") > 0)


def rows_per_profile(table: DataFrame) -> DataFrame:
    return table.groupBy("profile_name").agg(F.count(F.lit(1)).alias("row_count"))


def profile_sample(table: DataFrame, profile_name: str, n: int = 5) -> DataFrame:
    return table.filter(F.col("profile_name") == profile_name).limit(n)


def hourly_avg(gold: DataFrame, resource_name: str) -> DataFrame:
    """Mean of one metric per hour, newest first."""
    rows = gold.filter(F.col("resource_name") == resource_name)
    hours = rows.groupBy(hour_bucket("window_start").alias("hour")).agg(
        F.avg("avg_value").alias("avg_value")
    )
    return hours.orderBy(F.col("hour").desc())

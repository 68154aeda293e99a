"""Silver -> gold: window aggregates per device and metric."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.functions.payload import JSON_OPTIONS, NUMBER_MAP, VARIANT_MAP, variant_number
from tidemeter.functions.time import FIVE_MINUTES, HALF_HOUR, window_start
from tidemeter.schemas import NUMERIC_VALUE_TYPES

SCALAR_KEY = "value"


def metric_map(value_type: Column, metric_value: Column, mode: str = "per_field") -> Column:
    """Numbers of a value: ``{"value": x}`` for numeric types, else the members of a JSON object.

    ``per_field`` keeps the members that are JSON numbers. ``strict`` reads the object as a map of
    doubles, which is null as a whole if any member is something else.
    """
    if mode == "strict":
        members = F.from_json(metric_value, NUMBER_MAP, JSON_OPTIONS)
        members = F.map_entries(members)
    elif mode == "per_field":
        members = F.transform(
            F.map_entries(F.from_json(metric_value, VARIANT_MAP, JSON_OPTIONS)),
            lambda e: F.struct(e["key"].alias("key"), variant_number(e["value"]).alias("value")),
        )
    else:
        raise ValueError(f"unknown mode {mode!r}")
    scalar = F.array(
        F.struct(
            F.lit(SCALAR_KEY).alias("key"), metric_value.try_cast("double").alias("value")
        )
    )
    return F.when(value_type.isin(*NUMERIC_VALUE_TYPES), scalar).otherwise(members)


def gold_metrics(silver: DataFrame, mode: str = "per_field") -> DataFrame:
    """One row per number; the resource name is extended by the member key unless that is ``value``."""
    entries = metric_map(F.col("value_type"), F.col("metric_value"), mode)
    resource = F.coalesce("resource_name", F.lit("unknown"))
    numbers = silver.select("*", F.inline_outer(entries).alias("metric_key", "metric_num"))
    return numbers.filter(F.col("metric_num").isNotNull()).withColumn(
        "resource_name",
        F.when(F.col("metric_key") == SCALAR_KEY, resource).otherwise(
            F.concat_ws("_", resource, "metric_key")
        ),
    )


def aggregate_windows(
    numbers: DataFrame, value: str, names: list[str], seconds: int, generated_at: Column
) -> DataFrame:
    """Count, mean, minimum and maximum per window, names and batch.

    Unknown names become ``unknown``; a missing time falls into the load time. Map-side partial
    aggregation keeps a hot device or batch to one row per task and group before the shuffle.
    """
    start = F.coalesce(window_start("event_time", seconds), generated_at).alias("window_start")
    known = [F.coalesce(F.col(name), F.lit("unknown")).alias(name) for name in names]
    keyed = numbers.select(start, *known, "batch_id", F.col(value).alias("v"))
    zero = F.lit(0.0)
    return (
        keyed.groupBy("window_start", *names, "batch_id")
        .agg(
            F.count(F.lit(1)).alias("sample_count"),
            F.coalesce(F.avg("v"), zero).alias("avg_value"),
            F.coalesce(F.min("v"), zero).alias("min_value"),
            F.coalesce(F.max("v"), zero).alias("max_value"),
        )
        .withColumn("generated_at", generated_at)
    )


def gold_readings(silver: DataFrame, generated_at: Column, mode: str = "per_field") -> DataFrame:
    """Five-minute windows per device, profile and resource."""
    names = ["device_name", "profile_name", "resource_name"]
    return aggregate_windows(
        gold_metrics(silver, mode), "metric_num", names, FIVE_MINUTES, generated_at
    )


def gold_events(silver: DataFrame, generated_at: Column) -> DataFrame:
    """Half-hour windows per device, profile, source and metric key; numbers only."""
    names = ["device_name", "profile_name", "source_name", "metric_key"]
    numbers = silver.filter(
        F.col("metric_value_num").isNotNull() & F.col("metric_key").isNotNull()
    )
    return aggregate_windows(numbers, "metric_value_num", names, HALF_HOUR, generated_at)

"""Bronze -> silver: typed metric values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.functions.keyvalue import decode_kv_lines
from tidemeter.functions.payload import TEXT_MAP
from tidemeter.schemas import NUMERIC_VALUE_TYPES, RESOURCE_NUMBER_PATHS


def silver_number(
    value_type: Column,
    resource_name: Column,
    raw_value: Column,
    paths: Mapping[str, tuple[str, ...]] = RESOURCE_NUMBER_PATHS,
) -> Column:
    """The number of a reading: its text if the type is numeric, else one JSON path per resource.

    The branches are alternatives, so a row is parsed for its own resource only.
    """
    number = F.when(value_type.isin(*NUMERIC_VALUE_TYPES), raw_value.try_cast("double"))
    for resource, candidates in paths.items():
        found = F.coalesce(*[F.get_json_object(raw_value, path) for path in candidates])
        number = number.when(resource_name == resource, found.try_cast("double"))
    return number


def silver_readings(bronze: DataFrame, processed_at: Column) -> DataFrame:
    kept = bronze.filter(F.col("resource_name").isNotNull() & F.col("raw_value").isNotNull())
    return kept.select(
        "event_id",
        "device_name",
        "profile_name",
        "resource_name",
        F.coalesce("reading_origin", "event_origin").alias("event_time"),
        F.col("raw_value").alias("metric_value"),
        silver_number(F.col("value_type"), F.col("resource_name"), F.col("raw_value")).alias(
            "metric_value_num"
        ),
        "value_type",
        "batch_id",
        processed_at.alias("processed_at"),
    )


def silver_metric_map(bronze: DataFrame, processed_at: Column) -> DataFrame:
    """Doubly encoded payload -> one row per inner member; the time is the event's origin."""
    outer = F.from_json("raw_value", TEXT_MAP)
    inner = F.from_json(F.try_element_at(outer, F.col("source_name")), TEXT_MAP)
    members = bronze.select("*", F.explode_outer(inner).alias("metric_key", "metric_value"))
    return members.filter(F.col("metric_key").isNotNull()).select(
        "event_id",
        "device_name",
        "profile_name",
        "source_name",
        F.col("event_origin").alias("event_time"),
        "metric_key",
        "metric_value",
        F.col("metric_value").try_cast("double").alias("metric_value_num"),
        "batch_id",
        processed_at.alias("processed_at"),
    )


def not_a_number_count(silver: DataFrame) -> DataFrame:
    """How many silver numbers are NaN: they spread through every average they enter."""
    return silver.groupBy("batch_id").agg(
        F.count_if(F.isnan("metric_value_num")).alias("nan_values"),
        F.count(F.lit(1)).alias("rows"),
    )


def silver_kv_lines(bronze: DataFrame, processed_at: Column) -> DataFrame:
    """Payload of recorded ``key:value`` lines -> one row per line and key; the time is the event's origin."""
    text = F.try_element_at(F.from_json("raw_value", TEXT_MAP), F.col("source_name"))
    named = bronze.select("event_id", "device_name", "profile_name", "source_name", "event_origin", "batch_id", text.alias("_text"))
    return decode_kv_lines(named, F.col("_text")).select(
        "event_id",
        "device_name",
        "profile_name",
        "source_name",
        F.col("event_origin").alias("event_time"),
        "line_number",
        F.col("key").alias("metric_key"),
        F.col("value").alias("metric_value"),
        F.col("value_num").alias("metric_value_num"),
        "batch_id",
        processed_at.alias("processed_at"),
    )

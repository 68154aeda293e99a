"""Gold as mergeable partial aggregates.

A partial row holds count, sum, minimum and maximum of one window, its names and one batch. Partials of a window can be merged in any order
and grouping, and merged partials are partials again, so batches can be stored as they come and a window read as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.functions.time import FIVE_MINUTES, window_start

READING_KEY = ("window_start", "device_name", "profile_name", "resource_name")


def gold_partials(
    numbers: DataFrame, value: str, names: Sequence[str], seconds: int = FIVE_MINUTES
) -> DataFrame:
    """Numbers -> one partial row per window, names and batch. Numbers without a time have a window of their own, null."""
    known = [F.coalesce(F.col(name), F.lit("unknown")).alias(name) for name in names]
    keyed = numbers.select(window_start("event_time", seconds).alias("window_start"), *known, "batch_id", F.col(value).alias("v"))
    return keyed.groupBy("window_start", *names, "batch_id").agg(
        F.count("v").alias("sample_count"),
        F.sum("v").alias("value_sum"),
        F.min("v").alias("min_value"),
        F.max("v").alias("max_value"),
    )


def merge_partials(partials: DataFrame, key: Sequence[str] = READING_KEY) -> DataFrame:
    """One partial row per key."""
    return partials.groupBy(*key).agg(
        F.sum("sample_count").alias("sample_count"),
        F.sum("value_sum").alias("value_sum"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
    )


def finished(partials: DataFrame) -> DataFrame:
    """Partials with the mean in the place of the sum; null for a window without numbers."""
    mean = F.try_divide(F.col("value_sum"), F.col("sample_count"))
    return partials.withColumn("avg_value", mean).drop("value_sum")


def gold_merged(gold: DataFrame, key: Sequence[str] = READING_KEY) -> DataFrame:
    """The gold rows of a window, one for each batch, as one row: counts added, means weighted by counts.

    A gold row without a mean or a count adds nothing to the mean.
    """
    total: Column = F.col("avg_value") * F.col("sample_count")
    return finished(merge_partials(gold.withColumn("value_sum", total), key))

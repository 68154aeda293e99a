"""Selections on stored points: newest, first, range, probe, retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.schemas import RETENTION_SECONDS

SERIES = ("measurement", "source_name", "device_name", "profile_name", "topic", "field")
ARRIVAL = ("ts", "kafka_partition", "kafka_offset")


def _of_days(points: DataFrame, first: Column, last: Column | None = None) -> DataFrame:
    """Of points stored by day only the partitions of the days from ``first`` to ``last``."""
    if "event_date" not in points.columns:
        return points
    days = F.col("event_date") >= F.to_date(first)
    return points.filter(days if last is None else days & (F.col("event_date") <= F.to_date(last)))


def range_series(
    points: DataFrame, measurement: str, field: str, start: Column, stop: Column
) -> DataFrame:
    """All points of one field with start <= ts < stop; other days of a stored table are not read."""
    return _of_days(points, start, stop).filter(
        (F.col("ts") >= start)
        & (F.col("ts") < stop)
        & (F.col("measurement") == measurement)
        & (F.col("field") == field)
    )


def last_per_series(points: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Newest value of each series: number, text or boolean. Of equal times, which all points of a micro-batch
    have, the last by partition and offset counts. One row per task and series is all that is shuffled."""
    last = F.max(F.struct(*ARRIVAL, "value_num", "value_str", "value_bool"))
    chosen = points.groupBy(*keys).agg(last.alias("p"))
    return chosen.select(*keys, "p.ts", "p.value_num", "p.value_str", "p.value_bool")


def first_per_group(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The earliest point of each group, ties settled by partition and offset."""
    first = F.min(F.struct(*ARRIVAL, "value_num", "value_str", "value_bool"))
    chosen = points.groupBy(*keys).agg(first.alias("p"))
    return chosen.select(*keys, "p.ts", "p.value_num", "p.value_str", "p.value_bool")


def probe_lookup(
    points: DataFrame,
    measurement: str,
    device_name: str,
    field: str,
    value: float,
    start: Column,
    stop: Column,
) -> DataFrame:
    """Newest point with exactly this value; no row if the probe has not arrived."""
    hits = range_series(points, measurement, field, start, stop).filter(
        (F.col("device_name") == device_name) & (F.col("value_num") == value)
    )
    return last_per_series(hits)


def retained(points: DataFrame, as_of: Column, seconds: int = RETENTION_SECONDS) -> DataFrame:
    """Points young enough to keep; older days of a stored table are not read."""
    start = as_of - F.make_dt_interval(secs=F.lit(seconds))
    return _of_days(points, start).filter(F.col("ts") >= start)

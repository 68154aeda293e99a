"""Long readings -> wide, forward-filled feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemeter.functions.columns import strict_number
from tidemeter.functions.time import bin_ns
from tidemeter.schemas import WIDE_BIN_NS, WIDE_METRICS

# Bins one forward-fill task looks at per device. A device's bins are distinct, so no window group
# can hold more rows than this, however hot the device is.
BINS_PER_CHUNK = 65_536


def filter_resources(readings: DataFrame, metrics: Sequence[str] = WIDE_METRICS) -> DataFrame:
    return readings.filter(F.col("resource_name").isin(*metrics))


def pivot_bins(
    readings: DataFrame,
    metrics: Sequence[str] = WIDE_METRICS,
    width: int = WIDE_BIN_NS,
    order: Sequence[str] = ("origin", "event_id"),
) -> DataFrame:
    """(device_name, resource_name, value text, origin, ...) -> one row per device and bin.

    The earliest value of a metric in the bin is kept; ``order`` makes "earliest" repeatable. A value
    that is no number fails the query. The metric list is given, so no job looks for it, and all
    metrics of a bin are settled by one aggregation that reduces its rows before the shuffle.
    """
    binned = filter_resources(readings, metrics).select(
        "device_name",
        "resource_name",
        bin_ns("origin", width).alias("bin"),
        strict_number("value").alias("num"),
        F.struct(*order).alias("at"),
    )

    def earliest(metric: str) -> Column:
        own = F.col("resource_name") == metric
        return F.min_by(F.when(own, F.col("num")), F.when(own, F.col("at"))).alias(metric)

    wide = binned.groupBy("device_name", "bin").agg(*[earliest(m) for m in metrics])
    time = F.timestamp_micros(F.call_function("div", F.col("bin"), F.lit(1000)))
    return wide.select("device_name", "bin", time.alias("datetime"), *metrics)


def forward_fill(
    wide: DataFrame,
    metrics: Sequence[str],
    width: int = WIDE_BIN_NS,
    bins_per_chunk: int = BINS_PER_CHUNK,
) -> DataFrame:
    """Fill missing cells from the device's previous bin.

    A device's series is cut into chunks of a fixed number of bins, so that no task ever holds a whole
    device. The last known values before a chunk are found on one small row per chunk and put in front
    of it as one more row, which is dropped after the fill.
    """
    chunked = wide.withColumns(
        {"chunk": bin_ns("bin", width * bins_per_chunk), "carried": F.lit(False)}
    )

    def last_known(metric: str) -> Column:
        at = F.when(F.col(metric).isNotNull(), F.col("bin"))
        return F.max_by(metric, at).alias(metric)

    def latest(metric: str, frame: WindowSpec) -> Column:
        return F.last(metric, ignorenulls=True).over(frame).alias(metric)

    earlier = (
        Window.partitionBy("device_name")
        .orderBy("chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    within = (
        Window.partitionBy("device_name", "chunk")
        .orderBy("bin")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ends = chunked.groupBy("device_name", "chunk").agg(*[last_known(m) for m in metrics])
    before = ends.select(
        "device_name",
        "chunk",
        (F.col("chunk") - 1).alias("bin"),
        F.lit(True).alias("carried"),
        *[latest(m, earlier) for m in metrics],
    )
    rows = chunked.unionByName(before, allowMissingColumns=True)
    others = [c for c in wide.columns if c not in metrics]
    filled = rows.select(*others, "carried", *[latest(m, within) for m in metrics])
    return filled.filter(~F.col("carried")).select(*wide.columns)


def present_metrics(wide: DataFrame, metrics: Sequence[str]) -> list[str]:
    """The metrics that have a value at all, in the given order; one aggregation row."""
    seen = wide.agg(*[F.count(m).alias(m) for m in metrics]).first()
    return [m for m in metrics if seen[m] > 0]

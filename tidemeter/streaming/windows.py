"""Gold windows over a stream: event time, a watermark, each closed window written once.

The state holds partial aggregates of the windows that are still open. A window is closed and written when the watermark, the latest event
time so far less the allowed lateness, has passed its end; its state is dropped then. A reading of a window that was closed before its
micro-batch began is late and is dropped. The checkpoint holds the state, so a restart goes on where it stopped, and
the sink's log makes a repeated micro-batch write its windows once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemeter.functions.time import FIVE_MINUTES
from tidemeter.operators.bronze import bronze_readings
from tidemeter.operators.gold import gold_metrics
from tidemeter.operators.silver import silver_readings

NAMES = ("device_name", "profile_name", "resource_name")

WINDOWS = (
    "window_start TIMESTAMP, device_name STRING, profile_name STRING, resource_name STRING, sample_count BIGINT, "
    "avg_value DOUBLE, min_value DOUBLE, max_value DOUBLE, event_date DATE"
)


def closed_windows(numbers: DataFrame, lateness: str, seconds: int = FIVE_MINUTES) -> DataFrame:
    """Count, mean, minimum and maximum per window and names of a stream of numbers (event_time, metric_num).

    Unknown names become ``unknown``; numbers without a time belong to no window and are left out.
    """
    known = [F.coalesce(F.col(name), F.lit("unknown")).alias(name) for name in NAMES]
    window = F.window("event_time", f"{seconds} seconds")
    return (
        numbers.select("event_time", *known, "metric_num")
        .withWatermark("event_time", lateness)
        .groupBy(window, *NAMES)
        .agg(
            F.count(F.lit(1)).alias("sample_count"),
            F.avg("metric_num").alias("avg_value"),
            F.min("metric_num").alias("min_value"),
            F.max("metric_num").alias("max_value"),
        )
        .select(F.col("window.start").alias("window_start"), *NAMES, "sample_count", "avg_value", "min_value", "max_value")
    )


def gold_stream(
    records: DataFrame,
    path: str,
    checkpoint: str,
    lateness: str = "10 minutes",
    seconds: int = FIVE_MINUTES,
    drain: bool = True,
) -> StreamingQuery:
    """Kafka records -> files of closed windows by day; ``drain`` stops once everything present is read."""
    bronze = bronze_readings(records, F.lit(None).cast("string"), F.current_timestamp())
    numbers = gold_metrics(silver_readings(bronze, F.current_timestamp()))
    windows = closed_windows(numbers, lateness, seconds).withColumn("event_date", F.to_date("window_start"))
    writer = windows.writeStream.format("parquet").outputMode("append").partitionBy("event_date")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer).start()


def written_windows(spark: SparkSession, path: str) -> DataFrame:
    """The windows that a stream has written so far."""
    return spark.read.schema(WINDOWS).parquet(path)

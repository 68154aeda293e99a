"""Wide dataset and aggregations around it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemeter.functions.columns import round_half_up
from tidemeter.operators import collector, profiles, sessions, wide
from tidemeter.plans import datasets
from tidemeter.session import run_dir
from tidemeter.sources.files import read_csv
from tidemeter.workloads.inputs import EV, events, table
from tidemeter.workloads.registry import query

METRICS = ["click", "error", "purchase", "signup", "view"]
# One bin per minute of the fast clock.
BIN_NS = 60_000_000_000
# Small chunks, so that a device's series is cut many times.
BINS_PER_CHUNK = 16


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_id"),
        "device_name",
        F.col("event_type").alias("resource_name"),
        F.col("value").cast("string").alias("value"),
        "origin",
    )


PIVOT = f"""WITH {EV}, b AS (
  SELECT device_name, epoch_us(clock) * 1000 // {BIN_NS} * {BIN_NS} AS bin, event_type, value, clock,
         event_id FROM ev),
wide AS (
  SELECT device_name, bin, {', '.join(
      f"arg_min(value, (clock, event_id)) FILTER (event_type = '{m}') AS {m}" for m in METRICS)}
  FROM b GROUP BY device_name, bin)
"""
BIN_TIME = "strftime(make_timestamp(bin // 1000), '%Y-%m-%d %H:%M:%S') AS datetime"
FILLED = ", ".join(f"last_value({m} IGNORE NULLS) OVER w AS {m}" for m in METRICS)


def with_text_time(df: DataFrame) -> DataFrame:
    return df.withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))


@query(
    f"""WITH {EV} SELECT event_id, device_name, event_type AS resource_name,
    CAST(value AS VARCHAR) AS value FROM ev WHERE event_type IN ('click', 'view')"""
)
def filter_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide.filter_resources(readings(spark, sf_dir), ["click", "view"]).drop("origin")


@query(PIVOT + f"SELECT device_name, bin, {BIN_TIME}, {', '.join(METRICS)} FROM wide")
def pivot_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text_time(wide.pivot_bins(readings(spark, sf_dir), METRICS, BIN_NS))


FILL_SQL = f"""SELECT device_name, bin, {BIN_TIME}, {FILLED} FROM wide
WINDOW w AS (PARTITION BY device_name ORDER BY bin
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@query(PIVOT + FILL_SQL)
def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    pivoted = wide.pivot_bins(readings(spark, sf_dir), METRICS, BIN_NS)
    return with_text_time(wide.forward_fill(pivoted, METRICS, BIN_NS, BINS_PER_CHUNK))


@query(PIVOT + FILL_SQL)
def run_wide_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the dataset as CSV and read it back."""
    path = run_dir(spark, "wide")
    made = datasets.run_wide_dataset(readings(spark, sf_dir), path, METRICS, BIN_NS)
    return with_text_time(read_csv(spark, path, made.schema))


@query(
    f"""WITH {EV}
    SELECT 'kept' AS side, device_name, count(*) AS rows FROM ev
    WHERE device_name IN ('device-1', 'device-7') GROUP BY device_name
    UNION ALL
    SELECT 'left', device_name, count(*) FROM ev
    WHERE device_name NOT IN ('device-1', 'device-7') GROUP BY device_name
    UNION ALL
    SELECT 'by table', device_name, count(*) FROM ev
    WHERE device_name IN (SELECT 'device-' || n_nationkey FROM nation) GROUP BY device_name"""
)
def filter_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("device_name")
    names = ["device-1", "device-7"]
    nations = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("device-"), "n_nationkey").alias("device_name")
    )
    sides = {
        "kept": profiles.filter_devices(rows, names),
        "left": profiles.filter_devices(rows, names, filter_out=True),
        "by table": profiles.filter_devices_by_table(rows, nations),
    }
    counted = [
        df.groupBy("device_name")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("side", F.lit(side))
        for side, df in sides.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query(
    """SELECT l_orderkey, l_linenumber, unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax'])
         AS resource_name,
       unnest([CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR),
               CAST(l_discount AS VARCHAR), CAST(l_tax AS VARCHAR)]) AS value
    FROM lineitem"""
)
def unpivot_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collector.unpivot_metrics(
        table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    )


@query(
    """SELECT event_type, min(value) AS min_ms, round(avg(value), 6) AS mean_ms, max(value) AS max_ms,
       count(*) FILTER (value <= 100) AS succeeded, count(*) FILTER (value > 100) AS failed,
       round(count(*) / 600.0, 6) AS per_second
    FROM events GROUP BY event_type"""
)
def benchmark_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = table(spark, sf_dir, "events").select(
        "event_type", F.col("value").alias("latency_ms"), (F.col("value") <= 100).alias("ok")
    )
    stats = sessions.benchmark_stats(calls, F.lit(600.0), ["event_type"])
    return stats.withColumn("mean_ms", round_half_up("mean_ms", 6)).withColumn(
        "per_second", round_half_up("per_second", 6)
    )

"""Serving queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemeter.functions.columns import round_half_up
from tidemeter.operators import serving
from tidemeter.workloads.inputs import as_of, GOLD, reading_gold, stored_gold, text_time
from tidemeter.workloads.layers import GOLD_COLUMNS, comparable
from tidemeter.workloads.registry import query

DEVICE = "device-7"
AS_OF_SQL = "TIMESTAMP '2024-01-01 07:12:00'"
WINDOW_TEXT = "strftime(window_start, '%Y-%m-%d %H:%M:%S')"


@query(
    GOLD
    + f"""SELECT round(avg_value, 6) AS avg_value FROM gold
    WHERE resource_name = 'click' AND device_name = '{DEVICE}'
    ORDER BY window_start DESC, batch_id DESC, profile_name DESC LIMIT 1"""
)
def latest_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = serving.stored_latest_metric(stored_gold(spark, sf_dir), "click", DEVICE)
    return newest.select(round_half_up("avg_value", 6).alias("avg_value"))


PANEL_METRICS = ["click", "view", "error", "props_k"]


@query(
    GOLD
    + f"""SELECT device_name, resource_name, {WINDOW_TEXT} AS window_start,
       round(avg_value, 6) AS avg_value
    FROM (SELECT *, row_number() OVER (PARTITION BY device_name, resource_name
          ORDER BY window_start DESC, batch_id DESC, profile_name DESC) AS rn FROM gold
          WHERE resource_name IN ('click', 'view', 'error', 'props_k')) WHERE rn = 1"""
)
def latest_metric_by_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = serving.latest_metric_by_device(reading_gold(spark, sf_dir), PANEL_METRICS)
    return newest.withColumn("avg_value", round_half_up("avg_value", 6)).withColumn(
        "window_start", text_time("window_start")
    )


@query(
    GOLD
    + f"""SELECT {WINDOW_TEXT} AS time, device_name, round(avg_value, 6) AS avg_value, min_value,
       max_value FROM gold
    WHERE resource_name = 'click' AND window_start >= {AS_OF_SQL} - INTERVAL 60 minute"""
)
def trend_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = serving.trend_metric(reading_gold(spark, sf_dir), "click", as_of())
    return trend.withColumn("avg_value", round_half_up("avg_value", 6)).withColumn(
        "time", text_time("time")
    )


@query(
    GOLD
    + f""", recent AS (SELECT * FROM gold WHERE window_start >= {AS_OF_SQL} - INTERVAL 240 minute),
    c AS (SELECT * FROM recent WHERE resource_name = 'click'), v AS (SELECT * FROM recent WHERE resource_name = 'view')
    SELECT {WINDOW_TEXT} AS time, device_name, profile_name, batch_id, round(c.avg_value, 6) AS click, round(v.avg_value, 6) AS view
    FROM c FULL JOIN v USING (window_start, device_name, profile_name, batch_id)"""
)
def trend_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = serving.trend_pair(reading_gold(spark, sf_dir), ["click", "view"], as_of(), 240)
    return pair.select(
        text_time("time"),
        "device_name",
        "profile_name",
        "batch_id",
        round_half_up("click", 6).alias("click"),
        round_half_up("view", 6).alias("view"),
    )


@query(
    GOLD
    + f"""SELECT {WINDOW_TEXT} AS time_window, resource_name AS metric_type,
       round(avg_value, 2) AS average_value, round(min_value, 2) AS minimum_value,
       round(max_value, 2) AS maximum_value, sample_count
    FROM gold WHERE device_name = '{DEVICE}' AND window_start >= {AS_OF_SQL} - INTERVAL 120 minute
    ORDER BY window_start DESC, resource_name, device_name, profile_name, batch_id LIMIT 100"""
)
def gold_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.gold_ledger(reading_gold(spark, sf_dir), as_of(), 120, DEVICE)


NEWEST = "ORDER BY window_start DESC, device_name, profile_name, resource_name, g.batch_id"


@query(GOLD + f"SELECT device_name, profile_name, resource_name, {GOLD_COLUMNS} FROM gold g {NEWEST} LIMIT 10")
def gold_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(serving.stored_newest_gold(stored_gold(spark, sf_dir), 10))


@query(
    GOLD
    + f"""SELECT device_name, profile_name, resource_name, {GOLD_COLUMNS} FROM gold g
    WHERE device_name = '{DEVICE}' {NEWEST} LIMIT 50"""
)
def device_latest50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(serving.stored_newest_gold(stored_gold(spark, sf_dir), 50, DEVICE))


@query(
    GOLD
    + f"""SELECT count(*) AS row_count, count(*) > 0 AS arrived FROM gold
    WHERE device_name = '{DEVICE}'"""
)
def probe_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.probe_count(reading_gold(spark, sf_dir), DEVICE)


@query(
    GOLD
    + """SELECT strftime(date_trunc('hour', window_start), '%Y-%m-%d %H:%M:%S') AS hour,
       round(avg(avg_value), 6) AS avg_value
    FROM gold WHERE resource_name = 'click' GROUP BY 1"""
)
def hourly_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = serving.hourly_avg(reading_gold(spark, sf_dir), "click")
    return hours.select(text_time("hour"), round_half_up("avg_value", 6).alias("avg_value"))


LIMITS = {"click": (20.0, 60.0), "props_k": (50.0, 75.0)}


@query(
    GOLD
    + """SELECT resource_name, state, count(*) AS windows FROM (
      SELECT resource_name, CASE
        WHEN resource_name = 'click' THEN
          CASE WHEN avg_value >= 60 THEN 'red' WHEN avg_value >= 20 THEN 'yellow' ELSE 'green' END
        WHEN resource_name = 'props_k' THEN
          CASE WHEN avg_value >= 75 THEN 'red' WHEN avg_value >= 50 THEN 'yellow' ELSE 'green' END
        END AS state FROM gold)
    GROUP BY resource_name, state"""
)
def threshold_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = serving.threshold_state(reading_gold(spark, sf_dir), LIMITS)
    return states.groupBy("resource_name", "state").agg(F.count(F.lit(1)).alias("windows"))


@query(
    GOLD
    + """SELECT device_name, resource_name, round(avg(avg_value), 6) AS mean_value,
       round(max(avg_value), 6) AS max_value, round(min(avg_value), 6) AS min_value,
       round(arg_max(avg_value, (window_start, batch_id, profile_name)), 6) AS last_value
    FROM gold GROUP BY device_name, resource_name"""
)
def legend_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    reduced = serving.legend_reduce(reading_gold(spark, sf_dir))
    return reduced.select(
        "device_name",
        "resource_name",
        *[
            round_half_up(c, 6).alias(c)
            for c in ("mean_value", "max_value", "min_value", "last_value")
        ],
    )

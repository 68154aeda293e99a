"""Real-time path and selections on points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemeter.operators import points as point_ops
from tidemeter.operators import series
from tidemeter.schemas import POINT_MEASUREMENT
from tidemeter.workloads.inputs import (
    as_of,
    EV,
    POINTS,
    TOPIC,
    decoded_events,
    flawed_records,
    payload_records,
    points,
    text_time,
)
from tidemeter.workloads.registry import query

TS_TEXT = "strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts"
AS_OF_SQL = "TIMESTAMP '2024-01-01 07:12:00'"


@query(
    f"""WITH {EV} SELECT kafka_partition AS partition, kafka_offset AS offset FROM ev
    WHERE event_type <> 'error'"""
)
def drop_invalid_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return point_ops.valid_events(flawed_records(spark, sf_dir)).select("partition", "offset")


@query(
    f"""WITH {EV}
    SELECT CASE WHEN event_type = 'click' THEN 'unknown' ELSE '{TOPIC}' END AS _kafka_topic,
           CASE WHEN event_type = 'click' THEN -1 ELSE kafka_partition END AS _kafka_partition,
           CASE WHEN event_type = 'click' THEN -1 ELSE kafka_offset END AS _kafka_offset,
           count(*) AS events
    FROM ev GROUP BY ALL"""
)
def enrich_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of one source lose their coordinates and get the defaults."""
    records = payload_records(spark, sf_dir)
    known = F.get_json_object(F.col("value").cast("string"), "$.sourceName") != "click"
    partial = records.withColumns(
        {c: F.when(known, F.col(c)) for c in ("topic", "partition", "offset")}
    )
    rich = point_ops.enrich_provenance(point_ops.parse_records(partial), as_of())
    return rich.groupBy("_kafka_topic", "_kafka_partition", "_kafka_offset").agg(
        F.count(F.lit(1)).alias("events")
    )


@query(
    f"""WITH {EV}
    SELECT epoch_us(clock) // 1000 AS time, 'kafka' AS tag, event_type AS source,
           'source=' || event_type || ' device=' || device_name AS text FROM ev"""
)
def annotation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = decoded_events(payload_records(spark, sf_dir))
    notes = point_ops.annotation_records(events, F.col("_processed_at"))
    return notes.select(
        "time",
        F.get("tags", F.lit(0)).alias("tag"),
        F.get("tags", F.lit(1)).alias("source"),
        "text",
    )


@query(
    POINTS
    + f"""SELECT '{POINT_MEASUREMENT}' AS measurement, source_name, device_name, profile_name,
       '{TOPIC}' AS topic, kafka_partition, kafka_offset, {TS_TEXT}, field, value_num, value_str,
       value_bool FROM points"""
)
def build_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points(spark, sf_dir).withColumn("ts", text_time("ts"))


@query(
    POINTS
    + f"""SELECT source_name, device_name, profile_name, {TS_TEXT}, value_num FROM (
      SELECT *, row_number() OVER (PARTITION BY source_name, device_name, profile_name
             ORDER BY ts DESC, kafka_partition DESC, kafka_offset DESC) AS rn
      FROM points WHERE field = 'level' AND ts >= {AS_OF_SQL} - INTERVAL 300 minute) WHERE rn = 1"""
)
def last_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = as_of() - F.make_interval(mins=F.lit(300))
    chosen = series.range_series(points(spark, sf_dir), POINT_MEASUREMENT, "level", start, as_of())
    newest = series.last_per_series(chosen)
    return newest.select(
        "source_name", "device_name", "profile_name", text_time("ts"), "value_num"
    )


@query(
    POINTS
    + f"""SELECT field, source_name, device_name, {TS_TEXT}, value_num, value_str, value_bool FROM (
      SELECT *, row_number() OVER (PARTITION BY field, source_name, device_name
             ORDER BY ts, kafka_partition, kafka_offset) AS rn FROM points) WHERE rn = 1"""
)
def first_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["field", "source_name", "device_name"]
    return series.first_per_group(points(spark, sf_dir), keys).withColumn("ts", text_time("ts"))


@query(
    POINTS
    + f"""SELECT source_name, device_name, kafka_partition, kafka_offset, {TS_TEXT}, value_num
    FROM points WHERE field = 'level' AND ts >= {AS_OF_SQL} - INTERVAL 60 minute
      AND ts < {AS_OF_SQL}"""
)
def range_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = as_of() - F.make_interval(mins=F.lit(60))
    rows = series.range_series(points(spark, sf_dir), POINT_MEASUREMENT, "level", start, as_of())
    return rows.select(
        "source_name",
        "device_name",
        "kafka_partition",
        "kafka_offset",
        text_time("ts"),
        "value_num",
    )


@query(
    POINTS
    + """SELECT source_name, profile_name, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ts,
       50.0::DOUBLE AS value_num
    FROM points WHERE field = 'k' AND device_name = 'device-7' AND value_num = 50
    GROUP BY source_name, profile_name"""
)
def probe_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = as_of() - F.make_interval(mins=F.lit(432))
    found = series.probe_lookup(
        points(spark, sf_dir), POINT_MEASUREMENT, "device-7", "k", 50.0, start, as_of()
    )
    return found.select("source_name", "profile_name", text_time("ts"), "value_num")


@query(
    POINTS
    + f"""SELECT field, count(*) AS points FROM points
    WHERE ts >= TIMESTAMP '2024-01-31 03:00:00' - INTERVAL 30 day GROUP BY field"""
)
def retained_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = F.lit("2024-01-31 03:00:00").cast("timestamp")
    kept = series.retained(points(spark, sf_dir), late)
    return kept.groupBy("field").agg(F.count(F.lit(1)).alias("points"))

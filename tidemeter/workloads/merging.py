"""Windows over streams, mergeable gold, merged points and recorded lines."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemeter.functions.columns import round_half_up
from tidemeter.functions.keyvalue import decode_kv_lines as decode_lines
from tidemeter.operators import bronze, gold, partials, silver
from tidemeter.operators.points import points_from_records
from tidemeter.schemas import READING_PARTIAL
from tidemeter.session import run_dir
from tidemeter.sinks.kafka import write_records
from tidemeter.sinks.points import PointStore
from tidemeter.sources.kafka import records_stream
from tidemeter.streaming.windows import gold_stream as start_gold_stream, written_windows
from tidemeter.workloads.ingest import drain, new_store, readings_path
from tidemeter.workloads.inputs import (
    AT_TEXT,
    EV,
    GOLD,
    POINTS,
    TOPIC,
    as_records,
    batch_of_offset,
    envelope,
    events,
    loaded_at,
    payload_records,
    reading,
    reading_gold,
    reading_records,
    spread,
    reading_silver,
    table,
    text_time,
)
from tidemeter.workloads.registry import query

ARRIVALS = 5
SLOT_SECONDS = 7200
LATENESS = "10 minutes"


@query(
    f"""WITH {EV}, a AS (
      SELECT *, date_trunc('second', clock) AS second,
             epoch_us(clock - TIMESTAMP '2024-01-01 00:00:00') // {SLOT_SECONDS * 1_000_000} + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS slot
      FROM ev),
    s AS (SELECT slot, max(second) AS latest FROM a GROUP BY slot),
    m AS (SELECT slot, max(latest) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL {LATENESS} AS mark FROM s),
    r AS (SELECT a.*, time_bucket(INTERVAL 5 minute, second) AS w FROM a JOIN m USING (slot)
          WHERE mark IS NULL OR time_bucket(INTERVAL 5 minute, second) + INTERVAL 5 minute > mark),
    n AS (SELECT w, device_name, profile_name, event_type AS resource_name, value AS v FROM r
          UNION ALL SELECT w, device_name, profile_name, 'props_k', CAST(k AS DOUBLE) FROM r)
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, device_name, profile_name, resource_name, count(*) AS sample_count,
           round(avg(v), 6) AS avg_value, min(v) AS min_value, max(v) AS max_value
    FROM n WHERE w + INTERVAL 5 minute <= (SELECT max(second) FROM a) - INTERVAL {LATENESS}
    GROUP BY ALL"""
)
def gold_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two hours of events arrive at a time, a fiftieth of them one arrival late; the stream is started anew for each.

    Readings of windows that are closed by then are late and missing; windows still open at the end are not written.
    """
    root = run_dir(spark, "windows")
    since = F.unix_seconds("timestamp") - F.unix_seconds(F.lit("2024-01-01").cast("timestamp"))
    number = F.col("partition") + 4 * F.col("offset")
    slot = F.call_function("div", since, F.lit(SLOT_SECONDS)) + F.when(number % 50 == 0, 1).otherwise(0)
    records = reading_records(spark, sf_dir).withColumn("slot", slot)
    for arrival in range(ARRIVALS):
        write_records(records.where(F.col("slot") == arrival).drop("slot"), f"{root}/records")
        stream = records_stream(spark, f"{root}/records")
        start_gold_stream(stream, f"{root}/out", f"{root}/checkpoint", LATENESS).awaitTermination()
    closed = written_windows(spark, f"{root}/out").drop("event_date")
    return closed.withColumn("avg_value", round_half_up("avg_value", 6)).withColumn("window_start", text_time("window_start"))


MERGED = f"""WITH {EV}, num AS (
  SELECT clock, device_name, profile_name, event_type AS resource_name, value AS v FROM ev
  UNION ALL SELECT clock, device_name, profile_name, 'props_k', CAST(k AS DOUBLE) FROM ev)
SELECT strftime(time_bucket(INTERVAL 5 minute, clock), '%Y-%m-%d %H:%M:%S') AS window_start, device_name, profile_name, resource_name,
       count(*) AS sample_count, round(avg(v), 6) AS avg_value, min(v) AS min_value, max(v) AS max_value
FROM num GROUP BY ALL"""


def _shown(merged: DataFrame) -> DataFrame:
    return merged.withColumn("avg_value", round_half_up("avg_value", 6)).withColumn("window_start", text_time("window_start"))


@query(MERGED)
def gold_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold rows of several batches per window as one row: the same as gold made without batches."""
    return _shown(partials.gold_merged(reading_gold(spark, sf_dir)))


@query(MERGED)
def gold_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partials stored by batch in two writes, one of them twice, then merged from the table."""
    store = new_store(spark)
    store.ensure([READING_PARTIAL])
    names = ["device_name", "profile_name", "resource_name"]
    made = partials.gold_partials(gold.gold_metrics(reading_silver(spark, sf_dir)), "metric_num", names)
    even = F.regexp_extract("batch_id", "[0-9]+", 0).cast("int") % 2 == 0
    for part in (made.where(even), made.where(~even), made.where(even)):
        store.overwrite_batches(part, READING_PARTIAL, [])
    return _shown(partials.finished(partials.merge_partials(store.scan(READING_PARTIAL.name))))


@query(
    POINTS
    + """, cut AS (SELECT *, date_trunc('minute', ts) AS stamp FROM points),
    last AS (SELECT * FROM cut QUALIFY row_number() OVER (
      PARTITION BY source_name, device_name, profile_name, stamp, field ORDER BY kafka_offset DESC, kafka_partition DESC) = 1)
    SELECT source_name, device_name, profile_name, strftime(stamp, '%Y-%m-%d %H:%M:%S') AS ts, field, value_num, value_str, value_bool,
           kafka_partition, kafka_offset FROM last"""
)
def merged_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that share a minute and their tags are one point, the latest offset counts, in whatever batch it comes.

    Three batches hold a third of the offsets each; the day is compacted after the second, and the first is written again at last.
    """
    points = PointStore(new_store(spark))
    flattened = points_from_records(payload_records(spark, sf_dir), F.date_trunc("minute", "timestamp"))
    path = f"{run_dir(spark, 'flattened')}/points"
    flattened.write.parquet(path)
    made = spark.read.schema(flattened.schema).parquet(path)
    thirds = [made.where(F.col("kafka_offset") % 3 == i) for i in range(3)]
    points.write(thirds[0], "a")
    points.write(thirds[1], "b")
    points.compact(datetime.date(2024, 2, 1))
    points.write(thirds[2], "c")
    points.write(thirds[0], "a")
    wanted = ("source_name", "device_name", "profile_name", text_time("ts"), "field", "value_num", "value_str", "value_bool")
    return points.points().select(*wanted, "kafka_partition", "kafka_offset")


@query(
    """WITH l AS (
      SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS line_number,
             l_linenumber, l_partkey, l_returnflag, l_linestatus FROM lineitem)
    SELECT l_orderkey, CAST(line_number AS INTEGER) AS line_number, unnest([0, 1, 2, 3]) AS position, unnest(['line', 'qty', 'at', 'flag']) AS key,
           unnest([CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), '10:20:' || l_linenumber, l_returnflag || ', ' || l_linestatus]) AS value,
           unnest([CAST(l_linenumber AS DOUBLE), CAST(l_partkey AS DOUBLE), NULL, NULL]) AS value_num
    FROM l"""
)
def decode_kv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's items as lines with a repeated key, colons in a value and a comma in another."""
    line = F.concat_ws(
        ", ",
        F.concat(F.lit("line:"), "l_linenumber"),
        F.lit("qty:none"),
        F.concat(F.lit("at:10:20:"), "l_linenumber"),
        F.concat(F.lit("flag:"), "l_returnflag", F.lit(", "), "l_linestatus"),
        F.concat(F.lit("qty:"), "l_partkey"),
    )
    entry = F.struct("l_linenumber", "l_partkey", "l_suppkey", line.alias("line"))
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(entry)).alias("lines"))
    text = F.array_join(F.transform("lines", lambda e: e["line"]), "\n")
    return decode_lines(orders.select("l_orderkey", text.alias("text")), F.col("text")).drop("text")


@query(
    f"""WITH {EV}
    SELECT CAST(event_id AS VARCHAR) AS event_id, device_name, event_type AS source_name, {AT_TEXT} AS event_time, batch_id,
           unnest([0, 0, 0, 1, 1]) AS line_number, unnest(['host', 'level', 'k', 'host', 'level']) AS metric_key,
           unnest([device_name, CAST(value AS VARCHAR), CAST(k AS VARCHAR), device_name, '-']) AS metric_value,
           unnest([NULL, value, CAST(k AS DOUBLE), NULL, NULL]) AS metric_value_num
    FROM ev"""
)
def silver_kv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose payload is two recorded lines, through bronze to silver."""
    first = F.concat(F.lit("host:"), "device_name", F.lit(", level:"), F.col("value").cast("string"), F.lit(", k:"), F.col("k").cast("string"))
    text = F.concat(first, F.lit("\nhost:"), "device_name", F.lit(", level:-"))
    outer = F.to_json(F.create_map(F.col("event_type"), text))
    records = as_records(spread(events(spark, sf_dir), "event_id"), envelope(F.array(reading(F.col("event_type"), "String", outer))))
    rows = silver.silver_kv_lines(bronze.bronze_events_first_reading(records, batch_of_offset(), loaded_at()), loaded_at())
    return rows.withColumn("event_time", text_time("event_time")).drop("processed_at", "profile_name")


@query(
    f"""WITH {EV} SELECT '{TOPIC}' AS topic, kafka_partition AS partition, count(*) AS records, true AS several_batches
    FROM ev GROUP BY kafka_partition"""
)
def source_rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches bounded by bytes: no more than one file each, as the bound is one byte."""
    arrived = drain(spark, readings_path(spark, sf_dir), None, max_bytes=1)
    batches = arrived.select("epoch").distinct().count()
    counted = arrived.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("records"))
    return counted.withColumn("several_batches", F.lit(batches > 1))

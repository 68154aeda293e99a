"""The given tables seen as telemetry.

An ``events`` row becomes one device event: the user's last digit is the device, the value is a scalar
reading, the properties are a JSON reading. The clock runs a hundred times faster than in the table
(30 days become 7.2 hours), so that windows hold several samples. ``EV`` says the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemeter.operators.bronze import bronze_events_first_reading, bronze_readings
from tidemeter.operators.gold import gold_events, gold_readings
from tidemeter.operators.points import (
    enrich_provenance,
    points_from_records,
    valid_events,
)
from tidemeter.operators.silver import silver_metric_map, silver_readings
from tidemeter.schemas import READING_GOLD
from tidemeter.session import run_dir
from tidemeter.sinks.kafka import kafka_records, write_records
from tidemeter.sinks.tables import TableStore

CLOCK_START = 1_704_067_200_000_000  # 2024-01-01 in microseconds
CLOCK_SPEED = 100
TOPIC = "machine_metrics"

# Rows of a table that one task turns into messages.
ROWS_PER_TASK = 50_000


def loaded_at() -> Column:
    """Load time of everything made here."""
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def as_of() -> Column:
    """The "now" of the serving queries: just after the last event."""
    return F.lit("2024-01-01 07:12:00").cast("timestamp")


EV = f"""ev AS (
  SELECT event_id, user_id, event_type, value, props,
         'device-' || (user_id % 10) AS device_name,
         'profile-' || (user_id % 3) AS profile_name,
         CAST(event_id % 4 AS INTEGER) AS kafka_partition,
         event_id // 4 AS kafka_offset,
         'batch-' || (event_id // 4000) AS batch_id,
         make_timestamp({CLOCK_START} + (epoch_us(ts) - {CLOCK_START}) // {CLOCK_SPEED}) AS clock,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
  FROM events)"""

AT_TEXT = "strftime(date_trunc('second', clock), '%Y-%m-%d %H:%M:%S')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns every adapter below starts from."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    since = F.call_function("div", micros - F.lit(CLOCK_START), F.lit(CLOCK_SPEED))
    clock = F.lit(CLOCK_START) + since
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "props",
        F.concat(F.lit("device-"), F.col("user_id") % 10).alias("device_name"),
        F.concat(F.lit("profile-"), F.col("user_id") % 3).alias("profile_name"),
        (F.col("event_id") % 4).cast("int").alias("kafka_partition"),
        F.call_function("div", F.col("event_id"), F.lit(4)).alias("kafka_offset"),
        F.timestamp_micros(clock).alias("at"),
        (clock * 1000).alias("origin"),
        F.regexp_extract("props", "[0-9]+", 0).cast("bigint").alias("k"),
    )


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Deal narrow rows to tasks before messages are made of them, which are many times as large.

    A table may be one row group and so one task. The number of tasks grows with the rows; rows for one task stay.
    """
    tasks = -(-rows.count() // ROWS_PER_TASK)
    return rows.repartition(tasks, *keys) if tasks > 1 else rows


def batch_of_offset() -> Column:
    """Batches of a thousand offsets, as an incremental read would cut them."""
    number = F.call_function("div", F.col("kafka_offset"), F.lit(1000))
    return F.concat(F.lit("batch-"), number)


def reading(resource: Column, value_type: str, value: Column) -> Column:
    return F.struct(
        F.col("origin"),
        F.col("device_name").alias("deviceName"),
        resource.alias("resourceName"),
        F.col("profile_name").alias("profileName"),
        F.lit(value_type).alias("valueType"),
        value.alias("value"),
    )


def envelope(readings: Column, event_id: Column | None = None, origin: Column | None = None) -> Column:
    return F.to_json(
        F.struct(
            F.lit("v3").alias("apiVersion"),
            (F.col("event_id").cast("string") if event_id is None else event_id).alias("id"),
            F.col("device_name").alias("deviceName"),
            F.col("profile_name").alias("profileName"),
            F.col("event_type").alias("sourceName"),
            (F.col("origin") if origin is None else origin).alias("origin"),
            readings.alias("readings"),
        )
    )


def as_records(df: DataFrame, value: Column, topic: str = TOPIC) -> DataFrame:
    return kafka_records(
        df,
        value,
        topic,
        F.col("kafka_partition"),
        F.col("kafka_offset"),
        F.col("at"),
        F.col("device_name"),
    )


def two_readings() -> Column:
    return F.array(
        reading(F.col("event_type"), "Float64", F.col("value").cast("string")),
        reading(F.lit("props"), "String", F.col("props")),
    )


def reading_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a scalar reading and a JSON reading."""
    return as_records(spread(events(spark, sf_dir), "event_id"), envelope(two_readings()))


def payload_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with one doubly encoded reading: {source: "{value, k, host, state}"}."""
    inner = F.to_json(
        F.struct(
            F.col("value").alias("level"),
            F.col("k"),
            F.col("device_name").alias("host"),
            F.lit("-").alias("state"),
            (F.col("k") > 50).alias("high"),
        )
    )
    outer = F.to_json(F.create_map(F.col("event_type"), inner))
    readings = F.array(reading(F.col("event_type"), "String", outer))
    return as_records(spread(events(spark, sf_dir), "event_id"), envelope(readings))


def flawed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading records with flaws by event type.

    view: no id; purchase: no origin; signup: no readings; error: cut JSON; click: complete.
    """
    kind = F.col("event_type")
    text = envelope(
        F.filter(two_readings(), lambda _: kind != "signup"),
        F.when(kind != "view", F.col("event_id").cast("string")),
        F.when(kind != "purchase", F.col("origin")),
    )
    cut = F.when(kind == "error", F.substring(text, 1, 40)).otherwise(text)
    return as_records(spread(events(spark, sf_dir), "event_id"), cut)


def reading_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_readings(reading_records(spark, sf_dir), batch_of_offset(), loaded_at())


def reading_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_readings(reading_bronze(spark, sf_dir), loaded_at())


def reading_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_readings(reading_silver(spark, sf_dir), loaded_at())


def event_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_events_first_reading(payload_records(spark, sf_dir), batch_of_offset(), loaded_at())


def event_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_metric_map(event_bronze(spark, sf_dir), loaded_at())


def event_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_events(event_silver(spark, sf_dir), loaded_at())


def decoded_events(records: DataFrame) -> DataFrame:
    """Valid events; the record's own time stands for the processing time."""
    return enrich_provenance(valid_events(records), F.col("timestamp"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points_from_records(payload_records(spark, sf_dir), F.col("timestamp"))


# Gold of the per-reading flow, as SQL.
GOLD = f"""WITH {EV}, num AS (
  SELECT clock, device_name, profile_name, event_type AS resource_name, value AS v, batch_id FROM ev
  UNION ALL
  SELECT clock, device_name, profile_name, 'props_k', CAST(k AS DOUBLE), batch_id FROM ev),
gold AS (
  SELECT time_bucket(INTERVAL 5 minute, clock) AS window_start, device_name, profile_name,
         resource_name, count(*) AS sample_count, avg(v) AS avg_value, min(v) AS min_value,
         max(v) AS max_value, batch_id, TIMESTAMP '2024-02-01 00:00:00' AS generated_at
  FROM num GROUP BY ALL)
"""

# Points of the doubly encoded payload, as SQL.
POINTS = f"""WITH {EV}, points AS (
  SELECT clock AS ts, event_type AS source_name, device_name, profile_name, kafka_partition,
         kafka_offset, unnest(['level', 'k', 'host_str', 'state_str', 'high', 'meta_id']) AS field,
         unnest([value, CAST(k AS DOUBLE), NULL, NULL, NULL, NULL]) AS value_num,
         unnest([NULL, NULL, device_name, '-', NULL, CAST(event_id AS VARCHAR)]) AS value_str,
         unnest([NULL, NULL, NULL, NULL, k > 50, NULL]) AS value_bool
  FROM ev)
"""

_staged: dict[tuple[str, str, str], str] = {}


def staged_records(
    spark: SparkSession, sf_dir: str, kind: str, records: DataFrame, files: int = 4
) -> str:
    """Write a record set to the shared folder once per session and return its path."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _staged:
        _staged[key] = write_records(records, f"{run_dir(spark, kind)}/records", files)
    return _staged[key]


_stores: dict[tuple[str, str], TableStore] = {}


def stored_gold(spark: SparkSession, sf_dir: str) -> TableStore:
    """A store with the gold of the per-reading flow, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        root = run_dir(spark, "gold")
        store = TableStore(spark, root, "g" + root[-12:])
        store.ensure([READING_GOLD])
        store.append(reading_gold(spark, sf_dir), READING_GOLD)
        _stores[key] = store
    return _stores[key]


def text_time(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)

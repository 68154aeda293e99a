"""Bronze, silver, gold and incremental work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemeter.functions.columns import round_half_up
from tidemeter.operators import bronze, gold, incremental, serving, silver
from tidemeter.workloads.inputs import (
    AT_TEXT,
    EV,
    GOLD,
    loaded_at,
    batch_of_offset,
    event_bronze,
    event_gold,
    event_silver,
    events,
    flawed_records,
    reading_bronze,
    reading_gold,
    reading_silver,
    table,
    text_time,
)
from tidemeter.workloads.registry import query


@query(
    f"""WITH {EV}
    SELECT kafka_partition, kafka_offset,
           CASE WHEN event_type NOT IN ('view', 'error') THEN CAST(event_id AS VARCHAR) END AS id,
           CASE WHEN event_type <> 'error' THEN device_name END AS device_name,
           CASE WHEN event_type NOT IN ('purchase', 'error') THEN epoch_us(clock) * 1000 END AS origin,
           CASE event_type WHEN 'signup' THEN 0 WHEN 'error' THEN NULL ELSE 2 END AS n_readings
    FROM ev"""
)
def decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bronze.decode_envelope(flawed_records(spark, sf_dir))
    return decoded.select(
        "kafka_partition",
        "kafka_offset",
        F.col("event.id").alias("id"),
        F.col("event.deviceName").alias("device_name"),
        F.col("event.origin").alias("origin"),
        F.size("event.readings").alias("n_readings"),
    )


@query(
    f"""WITH {EV}, r AS (
      SELECT *, event_type AS resource_name, 'Float64' AS value_type,
             CAST(value AS VARCHAR) AS raw_value FROM ev
      UNION ALL
      SELECT *, 'props', 'String', props FROM ev)
    SELECT CASE WHEN event_type = 'view'
                THEN kafka_partition || '-' || kafka_offset || '-' || resource_name
                ELSE CAST(event_id AS VARCHAR) END AS event_id,
           'v3' AS api_version, device_name, profile_name, event_type AS source_name,
           {AT_TEXT} AS event_origin, resource_name, value_type, raw_value,
           {AT_TEXT} AS reading_origin, kafka_partition, kafka_offset, batch_id
    FROM r WHERE event_type IN ('click', 'view')"""
)
def bronze_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bronze.bronze_readings(flawed_records(spark, sf_dir), batch_of_offset(), loaded_at())
    return rows.withColumns(
        {c: text_time(c) for c in ("event_origin", "reading_origin")}
    ).drop("ingested_at")


@query(
    f"""WITH {EV}
    SELECT CASE WHEN event_type IN ('view', 'error') THEN kafka_partition || '-' || kafka_offset
                ELSE CAST(event_id AS VARCHAR) END AS event_id,
           CASE WHEN event_type <> 'error' THEN device_name END AS device_name,
           CASE WHEN event_type NOT IN ('purchase', 'error') THEN {AT_TEXT} END AS event_origin,
           CASE WHEN event_type NOT IN ('signup', 'error') THEN {AT_TEXT} END AS reading_origin,
           CASE WHEN event_type NOT IN ('signup', 'error')
                THEN CAST(value AS VARCHAR) END AS raw_value,
           kafka_partition, kafka_offset, batch_id
    FROM ev"""
)
def bronze_events_first_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bronze.bronze_events_first_reading(
        flawed_records(spark, sf_dir), batch_of_offset(), loaded_at()
    )
    return rows.select(
        "event_id",
        "device_name",
        text_time("event_origin"),
        text_time("reading_origin"),
        "raw_value",
        "kafka_partition",
        "kafka_offset",
        "batch_id",
    )


@query(
    f"""WITH {EV}
    SELECT kafka_partition, kafka_offset,
           CASE WHEN event_type IN ('view', 'error')
                THEN kafka_partition || '-' || kafka_offset || '-' || event_type
                ELSE CAST(event_id AS VARCHAR) END AS with_resource,
           CASE WHEN event_type IN ('view', 'error') THEN kafka_partition || '-' || kafka_offset
                ELSE CAST(event_id AS VARCHAR) END AS without_resource
    FROM ev"""
)
def synthesize_event_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.when(~F.col("event_type").isin("view", "error"), F.col("event_id").cast("string"))
    place = [F.col("kafka_partition"), F.col("kafka_offset")]
    return events(spark, sf_dir).select(
        "kafka_partition",
        "kafka_offset",
        bronze.event_id_or(own, *place, F.col("event_type")).alias("with_resource"),
        bronze.event_id_or(own, *place).alias("without_resource"),
    )


@query(
    f"""WITH {EV}, r AS (
      SELECT *, event_type AS resource_name, 'Float64' AS value_type,
             CAST(value AS VARCHAR) AS metric_value, value AS metric_value_num FROM ev
      UNION ALL
      SELECT *, 'props', 'String', props, NULL FROM ev)
    SELECT CAST(event_id AS VARCHAR) AS event_id, device_name, profile_name, resource_name,
           {AT_TEXT} AS event_time, metric_value, metric_value_num, value_type, batch_id
    FROM r"""
)
def silver_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading_silver(spark, sf_dir).withColumn("event_time", text_time("event_time")).drop(
        "processed_at"
    )


KINDS = [
    "cpu_data",
    "mem_data",
    "sys_data",
    "proc_data",
    "disk_data",
    "net_data",
    "gpu_data",
    "gpu_process_metrics",
    "other",
    "scalar",
    "Int8",
]


@query(
    f"""WITH k AS (SELECT *, (l_orderkey + l_linenumber) % {len(KINDS)} AS kind FROM lineitem)
    SELECT l_orderkey, l_linenumber, {KINDS}[kind + 1] AS resource_name,
           CASE kind WHEN 0 THEN l_quantity WHEN 1 THEN l_extendedprice WHEN 2 THEN l_discount
             WHEN 3 THEN l_linenumber WHEN 4 THEN l_partkey
             WHEN 5 THEN CASE WHEN l_linenumber > 3 THEN l_suppkey ELSE l_partkey END
             WHEN 6 THEN l_tax WHEN 9 THEN l_quantity END AS number
    FROM k"""
)
def silver_numeric_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every branch of the dispatch: each line item is a reading of one of the kinds."""
    items = table(spark, sf_dir, "lineitem")
    kind = F.get(
        F.array(*[F.lit(name) for name in KINDS]),
        ((F.col("l_orderkey") + F.col("l_linenumber")) % len(KINDS)).cast("int"),
    )
    payload = F.to_json(
        F.struct(
            F.col("l_quantity").alias("usage_user"),
            F.col("l_extendedprice").alias("used"),
            F.col("l_discount").alias("load1"),
            F.col("l_linenumber").alias("running"),
            F.col("l_partkey").alias("read_bytes"),
            F.when(F.col("l_linenumber") > 3, F.col("l_suppkey")).alias("bytes_recv"),
            F.col("l_partkey").alias("ip_inreceives"),
            F.col("l_tax").alias("utilization_gpu"),
            F.lit("-").alias("sm_util"),
        )
    )
    scalar = F.col("l_quantity").cast("string")
    return items.select(
        "l_orderkey", "l_linenumber", kind.alias("resource_name"), payload.alias("p"), scalar.alias("s")
    ).select(
        "l_orderkey",
        "l_linenumber",
        "resource_name",
        silver.silver_number(
            F.when(F.col("resource_name") == "scalar", "Float32").otherwise("String"),
            F.col("resource_name"),
            F.when(F.col("resource_name").isin("scalar", "Int8"), F.col("s")).otherwise(F.col("p")),
        ).alias("number"),
    )


EVENT_SILVER = f"""WITH {EV}, silver AS (
  SELECT event_id, device_name, profile_name, event_type AS source_name, clock, batch_id,
         unnest(['level', 'k', 'host', 'state', 'high']) AS metric_key,
         unnest([CAST(value AS VARCHAR), CAST(k AS VARCHAR), device_name, '-',
                 CASE WHEN k > 50 THEN 'true' ELSE 'false' END]) AS metric_value,
         unnest([value, CAST(k AS DOUBLE), NULL, NULL, NULL]) AS metric_value_num
  FROM ev)
"""


@query(
    EVENT_SILVER
    + f"""SELECT CAST(event_id AS VARCHAR) AS event_id, device_name, profile_name, source_name,
       {AT_TEXT} AS event_time, metric_key, metric_value, metric_value_num, batch_id FROM silver"""
)
def silver_metric_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_silver(spark, sf_dir)
    return rows.withColumn("event_time", text_time("event_time")).drop("processed_at")


@query(
    f"""WITH {EV}
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS resource_name, 'value' AS metric_key,
           value AS metric_num FROM ev
    UNION ALL
    SELECT CAST(event_id AS VARCHAR), 'props_k', 'k', CAST(k AS DOUBLE) FROM ev"""
)
def gold_metric_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold.gold_metrics(reading_silver(spark, sf_dir))
    return rows.select("event_id", "resource_name", "metric_key", "metric_num")


GOLD_COLUMNS = """sample_count, round(avg_value, 6) AS avg_value, min_value, max_value, batch_id,
  strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start"""


def comparable(df: DataFrame) -> DataFrame:
    """Gold rows with the mean rounded and times as text."""
    return df.withColumn("avg_value", round_half_up("avg_value", 6)).withColumn(
        "window_start", text_time("window_start")
    ).drop("generated_at")


@query(GOLD + f"SELECT device_name, profile_name, resource_name, {GOLD_COLUMNS} FROM gold")
def gold_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(reading_gold(spark, sf_dir))


@query(
    GOLD.replace("batch_id FROM ev),", "batch_id FROM ev WHERE k <= 50),")
    + f"SELECT device_name, profile_name, resource_name, {GOLD_COLUMNS} FROM gold"
)
def gold_5min_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict mode: a payload with a text among its members counts for nothing, here those of more than 50."""
    rows = reading_silver(spark, sf_dir)
    number = F.get_json_object("metric_value", "$.k").cast("bigint")
    mixed = F.concat(F.lit('{"host":"-",'), F.expr("substring(metric_value, 2)"))
    flawed = F.when((F.col("resource_name") == "props") & (number > 50), mixed).otherwise(F.col("metric_value"))
    silver_rows = rows.withColumn("metric_value", flawed)
    return comparable(gold.gold_readings(silver_rows, loaded_at(), "strict"))


@query(
    EVENT_SILVER
    + f""", gold AS (
      SELECT time_bucket(INTERVAL 30 minute, clock) AS window_start, device_name, profile_name,
             source_name, metric_key, count(*) AS sample_count, avg(metric_value_num) AS avg_value,
             min(metric_value_num) AS min_value, max(metric_value_num) AS max_value, batch_id
      FROM silver WHERE metric_value_num IS NOT NULL GROUP BY ALL)
    SELECT device_name, profile_name, source_name, metric_key, {GOLD_COLUMNS} FROM gold"""
)
def gold_30min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(event_gold(spark, sf_dir))


@query(f"WITH {EV} SELECT DISTINCT batch_id FROM ev")
def distinct_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.distinct_batches(reading_bronze(spark, sf_dir))


def _half_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A downstream layer that has every second batch."""
    number = F.regexp_extract("batch_id", "[0-9]+", 0).cast("int")
    return reading_silver(spark, sf_dir).filter(number % 2 == 0)


@query(
    f"""WITH {EV}
    SELECT batch_id, 2 * count(*) AS pending_rows FROM ev
    WHERE CAST(replace(batch_id, 'batch-', '') AS INTEGER) % 2 = 1 GROUP BY batch_id"""
)
def pending_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = incremental.pending_batches(
        reading_bronze(spark, sf_dir), _half_done(spark, sf_dir)
    )
    return pending.groupBy("batch_id").agg(F.count(F.lit(1)).alias("pending_rows"))


@query("""SELECT (SELECT count(*) FROM events) > 4000 AS half_done, false AS all_done""")
def has_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    upstream = reading_bronze(spark, sf_dir)
    answer = (
        incremental.has_pending(upstream, _half_done(spark, sf_dir)),
        incremental.has_pending(upstream, upstream),
    )
    return spark.createDataFrame([answer], "half_done boolean, all_done boolean")


@query(
    f"""WITH {EV}, r AS (
      SELECT batch_id, value FROM ev UNION ALL SELECT batch_id, NULL FROM ev)
    SELECT batch_id, count(*) AS rows, count(*) FILTER (isnan(value)) AS nan_values
    FROM r GROUP BY batch_id"""
)
def nan_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.not_a_number_count(reading_silver(spark, sf_dir))


@query(
    GOLD
    + """SELECT device_name, resource_name, count(*) AS total_windows,
       round(avg(avg_value), 6) AS overall_avg,
       strftime(max(generated_at), '%Y-%m-%d %H:%M:%S') AS last_updated
    FROM gold GROUP BY device_name, resource_name
    ORDER BY resource_name, device_name LIMIT 50"""
)
def validate_gold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = serving.validate_gold_summary(reading_gold(spark, sf_dir))
    return summary.withColumn("overall_avg", round_half_up("overall_avg", 6)).withColumn(
        "last_updated", text_time("last_updated")
    )


@query(
    EVENT_SILVER
    + """SELECT count(*) AS row_count FROM (
      SELECT DISTINCT time_bucket(INTERVAL 30 minute, clock), device_name, profile_name, source_name,
             metric_key, batch_id FROM silver WHERE metric_value_num IS NOT NULL)"""
)
def validate_gold_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.row_count(event_gold(spark, sf_dir))


@query(
    GOLD
    + """SELECT 'bronze' AS layer, 2 * count(*) AS row_count FROM ev
    UNION ALL SELECT 'silver', 2 * count(*) FROM ev
    UNION ALL SELECT 'gold', count(*) FROM gold"""
)
def count_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = {
        "bronze": reading_bronze(spark, sf_dir),
        "silver": reading_silver(spark, sf_dir),
        "gold": reading_gold(spark, sf_dir),
    }
    return serving.count_layers(layers)


@query(GOLD + "SELECT round(avg(avg_value), 6) AS avg_of_avgs FROM gold")
def avg_of_avgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = serving.avg_of_avgs(reading_gold(spark, sf_dir))
    return result.select(round_half_up("avg_of_avgs", 6).alias("avg_of_avgs"))


@query(
    f"""WITH {EV}
    SELECT 'bronze' AS layer, profile_name, 2 * count(*) AS row_count FROM ev GROUP BY profile_name
    UNION ALL SELECT 'silver', profile_name, 2 * count(*) FROM ev GROUP BY profile_name"""
)
def rows_per_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {
        "bronze": reading_bronze(spark, sf_dir),
        "silver": reading_silver(spark, sf_dir),
    }
    counted = [
        serving.rows_per_profile(df).withColumn("layer", F.lit(name)) for name, df in parts.items()
    ]
    return counted[0].unionByName(counted[1])


@query()
def profile_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any five rows of a profile; which ones is not determined."""
    sample = serving.profile_sample(reading_bronze(spark, sf_dir), "profile-1")
    return sample.drop("ingested_at")


@query(
    f"""WITH {EV}
    SELECT device_name, kafka_partition, count(*) AS records, min(kafka_offset) AS first_offset,
           max(kafka_offset) AS last_offset FROM ev GROUP BY device_name, kafka_partition"""
)
def payload_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of the per-event flow, per device and topic partition."""
    rows = event_bronze(spark, sf_dir)
    return rows.groupBy("device_name", "kafka_partition").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("kafka_offset").alias("first_offset"),
        F.max("kafka_offset").alias("last_offset"),
    )

"""Sources, sinks, tables and streams.

Streams read Kafka-shaped files made of the whole ``events`` table. Everything is written under the
shared folder, each run in a folder of its own.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemeter.functions.columns import round_half_up
from tidemeter.operators import points as point_ops
from tidemeter.operators.serving import stored_newest_gold
from tidemeter.plans import datasets, medallion
from tidemeter.schemas import (
    EVENT_BRONZE,
    POINTS,
    READING_BRONZE,
    READING_GOLD,
    READING_LAYERS,
    READING_SILVER,
    TableSpec,
)
from tidemeter.session import run_dir
from tidemeter.sinks import exports
from tidemeter.sinks.kafka import kafka_records, kafka_values, write_records
from tidemeter.sinks.tables import TableStore
from tidemeter.sources import files
from tidemeter.sources.generate import SOURCE_KINDS, generate_events as generate
from tidemeter.sources.kafka import records_bounded, records_stream
from tidemeter.streaming import jobs
from tidemeter.workloads.inputs import (
    AT_TEXT,
    EV,
    GOLD,
    loaded_at,
    TOPIC,
    batch_of_offset,
    envelope,
    events,
    flawed_records,
    payload_records,
    points,
    reading_bronze,
    reading_gold,
    reading_records,
    reading_silver,
    staged_records,
    stored_gold,
    table,
    text_time,
    two_readings,
)
from tidemeter.workloads.layers import GOLD_COLUMNS, comparable
from tidemeter.workloads.registry import query

# Rows of a file to land; a file is compared as one binary value.
LANDED_ROWS = 1_000_000


def new_store(spark: SparkSession) -> TableStore:
    root = run_dir(spark, "tables")
    return TableStore(spark, root, "t" + root[-12:])


def readings_path(spark: SparkSession, sf_dir: str) -> str:
    return staged_records(spark, sf_dir, "readings", reading_records(spark, sf_dir))


def payloads_path(spark: SparkSession, sf_dir: str) -> str:
    return staged_records(spark, sf_dir, "payloads", payload_records(spark, sf_dir))


def flawed_path(spark: SparkSession, sf_dir: str) -> str:
    return staged_records(spark, sf_dir, "flawed", flawed_records(spark, sf_dir))


def drain(spark: SparkSession, path: str, max_files: int | None, max_bytes: int | None = None) -> DataFrame:
    """Read a record stream to its end in micro-batches and return what arrived."""
    root = run_dir(spark, "drain")

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("epoch").parquet(f"{root}/out")

    stream = records_stream(spark, path, max_files, max_bytes)
    jobs.start_batches(stream, keep, f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


def offsets(records: DataFrame) -> DataFrame:
    return records.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


OFFSETS = f"""WITH {EV}
  SELECT '{TOPIC}' AS topic, kafka_partition AS partition, count(*) AS records,
         min(kafka_offset) AS first_offset, max(kafka_offset) AS last_offset
  FROM ev GROUP BY kafka_partition"""


@query(OFFSETS)
def source_kafka_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded micro-batches: one file at a time."""
    return offsets(drain(spark, readings_path(spark, sf_dir), 1))


@query(OFFSETS)
def source_kafka_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No bound per micro-batch; files have no "latest", so the twin reads what is there."""
    return offsets(drain(spark, readings_path(spark, sf_dir), None))


@query(
    f"""WITH {EV}
    SELECT 'metrics_' || event_type AS topic, kafka_partition AS partition, count(*) AS records,
           min(kafka_offset) AS first_offset, max(kafka_offset) AS last_offset
    FROM ev WHERE event_type IN ('click', 'view') GROUP BY ALL"""
)
def source_kafka_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of five topics, two of which are subscribed by a comma list."""
    rows = events(spark, sf_dir)
    records = kafka_records(
        rows,
        envelope(two_readings()),
        TOPIC,
        F.col("kafka_partition"),
        F.col("kafka_offset"),
        F.col("at"),
    )
    source = F.get_json_object(F.col("value").cast("string"), "$.sourceName")
    named = records.withColumn("topic", F.concat(F.lit("metrics_"), source))
    path = staged_records(spark, sf_dir, "topics", named)
    return offsets(records_bounded(spark, path, " metrics_click, ,metrics_view ,"))


@query(
    f"""{OFFSETS.replace('count(*) AS records', "count(*) AS records, 0 AS missing_topic_records")}"""
)
def source_kafka_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = readings_path(spark, sf_dir)
    missing = records_bounded(spark, f"{path}-no-such-topic").count()
    return offsets(records_bounded(spark, path)).withColumn("missing_topic_records", F.lit(missing))


@query(GOLD + f"SELECT device_name, profile_name, resource_name, {GOLD_COLUMNS} FROM gold")
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark)
    store.ensure([READING_GOLD])
    store.append(reading_gold(spark, sf_dir), READING_GOLD)
    return comparable(store.scan(READING_GOLD.name).drop("event_date"))


@query(
    """SELECT level, meaning, count(*) AS events FROM events JOIN (
      SELECT unnest(['click', 'view', 'error']) AS kind, unnest([1, 1, 9]) AS level,
             unnest(['use', 'use', 'fault']) AS meaning) ON event_type = kind
    GROUP BY level, meaning"""
)
def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal rows, once with a declared schema and once with inferred types, joined to the events."""
    kinds = [("click", 1), ("view", 1), ("error", 9)]
    declared = files.rows(spark, kinds, "event_type string not null, level int not null")
    inferred = files.rows(spark, [(1, "use"), (9, "fault")], ["level", "meaning"])
    meaning = inferred.select(F.col("level").cast("int").alias("level"), "meaning")
    known = F.broadcast(declared.join(meaning, "level"))
    joined = table(spark, sf_dir, "events").join(known, "event_type")
    return joined.groupBy("level", "meaning").agg(F.count(F.lit(1)).alias("events"))


@query(
    """SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS amount FROM orders"""
)
def source_csv_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "assets")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
    )
    orders.write.option("header", True).csv(f"{root}/orders.csv")
    return files.csv_asset(spark, root, "orders", orders.schema)


@query(
    """SELECT 'raw/orders_daily' AS folder, o_orderstatus AS status, count(*) AS rows,
       round(sum(o_totalprice), 2) AS total, true AS same_bytes, 0 AS unknown_provider_files
    FROM orders GROUP BY o_orderstatus"""
)
def land_raw_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land CSV files of several folders, with equal names, twice: the second run replaces the first."""
    root = run_dir(spark, "landing")
    orders = table(spark, sf_dir, "orders")
    written = orders.write.partitionBy("o_orderstatus").option("maxRecordsPerFile", LANDED_ROWS)
    written.option("header", True).csv(f"{root}/incoming")
    incoming, target = f"{root}/incoming/*/*.csv", f"{root}/raw/orders_daily"
    for _ in range(2):
        report = files.land_raw_files(spark, incoming, root, "orders_daily")
        report.write.mode("overwrite").parquet(f"{root}/report")
    unknown = files.land_raw_files(spark, incoming, root, "other", "MAIL").count()

    def contents(folder: str) -> DataFrame:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        return listed.select(F.sha2("content", 256).alias("sha256"))

    reported = spark.read.parquet(f"{root}/report").select("sha256")
    unlike = [
        one.exceptAll(other).limit(1).count()
        for here in (f"{root}/incoming", target)
        for one, other in ((contents(here), reported), (reported, contents(here)))
    ]
    same = sum(unlike) == 0
    copied = spark.read.schema(orders.schema).option("header", True).csv(target)
    return copied.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.lit("raw/orders_daily").alias("folder"),
        F.count(F.lit(1)).alias("rows"),
        round_half_up(F.sum("o_totalprice"), 2).alias("total"),
        F.lit(same).alias("same_bytes"),
        F.lit(unknown).alias("unknown_provider_files"),
    )


@query()
def generate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synthetic event of each kind in turn per row of the events table."""
    rows = events(spark, sf_dir)
    kinds = F.array(*[F.lit(kind) for kind in (*SOURCE_KINDS, "other_data")])
    made = generate(
        rows,
        "event_id",
        F.get(kinds, (F.col("event_id") % (len(SOURCE_KINDS) + 1)).cast("int")),
        F.unix_micros(loaded_at()) * 1000 + F.col("event_id"),
        F.concat(F.lit("node-"), F.col("event_id") % 50),
        F.lit("node-profile"),
    )
    return made


@query(
    f"""WITH {EV} SELECT 'first' AS run, 2 * count(*) AS rows, count(DISTINCT batch_id) AS batches
    FROM ev UNION ALL SELECT 'second', 2 * count(*), count(DISTINCT batch_id) FROM ev"""
)
def append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append, then write the same batches again: nothing is doubled."""
    store = new_store(spark)
    store.ensure([READING_SILVER])
    silver = reading_silver(spark, sf_dir)
    store.append(silver, READING_SILVER)

    def state(run: str) -> tuple:
        rows, batches = (
            store.scan(READING_SILVER.name)
            .agg(F.count(F.lit(1)), F.count_distinct("batch_id"))
            .first()
        )
        return run, rows, batches

    first = state("first")
    store.overwrite_batches(silver, READING_SILVER, [])
    schema = "run string, rows bigint, batches bigint"
    return spark.createDataFrame([first, state("second")], schema)


@query(
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"""
)
def replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark)
    store.replace(table(spark, sf_dir, "nation"), "products")
    return store.replace(table(spark, sf_dir, "customer"), "products")


LAYER_DDL = """SELECT unnest(['reading_bronze', 'reading_silver', 'reading_gold']) AS table_name,
  unnest([15, 11, 11]) AS columns, 2 AS partition_columns"""


@query(
    f"""WITH {EV}, t AS ({LAYER_DDL})
    SELECT table_name, columns, partition_columns,
           CASE WHEN table_name = 'reading_bronze' THEN (SELECT 2 * count(*) FROM ev) ELSE 0 END AS rows
    FROM t"""
)
def ensure_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creating the tables twice leaves the stored rows alone."""
    store = new_store(spark)
    store.ensure(READING_LAYERS)
    store.append(reading_bronze(spark, sf_dir), READING_BRONZE)
    store.ensure(READING_LAYERS)

    def described(spec: TableSpec) -> tuple:
        columns = spark.catalog.listColumns(f"{store.namespace}.{spec.name}")
        rows = store.scan(spec.name).count()
        return spec.name, len(columns), sum(c.isPartition for c in columns), rows

    schema = "table_name string, columns int, partition_columns int, rows bigint"
    return spark.createDataFrame([described(spec) for spec in READING_LAYERS], schema)


@query(
    f"""WITH {EV}, r AS (SELECT *, event_type AS resource_name FROM ev
                        UNION ALL SELECT *, 'props' FROM ev)
    SELECT device_name, resource_name, count(*) AS rows, count(DISTINCT kafka_offset) AS offsets
    FROM r GROUP BY device_name, resource_name"""
)
def stream_foreach_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drain, then start again from the checkpoint: the second run adds nothing."""
    store = new_store(spark)
    path = readings_path(spark, sf_dir)
    for _ in range(2):
        stream = records_stream(spark, path, 1)
        jobs.bronze_stream_readings(stream, store, f"{store.root}/checkpoint").awaitTermination()
    return (
        store.scan(READING_BRONZE.name)
        .groupBy("device_name", "resource_name")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("kafka_offset").alias("offsets"))
    )


@query(
    f"""WITH {EV}, r AS (SELECT *, event_type AS resource_name, CAST(value AS VARCHAR) AS raw_value
                        FROM ev UNION ALL SELECT *, 'props', props FROM ev)
    SELECT kafka_partition, kafka_offset, resource_name, raw_value, {AT_TEXT} AS event_origin FROM r"""
)
def bronze_stream_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark)
    stream = records_stream(spark, readings_path(spark, sf_dir), 2)
    jobs.bronze_stream_readings(stream, store, f"{store.root}/checkpoint").awaitTermination()
    return store.scan(READING_BRONZE.name).select(
        "kafka_partition", "kafka_offset", "resource_name", "raw_value", text_time("event_origin")
    )


@query(
    f"""WITH {EV}
    SELECT kafka_partition, kafka_offset,
           CASE WHEN event_type <> 'error' THEN event_type END AS source_name,
           CASE WHEN event_type NOT IN ('signup', 'error')
                THEN CAST(value AS VARCHAR) END AS raw_value
    FROM ev"""
)
def bronze_stream_edge_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark)
    stream = records_stream(spark, flawed_path(spark, sf_dir))
    jobs.bronze_stream_events(stream, store, f"{store.root}/checkpoint").awaitTermination()
    return store.scan(EVENT_BRONZE.name).select(
        "kafka_partition", "kafka_offset", "source_name", "raw_value"
    )


@query(
    f"""WITH {EV} SELECT status, count(*) AS records, sum(bytes) > 0 AS has_bytes FROM (
      SELECT CASE event_type WHEN 'error' THEN 'invalid' ELSE 'valid' END AS status, 40 AS bytes FROM ev)
    GROUP BY status"""
)
def dead_letter_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "letters")
    stream = records_stream(spark, flawed_path(spark, sf_dir), 2)
    jobs.dead_letter_stream(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return (
        spark.read.parquet(f"{root}/out")
        .groupBy("status")
        .agg(
            F.count(F.lit(1)).alias("records"),
            (F.sum(F.octet_length("value")) > 0).alias("has_bytes"),
        )
    )


@query(
    """SELECT unnest(['reading_silver', 'reading_gold', 'no_such_table']) AS table_name,
       0 AS rows_left, unnest([false, false, true]) AS failed"""
)
def truncate_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty the tables; one that does not exist does not stop the others."""
    store = new_store(spark)
    store.ensure([READING_SILVER, READING_GOLD])
    store.append(reading_silver(spark, sf_dir), READING_SILVER)
    store.append(reading_gold(spark, sf_dir), READING_GOLD)
    missing = TableSpec("no_such_table", "a INT", None, ())
    outcome = store.truncate([READING_SILVER, missing, READING_GOLD])
    rows = [
        (name, store.scan(name).count() if error is None else 0, error is not None)
        for name, error in outcome.items()
    ]
    return spark.createDataFrame(rows, "table_name string, rows_left int, failed boolean")


@query(GOLD + f"SELECT device_name, profile_name, resource_name, {GOLD_COLUMNS} FROM gold")
def export_single_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export in parts and read back. A single file is offered only for small tables."""
    gold = comparable(reading_gold(spark, sf_dir))
    path = exports.export_csv(gold, f"{run_dir(spark, 'export')}/reading_gold.csv")
    return files.read_csv(spark, path, gold.schema)


NEWEST_GOLD = "ORDER BY g.window_start DESC, device_name, profile_name, resource_name, g.batch_id"


@query(
    GOLD
    + f"""SELECT device_name, profile_name, resource_name, {GOLD_COLUMNS} FROM gold g
    {NEWEST_GOLD} LIMIT 100"""
)
def export_json_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest gold rows as JSON records, written and read back."""
    newest = exports.latest_gold(comparable(stored_newest_gold(stored_gold(spark, sf_dir), 100)))
    path = run_dir(spark, "latest")
    exports.json_records(newest).write.text(path)
    return spark.read.schema(newest.schema).json(path)


@query(
    f"""WITH {EV}, r AS (
      SELECT *, event_type AS resource_name, CAST(value AS VARCHAR) AS metric_value FROM ev
      UNION ALL SELECT *, 'props', props FROM ev),
    own AS (SELECT * FROM r WHERE device_name = 'device-7'
            ORDER BY date_trunc('second', clock) DESC, CAST(event_id AS VARCHAR), resource_name,
                     metric_value LIMIT 200),
    every AS (SELECT * FROM r ORDER BY date_trunc('second', clock) DESC, CAST(event_id AS VARCHAR),
                     resource_name, metric_value LIMIT 100)
    SELECT 'device' AS choice, CAST(event_id AS VARCHAR) AS event_id, resource_name, metric_value
    FROM own UNION ALL SELECT 'all', CAST(event_id AS VARCHAR), resource_name, metric_value FROM every"""
)
def export_json_latest_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest silver rows of a device, and of all devices where the named one has none."""
    silver = reading_silver(spark, sf_dir)
    chosen = {
        "device": exports.latest_silver(silver, "device-7"),
        "all": exports.latest_silver(silver, "no such device"),
    }
    parts = [
        df.select(F.lit(name).alias("choice"), "event_id", "resource_name", "metric_value")
        for name, df in chosen.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    GOLD
    + """SELECT 'reading_gold' AS table_name, 'ok' AS status, count(*) AS rows, 20 AS sample_rows
    FROM gold
    UNION ALL SELECT 'reading_bronze', 'empty', 0, 0
    UNION ALL SELECT 'no_such_table', 'not found', 0, 0"""
)
def preview_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark)
    store.ensure([READING_BRONZE, READING_GOLD])
    store.append(reading_gold(spark, sf_dir), READING_GOLD)
    rows = []
    for name in ("reading_gold", "reading_bronze", "no_such_table"):
        preview = exports.preview_table(store, name)
        shown = preview.sample.count() if preview.sample is not None else 0
        rows.append((name, preview.status, preview.rows, shown))
    return spark.createDataFrame(
        rows, "table_name string, status string, rows bigint, sample_rows int"
    )


@query(
    f"""WITH {EV} SELECT 'append' AS operation, 2 * count(*) AS rows, 0 AS batches FROM ev
    UNION ALL SELECT 'overwrite', 2 * count(*), 1 FROM ev WHERE batch_id = 'batch-0'"""
)
def table_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of a table from its commit log."""
    store = new_store(spark)
    store.ensure([READING_SILVER])
    silver = reading_silver(spark, sf_dir)
    store.append(silver, READING_SILVER)
    first = silver.filter(F.col("batch_id") == "batch-0")
    store.overwrite_batches(first, READING_SILVER, ["batch-0"])
    if store.describe(READING_SILVER.name).isEmpty():
        raise RuntimeError("no description")
    history = store.history(READING_SILVER.name)
    return history.select("operation", "rows", F.size("batches").alias("batches"))


@query(
    f"""WITH {EV}
    SELECT field, count(*) AS points, round(sum(value_num), 4) AS total FROM (
      SELECT unnest(['level', 'k', 'host_str', 'state_str', 'high', 'meta_id']) AS field,
             unnest([value, CAST(k AS DOUBLE), NULL, NULL, NULL, NULL]) AS value_num FROM ev)
    GROUP BY field"""
)
def sink_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write points, write them again: a point written twice is one point."""
    store = new_store(spark)
    store.ensure([POINTS])
    made = points(spark, sf_dir).withColumn("batch_id", batch_of_offset())
    for _ in range(2):
        store.overwrite_batches(made, POINTS, [])
    return (
        store.scan(POINTS.name)
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("points"), round_half_up(F.sum("value_num"), 4).alias("total"))
    )


@query(
    f"""WITH {EV} SELECT device_name, count(*) AS documents, true AS stamped,
       count(*) FILTER (WHERE kafka_offset % 3 = 0) AS not_numbers FROM ev GROUP BY device_name"""
)
def sink_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event becomes a document, also the third of them that carry a NaN."""
    root = run_dir(spark, "documents")
    text = F.col("value").cast("string")
    load = F.concat(F.lit('{"load":NaN,'), F.substring(text, 2, 2**31 - 1))
    value = F.when(F.col("offset") % 3 == 0, load).otherwise(text).cast("binary")
    stream = records_stream(spark, readings_path(spark, sf_dir)).withColumn("value", value)
    jobs.documents_stream(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    written = spark.read.schema("document string").json(f"{root}/out")
    return (
        written.select(
            F.get_json_object("document", "$.deviceName").alias("device_name"),
            F.get_json_object("document", "$._ingested_at").alias("at"),
            F.get_json_object("document", "$.load").alias("load"),
        )
        .groupBy("device_name")
        .agg(
            F.count(F.lit(1)).alias("documents"),
            (F.count("at") == F.count(F.lit(1))).alias("stamped"),
            F.count_if(F.col("load") == "NaN").alias("not_numbers"),
        )
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag,
       CAST(l_orderkey % 8 AS INTEGER) AS partition FROM lineitem"""
)
def produce_kafka(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as JSON records of a topic, read back by the bounded read."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    values = kafka_values(items, F.col("l_orderkey"))
    records = kafka_records(
        values,
        F.col("value"),
        "line_items",
        F.col("key").cast("bigint") % 8,
        F.monotonically_increasing_id(),
        loaded_at(),
        F.col("key"),
    )
    path = write_records(records, f"{run_dir(spark, 'topic')}/line_items")
    back = records_bounded(spark, path)
    parsed = F.from_json(F.col("value").cast("string"), items.schema)
    return back.select(parsed.alias("item"), "partition").select("item.*", "partition")


@query(
    f"""WITH {EV}
    SELECT event_type AS kind, count(*) AS received, count(*) AS forwarded,
           count(*) FILTER (event_type <> 'error') AS rewritten FROM ev GROUP BY event_type"""
)
def normalize_json_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = flawed_records(spark, sf_dir).withColumn(
        "value",
        F.concat(F.lit("  "), F.col("value").cast("string")).cast("binary"),
    )
    done = point_ops.normalize_json_bytes(records)
    rows = events(spark, sf_dir).select(
        F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"), "event_type"
    )
    changed = F.col("was_json") & ~F.col("value").cast("string").startswith(" ")
    kept = ~F.col("was_json") & F.col("value").cast("string").startswith("  ")
    return (
        done.join(rows, ["partition", "offset"])
        .groupBy(F.col("event_type").alias("kind"))
        .agg(
            F.count(F.lit(1)).alias("received"),
            F.count_if(changed | kept).alias("forwarded"),
            F.count_if(changed).alias("rewritten"),
        )
    )


@query(
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS points FROM events
    WHERE date_trunc('day', ts) >= TIMESTAMP '2024-01-16' GROUP BY 1"""
)
def expire_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points older than thirty days before 15 February lose their partitions."""
    store = new_store(spark)
    store.ensure([POINTS])
    rows = table(spark, sf_dir, "events").select(
        F.lit("m").alias("measurement"),
        F.lit(None).cast("string").alias("source_name"),
        F.concat(F.lit("device-"), F.col("user_id") % 10).alias("device_name"),
        F.lit(None).cast("string").alias("profile_name"),
        F.lit(TOPIC).alias("topic"),
        F.lit(0).alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit("value").alias("field"),
        F.col("value").alias("value_num"),
        F.lit(None).cast("string").alias("value_str"),
        F.lit(None).cast("boolean").alias("value_bool"),
        F.lit("batch-0").alias("batch_id"),
    )
    store.append(rows, POINTS)
    store.expire(POINTS, datetime.date(2024, 2, 15) - datetime.timedelta(days=30))
    return (
        store.scan(POINTS.name)
        .groupBy(F.col("event_date").cast("string").alias("day"))
        .agg(F.count(F.lit(1)).alias("points"))
    )


@query(
    f"""WITH {EV}
    SELECT source_name, field, count(*) AS points FROM (
      SELECT event_type AS source_name,
             unnest(['level', 'k', 'host_str', 'state_str', 'high', 'meta_id']) AS field FROM ev)
    GROUP BY source_name, field"""
)
def realtime_points_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark)
    stream = records_stream(spark, payloads_path(spark, sf_dir), 2)
    jobs.points_stream(stream, store, f"{store.root}/checkpoint", drain=True).awaitTermination()
    return (
        store.scan(POINTS.name).groupBy("source_name", "field").agg(F.count(F.lit(1)).alias("points"))
    )


@query(
    f"""WITH {EV}
    SELECT source_name, device_name, profile_name, field, value_num, kafka_partition, kafka_offset FROM (
      SELECT event_type AS source_name, device_name, profile_name, kafka_partition, kafka_offset,
             unnest(['level', 'k', 'host_str', 'state_str', 'high', 'meta_id']) AS field,
             unnest([value, CAST(k AS DOUBLE), NULL, NULL, NULL, NULL]) AS value_num FROM ev)"""
)
def run_realtime_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark)
    stream = records_stream(spark, payloads_path(spark, sf_dir))
    stored = datasets.run_realtime_points(stream, store, f"{store.root}/checkpoint")
    return stored.select(
        "source_name",
        "device_name",
        "profile_name",
        "field",
        "value_num",
        "kafka_partition",
        "kafka_offset",
    )


@query(
    GOLD
    + """SELECT device_name, resource_name, count(*) AS total_windows FROM (
      SELECT device_name, resource_name, window_start, profile_name FROM gold GROUP BY ALL)
    GROUP BY device_name, resource_name ORDER BY resource_name, device_name LIMIT 50"""
)
def run_readings_medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream to bronze, then silver and gold; one micro-batch, so one gold row per window."""
    store = new_store(spark)
    stream = records_stream(spark, readings_path(spark, sf_dir))
    summary = medallion.run_readings_medallion(stream, store, f"{store.root}/checkpoint")
    return summary.select("device_name", "resource_name", "total_windows")


@query(
    f"""WITH {EV}
    SELECT count(*) AS row_count FROM (
      SELECT DISTINCT time_bucket(INTERVAL 30 minute, clock), device_name, profile_name, event_type,
             unnest(['level', 'k']) FROM ev)"""
)
def run_edge_device_medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark)
    stream = records_stream(spark, payloads_path(spark, sf_dir))
    return medallion.run_events_medallion(stream, store, f"{store.root}/checkpoint")


@query(
    GOLD
    + """SELECT resource_name, sum(sample_count) AS samples, min(min_value) AS low,
       max(max_value) AS high FROM gold GROUP BY resource_name"""
)
def refine_incrementally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several micro-batches, refined after each run; a last run finds nothing left."""
    store = new_store(spark)
    store.ensure(READING_LAYERS)
    path = readings_path(spark, sf_dir)
    stream = records_stream(spark, path, 1)
    jobs.bronze_stream_readings(stream, store, f"{store.root}/checkpoint").awaitTermination()
    medallion.refine_readings(store, loaded_at())
    silver, gold = medallion.refine_readings(store, loaded_at())
    if silver.batches or gold.batches:
        raise RuntimeError("batches were processed twice")
    return (
        store.scan(READING_GOLD.name)
        .groupBy("resource_name")
        .agg(
            F.sum("sample_count").alias("samples"),
            F.min("min_value").alias("low"),
            F.max("max_value").alias("high"),
        )
    )

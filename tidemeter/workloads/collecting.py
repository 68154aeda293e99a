"""Collector batches, profiles and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemeter.operators import collector, profiles
from tidemeter.operators.bronze import bronze_readings as to_bronze
from tidemeter.plans import datasets
from tidemeter.sources.collector import collector_fields
from tidemeter.workloads.inputs import EV, as_records, events, loaded_at, spread, table
from tidemeter.workloads.registry import query


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One collector batch per line item; every third document is a bare list."""
    needed = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax")
    items = spread(table(spark, sf_dir, "lineitem").select(*needed), "l_orderkey", "l_linenumber")

    def metric(plugin: str, **fields) -> Column:
        return F.concat(
            F.lit(f'{{"name":"{plugin}","fields":'),
            F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])),
            F.lit("}"),
        )

    def whole(name: str, column: str) -> Column:
        """A member for an integer, which is left out if null, as ``to_json`` does, and needs no JSON writer."""
        return F.concat(F.lit(f'"{name}":'), F.col(column).cast("string"))

    def whole_metric(plugin: str, *members: Column) -> Column:
        return F.concat(F.lit(f'{{"name":"{plugin}","fields":{{'), F.concat_ws(",", *members), F.lit("}}"))

    parts = [
        metric("cpu", usage_user=F.col("l_quantity")),
        whole_metric("diskio", whole("reads", "l_partkey"), F.lit('"name":"a"')),
        whole_metric("net", whole("bytes_recv", "l_suppkey"), F.lit('"errors":0')),
        whole_metric("diskio", whole("reads", "l_suppkey")),
        whole_metric("net", whole("bytes_recv", "l_partkey"), whole("bytes_sent", "l_linenumber")),
        metric("swap", used=F.col("l_tax")),
        F.lit('{"name":"system","fields":{}}'),
    ]
    listed = F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))
    wrapped = F.concat(F.lit('{"metrics":'), listed, F.lit("}"))
    return items.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("doc_id"),
        F.when(F.col("l_linenumber") % 3 == 0, listed).otherwise(wrapped).alias("document"),
        "l_orderkey",
    )


def field(name: str, kind: str) -> Column:
    """A field as typed by the parse of its document; a reader for the JSON of each entry costs more than the document's."""
    return F.try_variant_get(F.try_element_at("fields", F.lit(name)), "$", kind)


DOCS = """WITH docs AS (SELECT l_orderkey * 10 + l_linenumber AS doc_id, * FROM lineitem
                       WHERE l_linenumber % 3 <> 0)
"""


@query(
    DOCS
    + """SELECT doc_id, unnest([0, 1, 2, 3, 4, 5]) AS pos,
       unnest(['cpu', 'diskio', 'net', 'diskio', 'net', 'swap']) AS plugin,
       unnest([l_quantity, l_partkey, l_suppkey, l_suppkey, l_partkey, l_tax]) AS first_number
    FROM docs"""
)
def source_telegraf_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = collector_fields(batches(spark, sf_dir), "doc_id", "document")
    names = ("usage_user", "reads", "bytes_recv", "used")
    number = F.coalesce(*[field(name, "double") for name in names])
    return entries.select("doc_id", "pos", "plugin", number.alias("first_number"))


@query(
    DOCS
    + """SELECT doc_id, unnest(['cpu_data', 'disk_data', 'net_data']) AS resource_name,
       unnest([l_quantity, l_suppkey, l_partkey]) AS number,
       unnest([NULL, NULL, l_linenumber]) AS sent, unnest([NULL, NULL, 0]) AS errors,
       CAST(NULL AS VARCHAR) AS name
    FROM docs"""
)
def route_telegraf_plugin(spark: SparkSession, sf_dir: str) -> DataFrame:
    routes = collector.route_batches(batches(spark, sf_dir), "document", ["doc_id"])
    names = ("usage_user", "reads", "bytes_recv")
    return routes.select(
        "doc_id",
        "resource_name",
        F.coalesce(*[field(name, "double") for name in names]).alias("number"),
        field("bytes_sent", "int").alias("sent"),
        field("errors", "int").alias("errors"),
        field("name", "string").alias("name"),
    )


@query(
    DOCS
    + """SELECT doc_id || '-' || resource_name AS event_id,
       'node-' || (l_orderkey % 100) AS device_name, resource_name
    FROM (SELECT doc_id, l_orderkey, unnest(['cpu_data', 'disk_data', 'net_data']) AS resource_name
          FROM docs)"""
)
def run_telegraf_to_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collector batches to events, then through the bronze step."""
    made = datasets.run_collector_to_events(
        batches(spark, sf_dir),
        "doc_id",
        "document",
        F.concat(F.lit("node-"), F.col("l_orderkey") % 100),
        F.lit("node-profile"),
        F.unix_micros(loaded_at()) * 1000,
    )
    placed = made.select(
        F.col("event"),
        F.lit(0).alias("kafka_partition"),
        F.col("doc_id").alias("kafka_offset"),
        loaded_at().alias("at"),
        F.lit("node").alias("device_name"),
    )
    rows = to_bronze(as_records(placed, F.col("event")), F.lit("batch-0"), loaded_at())
    return rows.select("event_id", "device_name", "resource_name")


def plugin_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metric per event with text maps; the plugin follows the event type."""
    kind = F.col("event_type")
    plugin = (
        F.when(kind == "click", "mem")
        .when(kind == "view", "processes")
        .when(kind == "error", "gpu_process_metrics")
        .otherwise("cpu")
    )
    return events(spark, sf_dir).select(
        "event_id",
        plugin.alias("plugin"),
        F.create_map(
            F.lit("pid"), F.col("user_id").cast("string"), F.lit("host"), F.col("device_name")
        ).alias("tags"),
        F.create_map(F.lit("total"), F.col("value").cast("string")).alias("fields"),
        F.date_trunc("hour", "at").alias("flushed"),
    )


@query(
    f"""WITH {EV}
    SELECT event_id, CASE event_type WHEN 'click' THEN 'mem_total' WHEN 'view' THEN 'proc_total'
                     ELSE 'total' END AS field, CAST(value AS VARCHAR) AS value FROM ev"""
)
def rename_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = collector.rename_fields(plugin_entries(spark, sf_dir))
    return renamed.select("event_id", F.explode("fields").alias("field", "value"))


@query(
    f"""WITH {EV}
    SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 2 END AS tags,
           CASE WHEN event_type = 'error' THEN CAST(user_id AS VARCHAR) END AS pid_field,
           device_name AS host_tag FROM ev"""
)
def promote_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    promoted = collector.promote_tags(plugin_entries(spark, sf_dir))
    return promoted.select(
        "event_id",
        F.size("tags").alias("tags"),
        F.try_element_at("fields", F.lit("pid")).alias("pid_field"),
        F.try_element_at("tags", F.lit("host")).alias("host_tag"),
    )


@query(
    f"""WITH {EV}
    SELECT event_type AS name, device_name AS host,
           strftime(date_trunc('hour', clock), '%Y-%m-%d %H:%M:%S') AS time, 2 AS fields,
           CAST(arg_max(value, event_id) AS VARCHAR) AS level,
           CAST(arg_max(k, event_id) AS VARCHAR) AS k
    FROM ev GROUP BY event_type, device_name, date_trunc('hour', clock)"""
)
def merge_same_key_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two metrics per event with one field each, merged per source, host and hour."""
    rows = events(spark, sf_dir).select(
        "event_type",
        F.create_map(F.lit("host"), F.col("device_name")).alias("tags"),
        F.date_trunc("hour", "at").alias("time"),
        F.explode(
            F.array(
                F.create_map(F.lit("level"), F.col("value").cast("string")),
                F.create_map(F.lit("k"), F.col("k").cast("string")),
            )
        ).alias("fields"),
        "event_id",
    )
    merged = collector.merge_same_key_metrics(
        rows, "event_type", "tags", "time", "fields", "event_id"
    )
    return merged.select(
        "name",
        F.try_element_at("tags", F.lit("host")).alias("host"),
        F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.size("fields").alias("fields"),
        F.try_element_at("fields", F.lit("level")).alias("level"),
        F.try_element_at("fields", F.lit("k")).alias("k"),
    )


def profile_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile per part: a wrapped document for odd keys, a bare one for even keys."""

    def resource(name: str, value_type: str, units: str | None) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            F.struct(
                F.lit(value_type).alias("valueType"),
                F.lit(units).cast("string").alias("units"),
                F.lit("R").alias("readWrite"),
            ).alias("properties"),
        )

    resources = F.array(
        resource("size", "Uint64", "cm"), resource("price", "Float32", "USD"), resource("kind", "String", None)
    )
    name = F.concat(F.lit("part-"), F.col("p_partkey"))
    bare = F.struct(name.alias("name"), resources.alias("deviceResources"))
    wrapped = F.array(F.struct(F.lit("v3").alias("apiVersion"), bare.alias("profile")))
    document = F.when(F.col("p_partkey") % 2 == 1, F.to_json(wrapped)).otherwise(F.to_json(bare))
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", "p_size", "p_retailprice", "p_type", document.alias("document")
    )


PROFILE_SQL = """SELECT 'part-' || p_partkey AS profile_name,
       unnest(['size', 'price', 'kind']) AS resource_name,
       unnest(['Uint64', 'Float32', 'String']) AS value_type,
       unnest(['cm', 'USD', NULL]) AS units, 'R' AS read_write FROM part"""


@query(PROFILE_SQL)
def profile_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profiles of half of the parts are registered first, then those of all parts."""
    documents = profile_documents(spark, sf_dir)
    registered = profiles.profile_dimension(documents.filter(F.col("p_partkey") % 2 == 1))
    everything = profiles.profile_dimension(documents)
    return registered.unionByName(profiles.new_profiles(everything, registered))


@query(
    """SELECT verdict, resource_name, count(*) AS readings FROM (
      SELECT unnest(['size', 'price', 'kind', 'weight']) AS resource_name,
             unnest([CASE WHEN p_size < 10 THEN 'bad value' ELSE 'ok' END,
                     CASE WHEN p_retailprice > 1500 THEN 'bad value' ELSE 'ok' END,
                     'ok', 'unknown resource']) AS verdict FROM part)
    GROUP BY verdict, resource_name"""
)
def profile_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = profile_documents(spark, sf_dir)
    dimension = profiles.profile_dimension(documents)

    def reading(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("resource_name"), value.alias("raw_value"))

    size = F.col("p_size").cast("string")
    price = F.col("p_retailprice").cast("string")
    values = F.array(
        reading("size", F.when(F.col("p_size") < 10, F.concat(F.lit("-"), size)).otherwise(size)),
        reading("price", F.when(F.col("p_retailprice") > 1500, F.lit("-")).otherwise(price)),
        reading("kind", F.col("p_type")),
        reading("weight", F.lit("1")),
    )
    readings = documents.select(
        F.concat(F.lit("part-"), F.col("p_partkey")).alias("profile_name"), F.inline(values)
    )
    checked = profiles.profile_conformance(readings, dimension)
    return checked.groupBy("verdict", "resource_name").agg(F.count(F.lit(1)).alias("readings"))

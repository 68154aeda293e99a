"""Metric batches posted by a collector agent: ``{"metrics":[{"name","tags","timestamp","fields"}]}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.functions.payload import JSON_OPTIONS

METRICS = (
    "struct<metrics:array<struct<name:string,tags:map<string,string>,timestamp:bigint,"
    "fields:map<string,variant>>>>"
)


def collector_metrics(text: Column) -> Column:
    """The entries of a batch with at least one field; no entries if the document is no object.

    Text that does not open like an object is not given to the reader, for which it is a costly exception.
    """
    opens = F.ltrim(text, F.lit(" \t\r\n")).startswith("{")
    parsed = F.from_json(F.when(opens, text), METRICS, JSON_OPTIONS)["metrics"]
    empty = F.array().cast(METRICS.removeprefix("struct<metrics:").removesuffix(">"))
    kept = F.filter(parsed, lambda m: F.size(F.map_keys(m["fields"])) > 0)
    return F.coalesce(kept, empty)


def collector_fields(batches: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per entry: document, position in it, plugin name and its fields as a map of variants."""
    listed = F.posexplode_outer(collector_metrics(F.col(text))).alias("pos", "m")
    entries = batches.select(doc_id, listed).filter(F.col("pos").isNotNull())
    return entries.select(doc_id, "pos", F.col("m.name").alias("plugin"), F.col("m.fields").alias("fields"))


def collector_entries(batches: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The same with the fields as JSON."""
    return collector_fields(batches, doc_id, text).withColumn("fields", F.to_json("fields"))

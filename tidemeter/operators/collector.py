"""Collector metrics: routing to resources, renames, tag promotion, merging, unpivoting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.functions.columns import let
from tidemeter.functions.payload import unique_keys
from tidemeter.schemas import FIELD_RENAMES, MERGED_PLUGIN, PLUGIN_RESOURCES, PROMOTED_TAGS
from tidemeter.sources.collector import collector_metrics


def entries_of(metrics: Column, plugin: str) -> Column:
    return F.filter(metrics, lambda m: m["name"] == plugin)


def parted(metrics: Column) -> Column:
    """Entries of one batch -> struct<names, fields, merged>: plugins from the last entry to the first, the field maps of the
    entries and those of the merged plugin as one map; null without entries."""
    parts = F.struct(
        F.reverse(metrics["name"]).alias("names"),
        metrics["fields"].alias("fields"),
        merged_fields(metrics, MERGED_PLUGIN).alias("merged"),
    )
    return F.when(F.size(metrics) > 0, parts)


def routed(parts: Column) -> Column:
    """Parts of one batch -> array<struct<resource, fields>>, an item for each resource, its fields null without an entry.

    The last entry of a plugin wins. For the merged plugin later entries add to and replace the fields of earlier ones.
    Plugins without a resource are dropped. No lambdas, so that the rows are made by generated code.
    """
    items = []
    for plugin, resource in PLUGIN_RESOURCES.items():
        # Counted from the end; past the end, so null, for a plugin that does not occur.
        place = F.size(parts["fields"]) - F.array_position(parts["names"], plugin).cast("int")
        fields = parts["merged"] if plugin == MERGED_PLUGIN else F.get(parts["fields"], place)
        items.append(F.struct(F.lit(resource).alias("resource"), fields.alias("fields")))
    return F.array(*items)


def merged_fields(metrics: Column, plugin: str) -> Column:
    """Field maps of all entries of a plugin merged, a later key replacing an earlier one; null without entries.

    Inside of a lambda ``map_contains_key`` leaves its loop by an exception for each key it finds, ``exists`` does not.
    """

    def merge(so_far: Column, later: Column) -> Column:
        kept = F.map_filter(so_far, lambda key, _: ~F.exists(F.map_keys(later), lambda name: name == key))
        return F.map_concat(kept, later)

    def merged(maps: Column) -> Column:
        return F.aggregate(F.slice(maps, F.lit(2), F.size(maps)), F.get(maps, F.lit(0)), merge)

    return let(F.transform(entries_of(metrics, plugin), lambda m: unique_keys(m["fields"])), merged)


def route_batches(batches: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """One row per batch document and resource, with the columns to keep of the document: the fields as JSON (``value``) and
    as a map of variants (``fields``)."""
    parts = batches.select(*keep, let(collector_metrics(F.col(text)), parted).alias("_parts"))
    rows = parts.select(*keep, F.inline_outer(routed(F.col("_parts"))).alias("resource_name", "fields"))
    known = rows.filter(F.col("fields").isNotNull())
    return known.select(*keep, "resource_name", F.to_json("fields").alias("value"), "fields")


def routed_events(
    routes: DataFrame, doc_id: str, device_name: Column, profile_name: Column, origin: Column
) -> DataFrame:
    """Routed values as event envelopes (JSON text), one reading each.

    A generator holds the text back: merged into the projection of a reader that follows, it would be written by interpreted
    expressions, since the reader's projection has no generated code.
    """
    reading = F.struct(
        origin.alias("origin"),
        device_name.alias("deviceName"),
        F.col("resource_name").alias("resourceName"),
        profile_name.alias("profileName"),
        F.lit("String").alias("valueType"),
        F.col("value"),
    )
    envelope = F.struct(
        F.lit("v3").alias("apiVersion"),
        F.concat_ws("-", F.col(doc_id).cast("string"), "resource_name").alias("id"),
        device_name.alias("deviceName"),
        profile_name.alias("profileName"),
        F.col("resource_name").alias("sourceName"),
        origin.alias("origin"),
        F.array(reading).alias("readings"),
    )
    return routes.select(doc_id, "resource_name", F.explode(F.array(F.to_json(envelope))).alias("event"))


def rename_fields(
    entries: DataFrame,
    plugin: str = "plugin",
    fields: str = "fields",
    renames: Mapping[str, Mapping[str, str]] = FIELD_RENAMES,
) -> DataFrame:
    """Rename fields of given plugins in a map column; a field that had the new name is replaced."""

    def replaced(key: Column, _: Column) -> Column:
        hit = F.lit(False)
        for owner, names in renames.items():
            for old, new in names.items():
                taken = (F.col(plugin) == owner) & (key == new)
                hit = hit | (taken & F.map_contains_key(fields, F.lit(old)))
        return hit

    def new_name(key: Column, _: Column) -> Column:
        name = key
        for owner, names in renames.items():
            for old, new in names.items():
                name = F.when((F.col(plugin) == owner) & (key == old), new).otherwise(name)
        return name

    free = F.map_filter(fields, lambda key, value: ~replaced(key, value))
    return entries.withColumn(fields, F.transform_keys(free, new_name))


def promote_tags(
    entries: DataFrame,
    plugin: str = "plugin",
    tags: str = "tags",
    fields: str = "fields",
    promoted: Mapping[str, Sequence[str]] = PROMOTED_TAGS,
) -> DataFrame:
    """Move given tags of given plugins into the fields as text. Both columns are maps of text."""

    def promote(df: DataFrame, owner: str, names: Sequence[str]) -> DataFrame:
        own = F.col(plugin) == owner
        moved = F.map_filter(tags, lambda key, _: key.isin(*names))
        kept = F.map_filter(tags, lambda key, _: ~key.isin(*names))
        others = F.map_filter(
            fields, lambda key, _: ~(key.isin(*names) & F.map_contains_key(tags, key))
        )
        return df.withColumns(
            {
                fields: F.when(own, F.map_concat(others, moved)).otherwise(F.col(fields)),
                tags: F.when(own, kept).otherwise(F.col(tags)),
            }
        )

    for owner, names in promoted.items():
        entries = promote(entries, owner, names)
    return entries


def merge_same_key_metrics(
    metrics: DataFrame, name: str, tags: str, time: str, fields: str, order: str
) -> DataFrame:
    """Metrics with the same name, tags and time become one; the later value of a field wins.

    Each field is settled by partial aggregation first, so that the maps are built from distinct
    fields only, even if one key holds a large share of all metrics.
    """
    identity = F.array_sort(F.map_entries(tags)).alias("tag_list")
    single = metrics.select(
        F.col(name).alias("name"),
        identity,
        F.col(time).alias("time"),
        F.col(order).alias("seq"),
        F.explode(fields).alias("key", "value"),
    )
    settled = single.groupBy("name", "tag_list", "time", "key").agg(
        F.max_by("value", "seq").alias("value")
    )
    merged = settled.groupBy("name", "tag_list", "time").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("fields")
    )
    return merged.select("name", F.map_from_entries("tag_list").alias("tags"), "time", "fields")


def unpivot_metrics(wide: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Wide record -> one row per metric, the value as text."""
    texts = wide.select(*ids, *[F.col(m).cast("string").alias(m) for m in metrics])
    return texts.unpivot(list(ids), list(metrics), "resource_name", "value")

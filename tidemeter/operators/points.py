"""Real-time path: Kafka records -> decoded events -> flat, typed time-series points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.functions.columns import with_known
from tidemeter.functions.payload import (
    VARIANT_MAP,
    explode_fields,
    flatten_members,
    json_document,
    json_object,
    no_members,
    settle,
    utf8_text,
    variant_text,
)
from tidemeter.schemas import POINT_MEASUREMENT

# Top-level members that are tags, provenance or structure rather than text fields (fixed values).
NOT_META = ("sourceName", "deviceName", "profileName", "readings", "apiVersion", "origin")

ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

# Tag column -> member it comes from.
TAGS = {
    "source_name": "sourceName",
    "device_name": "deviceName",
    "profile_name": "profileName",
}


def decoded(value: Column) -> Column:
    """Message bytes -> map of variants; null unless they are UTF-8 and one JSON object."""
    return json_object(utf8_text(value))


def parse_records(records: DataFrame) -> DataFrame:
    """Add ``event``, null for invalid messages."""
    return records.withColumn("event", decoded(F.col("value")))


def valid_events(records: DataFrame) -> DataFrame:
    """Records with their ``event``; invalid messages are dropped."""
    return with_known(records, "event", decoded(F.col("value")))


def dead_letter_status(parsed: DataFrame) -> DataFrame:
    """Mark each record ``valid`` or ``invalid``, so that one partitioned write splits them."""
    status = F.when(F.col("event").isNotNull(), "valid").otherwise("invalid")
    return parsed.withColumn("status", status)


def enrich_provenance(parsed: DataFrame, processed_at: Column) -> DataFrame:
    return parsed.withColumns(
        {
            "_kafka_topic": F.coalesce("topic", F.lit("unknown")),
            "_kafka_partition": F.coalesce("partition", F.lit(-1)),
            "_kafka_offset": F.coalesce("offset", F.lit(-1).cast("bigint")),
            "_processed_at": processed_at,
        }
    )


def member(name: str) -> Column:
    return F.try_element_at(F.col("event"), F.lit(name))


def tag_text(value: Column) -> Column:
    """A member as text; ``unknown`` only if the key is missing, ``None`` for a JSON null."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(value.isNull(), "unknown")
        .when(kind == "VOID", "None")
        .when(kind == "BOOLEAN", F.initcap(text))
        .otherwise(text)
    )


def tagged(events: DataFrame) -> DataFrame:
    """Add the tag columns source_name, device_name and profile_name."""
    picked = events.withColumns({f"_{column}": member(key) for column, key in TAGS.items()})
    named = picked.withColumns({column: tag_text(F.col(f"_{column}")) for column in TAGS})
    return named.drop(*[f"_{column}" for column in TAGS])


def reading_members(readings: Column, keep_scalars: bool = False) -> Column:
    """Members of all readings of an event, in order.

    ``keep_scalars`` also keeps readings whose value is a plain scalar, under their resource name.
    """

    def of_one(reading: Column) -> Column:
        value = F.try_variant_get(reading, "$.value", "variant")
        members = flatten_members(variant_text(value))
        if not keep_scalars:
            return members
        scalar = F.try_parse_json(variant_text(value))
        structured = F.schema_of_variant(scalar).startswith("OBJECT") | scalar.isNull()
        resource = F.try_variant_get(reading, "$.resourceName", "string")
        named = F.array(F.struct(resource.alias("key"), scalar.alias("value")))
        return F.when(structured, members).otherwise(named)

    listed = F.try_variant_get(readings, "$", "array<variant>")
    return F.coalesce(F.flatten(F.transform(listed, of_one)), no_members())


def meta_members(event: Column) -> Column:
    """Other top-level text members, as ``meta_<key>``."""
    texts = F.filter(
        F.map_entries(event),
        lambda e: ~e["key"].isin(*NOT_META) & (F.schema_of_variant(e["value"]) == "STRING"),
    )
    return F.transform(
        texts,
        lambda e: F.struct(
            F.concat(F.lit("meta_"), e["key"]).alias("key"), e["value"].alias("value")
        ),
    )


def build_points(events: DataFrame, keep_scalars: bool = False) -> DataFrame:
    """Decoded events with provenance -> one row per field, the later reading winning.

    A message is flattened inside its own row, so this step does not shuffle. Invalid messages have
    no fields and vanish here.
    """
    gathered = tagged(events).select(
        *TAGS,
        F.col("_kafka_topic").alias("topic"),
        F.col("_kafka_partition").alias("kafka_partition"),
        F.col("_kafka_offset").alias("kafka_offset"),
        F.col("_processed_at").alias("ts"),
        reading_members(member("readings"), keep_scalars).alias("readings"),
        meta_members(F.col("event")).alias("meta"),
    )
    reserved = F.transform("meta", lambda e: e["key"])
    settled = gathered.withColumn("readings", settle(F.col("readings"), reserved)).select(
        *[c for c in gathered.columns if c not in ("readings", "meta")],
        F.size("readings").alias("n_readings"),
        F.concat("readings", "meta").alias("members"),
    )
    fields = explode_fields(settled, "members", F.col("n_readings")).drop("n_readings")
    return fields.select(F.lit(POINT_MEASUREMENT).alias("measurement"), "*")


def points_from_records(
    records: DataFrame, processed_at: Column, keep_scalars: bool = False
) -> DataFrame:
    return build_points(enrich_provenance(parse_records(records), processed_at), keep_scalars)


def annotation_records(events: DataFrame, at: Column, enabled: bool = True) -> DataFrame:
    """Dashboard annotation per event: time in ms, tags and text; none when disabled."""
    if not enabled:
        events = events.filter(F.lit(False))
    text = F.concat(F.lit("source="), "source_name", F.lit(" device="), "device_name")
    return tagged(events).select(
        F.unix_millis(at).alias("time"),
        F.array(F.lit("kafka"), "source_name").alias("tags"),
        text.alias("text"),
    )


def documents(records: DataFrame, ingested_at: Column) -> DataFrame:
    """Events as JSON documents with the time they were ingested.

    An event that is valid for points is a document, too. Numbers that JSON cannot write (``NaN``, ``Infinity`` and
    ``-Infinity``) are texts of these names in the document.
    """
    valid = valid_events(records)
    text = F.to_json(F.struct(F.date_format(ingested_at, ISO_TIME).alias("_ingested_at")))
    stamp = F.from_json(text, VARIANT_MAP)
    own = F.map_filter("event", lambda key, _: key != "_ingested_at")
    document = F.to_json(F.map_concat(own, stamp)).alias("document")
    return valid.select("topic", "partition", "offset", document)


def normalize_json_bytes(records: DataFrame) -> DataFrame:
    """Valid JSON is written anew, anything else is passed on as it came."""
    text = utf8_text(F.col("value"))
    document = json_document(text)
    return records.withColumn("was_json", document.isNotNull()).withColumn(
        "value", F.coalesce(F.to_json(document).cast("binary"), F.col("value"))
    )

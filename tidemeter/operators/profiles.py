"""Device profiles: the resource dimension and checks against it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.schemas import NUMERIC_VALUE_TYPES

RESOURCES = (
    "array<struct<name:string,properties:struct<valueType:string,units:string,readWrite:string>>>"
)
WRAPPED = f"struct<profile:struct<name:string,deviceResources:{RESOURCES}>>"
PLAIN = f"struct<name:string,deviceResources:{RESOURCES}>"


def profile_dimension(documents: DataFrame, text: str = "document") -> DataFrame:
    """Profile documents -> one row per resource.

    A document is ``[{"profile": {...}}]`` (its first element counts), ``{"profile": {...}}`` or the
    bare profile.
    """
    as_list = F.get(F.from_json(text, f"array<{WRAPPED}>"), F.lit(0))["profile"]
    as_plain = F.from_json(text, PLAIN)
    is_plain = as_plain["name"].isNotNull()
    profile = F.when(is_plain, as_plain).otherwise(as_list)
    rows = documents.select(profile.alias("p")).select(
        F.col("p.name").alias("profile_name"), F.explode_outer("p.deviceResources").alias("r")
    )
    return rows.filter(F.col("r").isNotNull()).select(
        "profile_name",
        F.col("r.name").alias("resource_name"),
        F.col("r.properties.valueType").alias("value_type"),
        F.col("r.properties.units").alias("units"),
        F.col("r.properties.readWrite").alias("read_write"),
    )


def new_profiles(dimension: DataFrame, registered: DataFrame) -> DataFrame:
    """Rows of profiles whose name is not registered yet."""
    names = registered.select("profile_name").distinct()
    return dimension.join(names, "profile_name", "left_anti")


def value_fits(value: Column, value_type: Column) -> Column:
    """Does the text read as the type the profile declares."""
    integer = value.try_cast("decimal(20,0)").isNotNull() & value.rlike(r"^\s*[+-]?\d+\s*$")
    return (
        F.when(value_type.startswith("Uint"), integer & ~value.contains("-"))
        .when(value_type.startswith("Int"), integer)
        .when(value_type.isin(*NUMERIC_VALUE_TYPES), value.try_cast("double").isNotNull())
        .when(value_type == "Bool", value.try_cast("boolean").isNotNull())
        .otherwise(value.isNotNull())
    )


def profile_conformance(readings: DataFrame, dimension: DataFrame) -> DataFrame:
    """Mark readings ``ok``, ``unknown resource`` or ``bad value`` against their profile.

    The optimizer broadcasts a dimension whose size allows it, seen at run time.
    """
    known = dimension.select(
        "profile_name", "resource_name", F.col("value_type").alias("declared_type")
    ).dropDuplicates(["profile_name", "resource_name"])
    checked = readings.join(
        known, ["profile_name", "resource_name"], "left"
    )
    verdict = (
        F.when(F.col("declared_type").isNull(), "unknown resource")
        .when(value_fits(F.col("raw_value"), F.col("declared_type")), "ok")
        .otherwise("bad value")
    )
    return checked.withColumn("verdict", verdict)


def rejects(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("verdict") != "ok")


def filter_devices(
    events: DataFrame, names: Sequence[str], filter_out: bool = False, column: str = "device_name"
) -> DataFrame:
    """Keep (or drop) the events of the named devices."""
    listed = F.col(column).isin(*names)
    return events.filter(~listed if filter_out else listed)


def filter_devices_by_table(
    events: DataFrame, names: DataFrame, filter_out: bool = False, column: str = "device_name"
) -> DataFrame:
    """The same for a list too long to write into a query."""
    listed = names.select(column).distinct()
    return events.join(listed, column, "left_anti" if filter_out else "left_semi")

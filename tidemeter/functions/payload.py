"""JSON payloads as ordered, typed members, kept inside one row.

A message is one row and stays one row until its fields are final, so nothing here shuffles: members
are arrays of structs in document order, and "the later one wins" is settled by sorting that array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemeter.functions.columns import let

JSON_OPTIONS = {"allowSingleQuotes": "false"}
TEXT_MAP = T.MapType(T.StringType(), T.StringType())
NUMBER_MAP = T.MapType(T.StringType(), T.DoubleType())
VARIANT_MAP = T.MapType(T.StringType(), T.VariantType())


def json_object(text: Column) -> Column:
    """Text that is exactly one JSON object -> map of variants in document order; else null. Of
    repeated keys the last value counts.

    The JSON reader stops after the first value, so the text is read as the first of two items of an
    array. The second is a seal, the hash of the text: a text that closes the array itself or brings
    items of its own does not end with it. Text that does not open like an object is not given to the
    reader, for which every malformed text is a costly exception.
    """

    def read(whole: Column) -> Column:
        opens = F.ltrim(whole, F.lit(" \t\r\n")).startswith("{")
        sealed = F.concat(F.lit("["), whole, F.lit(',{"seal":"'), _seal(whole), F.lit('"}]'))
        parsed = F.from_json(F.when(opens, sealed), T.ArrayType(VARIANT_MAP), JSON_OPTIONS)
        return let(parsed, lambda p: _sealed_item(p, F.get(p, F.lit(1))["seal"], whole))

    return unique_keys(let(text, read))


def json_document(text: Column) -> Column:
    """Text that is exactly one JSON value of any kind -> variant; else null. Sealed as above."""

    def read(whole: Column) -> Column:
        sealed = F.concat(F.lit("["), whole, F.lit(',"'), _seal(whole), F.lit('"]'))
        items = F.try_variant_get(F.try_parse_json(sealed), "$", "array<variant>")
        return let(items, lambda p: _sealed_item(p, F.get(p, F.lit(1)), whole))

    return let(text, read)


def _seal(text: Column) -> Column:
    return F.xxhash64(text).cast("string")


def _sealed_item(items: Column, seal: Column, text: Column) -> Column:
    """The first of exactly two items, if the second holds the seal of the text."""
    whole = (F.size(items) == 2) & (F.try_variant_get(seal, "$", "string") == _seal(text))
    return F.when(whole, F.get(items, F.lit(0)))


def utf8_text(value: Column) -> Column:
    """Message bytes -> text; bytes that are not UTF-8 -> null."""
    return F.try_validate_utf8(value.cast("string"))


def variant_text(value: Column) -> Column:
    """The text of a variant that holds a string, else null."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def member_kind(value: Column) -> Column:
    """``bool``, ``num``, ``str`` or, for null, objects and arrays, ``none``."""

    def name(kind: Column) -> Column:
        numeric = kind.startswith("DECIMAL") | kind.isin("BIGINT", "DOUBLE", "FLOAT")
        return (
            F.when(kind == "STRING", "str")
            .when(numeric, "num")
            .when(kind == "BOOLEAN", "bool")
            .otherwise("none")
        )

    return let(F.schema_of_variant(value), name)


def variant_number(value: Column) -> Column:
    """The double held by a variant that is a JSON number, else null."""
    return F.when(member_kind(value) == "num", F.try_variant_get(value, "$", "double"))


def no_members() -> Column:
    return F.array().cast("array<struct<key:string,value:variant>>")


def flatten_members(text: Column) -> Column:
    """Value text -> array<struct<key, value variant>> in document order; a key may come again.

    A string member holding a JSON object is replaced by the members of that object; every other
    member stays. Text that is not an object gives an empty array.
    """

    def expand(entry: Column) -> Column:
        inner = F.map_entries(json_object(variant_text(entry["value"])))
        return F.coalesce(inner, F.array(entry))

    members = F.flatten(F.transform(F.map_entries(json_object(text)), expand))
    return F.coalesce(members, no_members())


def _distinct(names: Column) -> Column:
    return F.size(F.array_distinct(names)) == F.size(names)


def last_of_names(name: str, at: str, items: Column) -> Column:
    """Of the structs keep the last one of every name, as struct<item, first>.

    "Last" is by the column ``at``, and ``first`` is the smallest ``at`` of the name. The array is
    sorted by name, so that a run of equal names shows both at its ends.
    """

    def keyed(item: Column) -> Column:
        return F.struct(item[name].alias("name"), item[at].alias("at"), item.alias("item"))

    def ends(ordered: Column) -> Column:
        size = F.size(ordered)
        shifted = F.concat(F.array(F.lit(None).cast("string")), names(ordered))
        before = F.arrays_zip(ordered.alias("own"), F.slice(shifted, F.lit(1), size).alias("other"))
        after = F.arrays_zip(
            ordered.alias("own"), names(F.slice(ordered, F.lit(2), size)).alias("other")
        )
        return F.transform(
            F.arrays_zip(edges(before).alias("head"), edges(after).alias("tail")),
            lambda run: F.struct(
                run["tail"]["own"]["item"].alias("item"), run["head"]["own"]["at"].alias("first")
            ),
        )

    def names(ordered: Column) -> Column:
        return F.transform(ordered, lambda item: item["name"])

    def edges(pairs: Column) -> Column:
        return F.filter(pairs, lambda p: ~p["other"].eqNullSafe(p["own"]["name"]))

    return let(F.sort_array(F.transform(items, keyed)), ends)


def _positions(items: Column, entries: Column) -> Column:
    """The entries at the positions of the items."""
    return F.transform(items, lambda item: F.get(entries, item["pos"]))


def unique_keys(members: Column) -> Column:
    """A map as read from JSON with each key once: the last value, at the place of the first."""

    def last_entries(entries: Column) -> Column:
        numbered = F.transform(
            entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("pos"))
        )
        placed = F.transform(
            last_of_names("key", "pos", numbered),
            lambda run: F.struct(run["first"].alias("place"), run["item"]["pos"].alias("pos")),
        )
        return F.map_from_entries(_positions(F.sort_array(placed), entries))

    def choose(m: Column) -> Column:
        plain = m.isNull() | _distinct(F.map_keys(m))
        return F.when(plain, m).otherwise(let(F.map_entries(m), last_entries))

    return let(members, choose)


def field_name(key: Column, kind: Column) -> Column:
    """Text fields are told apart from numbers by a suffix."""
    return F.when(kind == "str", F.concat(key, F.lit("_str"))).otherwise(key)


def settle(members: Column, reserved: Column | None = None) -> Column:
    """Members with at most one per field, the later one winning.

    Null, objects and arrays count as values of their key but give no field, and a field name that
    is ``reserved`` is given up. Keys are usually distinct and do not look like the name of another
    key's field; then nothing is to be done.
    """

    def resolve(given: Column) -> Column:
        def described(entry: Column, index: Column) -> Column:
            kind = member_kind(entry["value"])
            return let(
                kind,
                lambda k: F.struct(
                    entry["key"].alias("key"),
                    field_name(entry["key"], k).alias("field"),
                    k.alias("kind"),
                    index.alias("pos"),
                ),
            )

        # A key keeps the place of its first occurrence and the value of its last.
        per_key = F.transform(
            last_of_names("key", "pos", F.transform(given, described)),
            lambda run: run["item"].withField("place", run["first"]),
        )
        fields = F.filter(per_key, lambda d: d["kind"] != "none")
        per_field = F.transform(last_of_names("field", "place", fields), lambda run: run["item"])
        if reserved is not None:
            per_field = F.filter(per_field, lambda d: ~F.array_contains(reserved, d["field"]))
        return _positions(per_field, given)

    def choose(given: Column) -> Column:
        keys = F.transform(given, lambda e: e["key"])
        risky = F.exists(keys, lambda k: k.endswith("_str") | k.startswith("meta_"))
        return F.when(_distinct(keys) & ~risky, given).otherwise(resolve(given))

    return let(members, choose)


def explode_fields(rows: DataFrame, members: str, plain_from: Column | None = None) -> DataFrame:
    """One row per field: its name and its value in the column of its kind.

    Booleans stay, numbers become doubles, text goes to ``<key>_str``; null, objects and arrays are
    dropped. Members from position ``plain_from`` on keep their name. What is left to do per member
    runs on plain rows, in generated code. The generator is an outer one because for an inner one the
    optimizer adds a filter on the array, which would be computed twice.
    """
    others = [c for c in rows.columns if c != members]
    start = F.lit(None).cast("int") if plain_from is None else plain_from
    one = rows.select(
        *others, start.alias("_plain"), F.posexplode_outer(members).alias("_pos", "_m")
    )
    typed = one.select(
        *others,
        F.col("_m.key").alias("_key"),
        F.col("_m.value").alias("_value"),
        F.coalesce(F.col("_pos") >= F.col("_plain"), F.lit(False)).alias("_as_is"),
        F.schema_of_variant("_m.value").alias("_type"),
    )
    numeric, text, boolean = (
        F.col("_type").startswith("DECIMAL") | F.col("_type").isin("BIGINT", "DOUBLE", "FLOAT"),
        F.col("_type") == "STRING",
        F.col("_type") == "BOOLEAN",
    )
    value = F.col("_value")
    return typed.filter(numeric | text | boolean).select(
        *others,
        F.when(text & ~F.col("_as_is"), F.concat("_key", F.lit("_str")))
        .otherwise(F.col("_key"))
        .alias("field"),
        F.when(numeric, F.try_variant_get(value, "$", "double")).alias("value_num"),
        F.when(text, F.try_variant_get(value, "$", "string")).alias("value_str"),
        F.when(boolean, F.try_variant_get(value, "$", "boolean")).alias("value_bool"),
    )

"""Payloads of recorded ``key:value`` lines: ``cpu:cpu-total, host:a1, usage_idle:84.1`` and so on, line by line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.functions.columns import let
from tidemeter.functions.payload import last_of_names

# A comma and a blank end an item only where another key follows, so values may hold both.
ITEM_END = ", (?=[^:,]*:)"

# Up to so many items a line's keys are looked up one by one; in longer lines repeated keys are found by sorting.
SHORT_LINE = 64


def line_entries(line: Column) -> Column:
    """A line -> array<struct<place, key, value>>: each key once, the last of its values, in the order of first places.

    The first colon ends the key; a value may hold colons. Keys and values are trimmed; an item without a colon or
    without a key is no entry. Repeated keys are settled within the line, as maps refuse them.
    """

    def entry(item: Column, at: Column) -> Column:
        colon = F.instr(item, ":")
        return F.struct(
            F.trim(F.substring(item, F.lit(1), colon - 1)).alias("key"),
            F.trim(F.substring(item, colon + 1, F.length(item))).alias("value"),
            at.alias("pos"),
        )

    items = F.filter(F.split(line, ITEM_END), lambda item: F.instr(item, ":") > 0)
    entries = F.filter(F.transform(items, entry), lambda e: e["key"] != "")
    return let(entries, lambda e: F.when(F.size(e) <= SHORT_LINE, _looked_up(e)).otherwise(_sorted(e)))


def _looked_up(entries: Column) -> Column:
    """Last values by position of the key, from the front for its place and from the back for its value."""

    def found(keys: Column, back: Column) -> Column:
        return F.transform(
            F.array_distinct(keys),
            lambda key: F.struct(
                F.get(entries, (F.array_position(keys, key) - 1).cast("int"))["pos"].alias("place"),
                key.alias("key"),
                F.get(entries, F.size(keys) - F.array_position(back, key).cast("int"))["value"].alias("value"),
            ),
        )

    return let(entries["key"], lambda keys: let(F.reverse(keys), lambda back: found(keys, back)))


def _sorted(entries: Column) -> Column:
    last = last_of_names("key", "pos", entries)
    return F.sort_array(F.transform(last, lambda run: F.struct(run["first"].alias("place"), run["item"]["key"].alias("key"), run["item"]["value"].alias("value"))))


def decode_kv_lines(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` with one row per line and key: line_number (from 0), position (of the key in its line), key, value, value_num.

    ``value_num`` is null where the value is no number. Lines end at a newline, a carriage return before it is ignored; empty
    lines count as lines and have no rows. Null has no lines. Nothing is shuffled.
    """
    lines = rows.select("*", F.posexplode_outer(F.split(text, "\r?\n")).alias("line_number", "_line"))
    entries = lines.select("*", F.posexplode_outer(line_entries(F.col("_line"))).alias("position", "_entry"))
    return entries.where(F.col("position").isNotNull()).select(
        *rows.columns,
        "line_number",
        "position",
        F.col("_entry.key").alias("key"),
        F.col("_entry.value").alias("value"),
        F.col("_entry.value").try_cast("double").alias("value_num"),
    )

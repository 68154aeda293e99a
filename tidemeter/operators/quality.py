"""Data-quality suites: rules become conditional counts of one aggregation pass.

A suite is a dict (usually read from JSON)::

    {"data_asset_name": "orders",
     "table_rules": [{"rule_name": "check_table_row_count_not_zero", "add_info": {"min_value": 1}}],
     "columns": [{"column_name": "status", "dq_rule(s)": [
         {"rule_name": "check_if_values_in_list", "add_info": {"value_set": ["pending"]}}]}]}

Rules with unknown names are skipped.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT_COLUMNS = ("asset", "rule", "column_name", "unexpected", "success")


class DataQualityError(Exception):
    """A suite failed."""


@dataclass(frozen=True)
class Check:
    """A rule ready to run: how many rows (or missing rows) contradict it."""

    rule: str
    column_name: str | None
    unexpected: Column


def row_count_min(minimum: int) -> Column:
    return F.greatest(F.lit(minimum) - F.count(F.lit(1)), F.lit(0))


def not_null(column_name: str) -> Column:
    return F.count_if(F.col(column_name).isNull())


def in_set(column_name: str, values: Sequence) -> Column:
    """Values outside the set; nulls are no values."""
    column = F.col(column_name)
    return F.count_if(column.isNotNull() & ~column.isin(*values))


def between(column_name: str, low=None, high=None) -> Column:
    """Values outside the closed range; an end that is not given is open."""
    column = F.col(column_name)
    outside = F.lit(False)
    if low is not None:
        outside = outside | (column < low)
    if high is not None:
        outside = outside | (column > high)
    return F.count_if(column.isNotNull() & outside)


# Rule name -> function of (column name, additional information).
TABLE_RULES: dict[str, Callable[[Mapping], Column]] = {
    "check_table_row_count_not_zero": lambda info: row_count_min(info.get("min_value", 1)),
}
COLUMN_RULES: dict[str, Callable[[str, Mapping], Column]] = {
    "check_if_not_null": lambda name, info: not_null(name),
    "check_if_values_in_list": lambda name, info: in_set(name, info.get("value_set", [])),
    "check_if_between": lambda name, info: between(
        name, info.get("min_value"), info.get("max_value")
    ),
}


def checks(suite: Mapping) -> list[Check]:
    found = []
    for rule in suite.get("table_rules", []):
        build = TABLE_RULES.get(rule.get("rule_name"))
        if build:
            found.append(Check(rule["rule_name"], None, build(rule.get("add_info", {}))))
    for column in suite.get("columns", []):
        name = column.get("column_name")
        for rule in column.get("dq_rule(s)", []):
            build = COLUMN_RULES.get(rule.get("rule_name"))
            if build:
                unexpected = build(name, rule.get("add_info", {}))
                found.append(Check(rule["rule_name"], name, unexpected))
    return found


def run_suite(data: DataFrame, suite: Mapping) -> DataFrame:
    """One row per rule with the number of unexpected rows, from a single pass over the data."""
    asset = F.lit(suite.get("data_asset_name"))
    found = checks(suite)
    if not found:
        schema = "asset string, rule string, column_name string, unexpected bigint, success boolean"
        return data.sparkSession.createDataFrame([], schema)
    counts = data.agg(*[c.unexpected.cast("bigint").alias(f"c{i}") for i, c in enumerate(found)])
    results = F.array(
        *[
            F.struct(
                asset.alias("asset"),
                F.lit(c.rule).alias("rule"),
                F.lit(c.column_name).cast("string").alias("column_name"),
                F.col(f"c{i}").alias("unexpected"),
                (F.col(f"c{i}") == 0).alias("success"),
            )
            for i, c in enumerate(found)
        ]
    )
    return counts.select(F.inline(results))


def run_suites(assets: Mapping[str, DataFrame], suites: Sequence[Mapping]) -> DataFrame:
    """Results of several suites, each against the asset it names."""
    results = [run_suite(assets[suite["data_asset_name"]], suite) for suite in suites]
    return reduce(DataFrame.unionByName, results)


def suite_success(results: DataFrame) -> DataFrame:
    """Per asset: did all rules hold."""
    return results.groupBy("asset").agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if(~F.col("success")).alias("failed_rules"),
        F.bool_and("success").alias("success"),
    )


def gate(results: DataFrame) -> None:
    """Stop the run if a rule failed. There is one row per rule, so the driver sees few rows."""
    failed = results.filter(~F.col("success")).collect()
    if failed:
        broken = "; ".join(f"{r.asset}.{r.column_name or '*'} {r.rule}: {r.unexpected}" for r in failed)
        raise DataQualityError(broken)


def load_suites(spark: SparkSession, directory: str, pattern: str = "*.json") -> list[dict]:
    """All suite files (JSON, one suite each) of a folder, sorted by file name."""
    files = spark.read.text(directory, wholetext=True, pathGlobFilter=pattern)
    rows = files.select(F.col("_metadata.file_path").alias("path"), "value").collect()
    return [json.loads(row.value) for row in sorted(rows)]

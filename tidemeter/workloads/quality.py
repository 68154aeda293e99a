"""Data-quality rules over the given tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemeter.operators import quality
from tidemeter.plans import datasets
from tidemeter.session import run_dir
from tidemeter.workloads.inputs import table
from tidemeter.workloads.registry import query


def suite(asset: str, table_rules: list[dict], columns: dict[str, list[dict]]) -> dict:
    return {
        "data_asset_name": asset,
        "table_rules": table_rules,
        "columns": [{"column_name": name, "dq_rule(s)": rules} for name, rules in columns.items()],
    }


def rule(name: str, **info) -> dict:
    return {"rule_name": name, "add_info": info}


ROWS = rule("check_table_row_count_not_zero", min_value=1)
MANY_ROWS = rule("check_table_row_count_not_zero", min_value=1_000_000_000)
NOT_NULL = rule("check_if_not_null")


def single(spark: SparkSession, sf_dir: str, asset: str, checks: dict) -> DataFrame:
    return quality.run_suite(table(spark, sf_dir, asset), checks)


@query(
    """SELECT 'orders' AS asset, 'check_table_row_count_not_zero' AS rule, NULL AS column_name,
       greatest(m - (SELECT count(*) FROM orders), 0) AS unexpected,
       (SELECT count(*) FROM orders) >= m AS success
    FROM (SELECT unnest([1, 1000000000]) AS m)"""
)
def dq_row_count_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single(spark, sf_dir, "orders", suite("orders", [ROWS, MANY_ROWS], {}))


@query(
    """SELECT 'orders' AS asset, 'check_if_not_null' AS rule, 'o_orderstatus' AS column_name,
       count(*) FILTER (o_orderstatus IS NULL) AS unexpected,
       count(*) FILTER (o_orderstatus IS NULL) = 0 AS success FROM orders
    UNION ALL
    SELECT 'orders', 'check_if_not_null', 'status', count(*) FILTER (o_orderstatus = 'P'),
       count(*) FILTER (o_orderstatus = 'P') = 0 FROM orders"""
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn(
        "status", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    )
    rules = {"o_orderstatus": [NOT_NULL], "status": [NOT_NULL]}
    return quality.run_suite(orders, suite("orders", [], rules))


@query(
    """SELECT 'orders' AS asset, 'check_if_values_in_list' AS rule, 'o_orderstatus' AS column_name,
       n AS unexpected, n = 0 AS success FROM (
      SELECT count(*) FILTER (o_orderstatus NOT IN ('F', 'O', 'P')) AS n FROM orders
      UNION ALL SELECT count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders)"""
)
def dq_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        rule("check_if_values_in_list", value_set=["F", "O", "P"]),
        rule("check_if_values_in_list", value_set=["F", "O"]),
    ]
    return single(spark, sf_dir, "orders", suite("orders", [], {"o_orderstatus": rules}))


@query(
    """SELECT 'lineitem' AS asset, 'check_if_between' AS rule, 'l_quantity' AS column_name,
       n AS unexpected, n = 0 AS success FROM (
      SELECT count(*) FILTER (l_quantity NOT BETWEEN 1 AND 50) AS n FROM lineitem
      UNION ALL SELECT count(*) FILTER (l_quantity NOT BETWEEN 2 AND 49) FROM lineitem
      UNION ALL SELECT count(*) FILTER (l_quantity > 25) FROM lineitem)"""
)
def dq_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        rule("check_if_between", min_value=1, max_value=50),
        rule("check_if_between", min_value=2, max_value=49),
        rule("check_if_between", max_value=25),
    ]
    return single(spark, sf_dir, "lineitem", suite("lineitem", [], {"l_quantity": rules}))


ORDERS_SUITE = suite(
    "orders",
    [ROWS],
    {
        "o_orderkey": [NOT_NULL, rule("rule_nobody_knows")],
        "o_orderstatus": [rule("check_if_values_in_list", value_set=["F", "O"])],
        "o_totalprice": [rule("check_if_between", min_value=0)],
    },
)
CUSTOMER_SUITE = suite("customer", [ROWS], {"c_custkey": [NOT_NULL]})

SUITE_SQL = """SELECT 'orders' AS asset, 'check_table_row_count_not_zero' AS rule,
       NULL AS column_name, 0 AS unexpected, true AS success
    UNION ALL SELECT 'orders', 'check_if_not_null', 'o_orderkey',
       count(*) FILTER (o_orderkey IS NULL), count(*) FILTER (o_orderkey IS NULL) = 0 FROM orders
    UNION ALL SELECT 'orders', 'check_if_values_in_list', 'o_orderstatus',
       count(*) FILTER (o_orderstatus NOT IN ('F', 'O')),
       count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) = 0 FROM orders
    UNION ALL SELECT 'orders', 'check_if_between', 'o_totalprice',
       count(*) FILTER (o_totalprice < 0), count(*) FILTER (o_totalprice < 0) = 0 FROM orders"""


@query(SUITE_SQL)
def dq_run_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single(spark, sf_dir, "orders", ORDERS_SUITE)


@query(
    f"""SELECT asset, count(*) AS rules, count(*) FILTER (NOT success) AS failed_rules,
       bool_and(success) AS success FROM (
      {SUITE_SQL}
      UNION ALL SELECT 'customer', 'check_table_row_count_not_zero', NULL, 0, true
      UNION ALL SELECT 'customer', 'check_if_not_null', 'c_custkey',
         count(*) FILTER (c_custkey IS NULL), count(*) FILTER (c_custkey IS NULL) = 0 FROM customer)
    GROUP BY asset"""
)
def run_dq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suite files of a folder against CSV assets made of the tables."""
    root = run_dir(spark, "quality")
    schemas = {}
    for name in ("orders", "customer"):
        asset = table(spark, sf_dir, name)
        schemas[name] = asset.schema
        asset.write.option("header", True).csv(f"{root}/data/{name}.csv")
    for checks in (ORDERS_SUITE, CUSTOMER_SUITE):
        text = spark.createDataFrame([(json.dumps(checks),)], "value string")
        text.coalesce(1).write.mode("append").text(f"{root}/suites")
    results = datasets.run_quality(
        spark, f"{root}/suites", f"{root}/data", schemas, pattern="*.txt"
    )
    return quality.suite_success(results)


@query(
    """SELECT count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) > 0 AS stopped,
       false AS good_stopped FROM orders"""
)
def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    def stops(results: DataFrame) -> bool:
        try:
            quality.gate(results)
        except quality.DataQualityError:
            return True
        return False

    bad = stops(single(spark, sf_dir, "orders", ORDERS_SUITE))
    good = stops(single(spark, sf_dir, "customer", CUSTOMER_SUITE))
    return spark.createDataFrame([(bad, good)], "stopped boolean, good_stopped boolean")

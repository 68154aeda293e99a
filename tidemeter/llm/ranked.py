"""Gapless numbers in a given order within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemeter.llm.shared import stored

RANGE_ROWS = 50_000


def ranked(rows: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``rows`` (a stored table) with ``name``, a number from 0 within each group, and ``<name>_of``, the rows of the group.

    Rows are dealt to ranges of (group, order, own number), which are about equally large whatever the groups; each range numbers
    its own rows, and a table of (group, range) counts, as large as groups and ranges together, shifts the numbers.
    The order of rows that are equal in all of ``order`` is arbitrary, but fixed.
    """
    sorted_group = F.col(group).asc_nulls_first()
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, 1 + rows.count() // RANGE_ROWS)
    owned = stored(rows.withColumn("_own", F.monotonically_increasing_id()), "owned")
    dealt = owned.repartitionByRange(parts, sorted_group, *order, F.col("_own"))
    dealt = stored(dealt.withColumn("_part", F.spark_partition_id()), "dealt")
    counts = dealt.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        F.col(group).alias("_g"),
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"),
        F.sum("_n").over(whole).alias(f"{name}_of"),
    )
    own = F.row_number().over(Window.partitionBy("_part", group).orderBy(*order, "_own"))
    numbered = dealt.withColumn("_rank", own - 1)
    joined = numbered.join(shifts, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    return joined.withColumn(name, (F.col("_shift") + F.col("_rank")).cast("long")).drop("_own", "_part", "_rank", "_g", "_p", "_shift")

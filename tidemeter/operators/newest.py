"""Newest rows of a stored table, read from the newest day down.

The days come from the catalog. Rows of a later day come before all rows of an earlier one, so a day is only read while rows are missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.schemas import TableSpec
from tidemeter.sinks.tables import TableStore


def newest_days(store: TableStore, spec: TableSpec, rows: int, condition: Column | None = None) -> DataFrame:
    """The newest days of a table that have ``rows`` rows that meet the condition, or all days if there are fewer.

    Each turn counts as many days as all turns before together, at first one; the number of turns is logarithmic and no day
    is counted twice. Rows without a day come last.
    """
    days = store.partitions(spec).select("event_date").distinct().orderBy(F.col("event_date").desc_nulls_last())
    listed = [row["event_date"] for row in days.collect()]
    table = store.scan(spec.name) if condition is None else store.scan(spec.name).where(condition)

    def of(chosen: Sequence[str | None]) -> DataFrame:
        known = [day for day in chosen if day is not None]
        inside = F.col("event_date").isin([F.lit(day).cast("date") for day in known]) if known else F.lit(False)
        return table.where(inside | F.col("event_date").isNull() if None in chosen else inside)

    taken, found = 0, 0
    while taken < len(listed) and found < rows:
        more = listed[taken : max(1, 2 * taken)]
        found += of(more).limit(rows - found).count()
        taken += len(more)
    return of(listed[:taken])


def newest_rows(store: TableStore, spec: TableSpec, n: int, order: Sequence[Column], condition: Column | None = None) -> DataFrame:
    """The first ``n`` rows by time, latest first, then by ``order``, reading no more days than needed."""
    rows = newest_days(store, spec, n, condition)
    return rows.orderBy(F.col(spec.time_column).desc(), *order).limit(n)

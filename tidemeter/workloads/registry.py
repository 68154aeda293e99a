"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemeter.session import configure

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Workload:
    run: Query
    sql: str | None


REGISTRY: dict[str, Workload] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def register(function: Query) -> Query:
        if function.__name__ in REGISTRY:
            raise ValueError(f"{function.__name__} is registered twice")

        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        REGISTRY[function.__name__] = Workload(run, sql)
        return function

    return register

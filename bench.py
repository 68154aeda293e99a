"""Headline queries over one data set; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores. Each query is run once to warm up and then
timed over a complete run whose rows go nowhere (``noop`` sink). Rates are input events per second.
The tables are first written in as many files as there are cores, which is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemeter.operators.points import points_from_records  # noqa: E402
from tidemeter.session import build_session, run_dir  # noqa: E402
from tidemeter.workloads import REGISTRY  # noqa: E402
from tidemeter.workloads.ingest import payloads_path  # noqa: E402
from tidemeter.workloads.inputs import table  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "decode_envelope",
    "bronze_readings",
    "silver_readings",
    "silver_metric_map",
    "gold_5min",
    "gold_30min",
    "build_points",
    "last_per_series",
    "latest_metric_by_device",
    "trend_pair",
    "gold_ledger",
    "gold_top10",
    "validate_gold_summary",
    "count_layers",
    "pivot_bins",
    "forward_fill",
    "route_telegraf_plugin",
    "merge_same_key_metrics",
    "tcp_session_throughput",
    "dq_run_suite",
    "realtime_points_stream",
    "run_readings_medallion",
]


def run_to_nowhere(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def stored_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The real-time path alone, from stored records."""
    records = spark.read.parquet(payloads_path(spark, sf_dir))
    return points_from_records(records, F.col("timestamp"))


def in_parts(spark: SparkSession, sf_dir: str) -> str:
    """The tables the queries read, in as many files as there are cores: a table of one row group is one task."""
    folder = run_dir(spark, "bench-input")
    for name in ("events", "lineitem", "orders", "customer", "nation", "region", "part"):
        rows = table(spark, sf_dir, name)
        rows.repartition(int(CPUS)).write.parquet(f"{folder}/{name}.parquet")
    return folder


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidemeter-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = in_parts(spark, SF_DIR)  # before the clock starts
    runs = {name: REGISTRY[name].run for name in HEADLINE}
    runs["points_from_stored_records"] = stored_points
    seconds = {}
    for name, run in runs.items():
        for _ in range(2):
            seconds[name] = timed(lambda: run_to_nowhere(run(spark, folder)))
    events = table(spark, SF_DIR, "events").count()
    rates = {
        name: round(events / seconds[name])
        for name in ("points_from_stored_records", "gold_5min", "gold_30min", "run_readings_medallion")
    }
    spark.stop()
    report = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
        "events": events,
        "events_per_second": rates,
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()

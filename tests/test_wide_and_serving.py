from __future__ import annotations

import datetime
import random

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemeter.functions import columns
from tidemeter.operators import serving, wide
from tidemeter.plans import datasets

SCHEMA = "event_id string, device_name string, resource_name string, value string, origin bigint"


def reading_frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def by_pandas(data, metrics, width):
    """The wide dataset of one device in plain pandas."""
    df = pd.DataFrame(data, columns=["event_id", "device", "resource", "value", "origin"])
    df = df[df.resource.isin(metrics)].sort_values(["origin", "event_id"])
    df["value"] = pd.to_numeric(df["value"])
    df["bin"] = df.origin // width * width
    out = df.pivot_table(index="bin", columns="resource", values="value", aggfunc="first")
    return out.reindex(columns=metrics).sort_index().ffill()


@pytest.mark.parametrize("bins_per_chunk", [1, 3, 1000])
def test_wide_equals_pandas(spark, bins_per_chunk):
    rng = random.Random(7)
    metrics = ["A", "B", "C"]
    data = [
        (f"e{i}", f"d{rng.randrange(2)}", rng.choice([*metrics, "other"]), str(rng.randrange(100)), rng.randrange(-300, 2000))
        for i in range(150)
    ]
    pivoted = wide.pivot_bins(reading_frame(spark, data), metrics, 10)
    made = wide.forward_fill(pivoted, metrics, 10, bins_per_chunk).toPandas()
    for device in ("d0", "d1"):
        own = made[made.device_name == device].set_index("bin").sort_index()[metrics]
        expected = by_pandas([r for r in data if r[1] == device], metrics, 10)
        pd.testing.assert_frame_equal(
            own.astype(float), expected.astype(float), check_names=False, check_index_type=False
        )


def test_first_value_of_a_bin_and_no_number(spark):
    data = [("b", "d", "A", "2", 5), ("a", "d", "A", "1", 5), ("c", "d", "A", "3", 1)]
    assert wide.pivot_bins(reading_frame(spark, data), ["A"], 10).first().A == 3.0
    assert wide.pivot_bins(reading_frame(spark, data[:2]), ["A"], 10).first().A == 1.0
    with pytest.raises(PySparkException):
        wide.pivot_bins(reading_frame(spark, [("a", "d", "A", "x", 1)]), ["A"], 10).collect()


def test_forward_fill_never_holds_a_whole_device(spark):
    data = [("e", "d", "A", "1", i) for i in range(0, 100, 10)]
    pivoted = wide.pivot_bins(reading_frame(spark, data), ["A"], 10)
    filled = wide.forward_fill(pivoted, ["A"], 10, 4)
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # one window per (device, chunk) over the bins, one per device over the chunks
    assert len(windows) == 2
    assert sum("chunk" in line.split("], [")[1] for line in windows) == 1


def test_readings_without_a_device_are_kept(spark):
    data = [("a", None, "A", "1", 0), ("b", None, "B", "2", 10), ("c", "d", "B", "3", 10)]
    made = datasets.wide_dataset(reading_frame(spark, data), ["A", "B"], 10)
    got = sorted((str(r.device_name), r.bin, r.A, r.B) for r in made.collect())
    assert got == [("None", 0, 1.0, None), ("None", 10, 1.0, 2.0), ("d", 10, None, 3.0)]


def test_run_wide_dataset_columns(spark, tmp_path):
    data = [("a", "d", "CPUUsage", "1", 0), ("b", "d", "Uptime", "2", 500_000_000)]
    path = str(tmp_path / "wide")
    made = datasets.run_wide_dataset(reading_frame(spark, data), path, drop_absent=True)
    assert made.columns == ["device_name", "bin", "datetime", "CPUUsage", "Uptime"]
    back = spark.read.csv(path, header=True, nullValue="\\N").orderBy("bin").collect()
    assert [(r.CPUUsage, r.Uptime) for r in back] == [("1.0", None), ("1.0", "2.0")]


GOLD = (
    "minute int, device_name string, profile_name string, resource_name string, "
    "sample_count bigint, avg_value double, min_value double, max_value double, batch_id string"
)


def gold_frame(spark, data):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    df = spark.createDataFrame([(m, d, "p", r, 1, v, v, v, b) for m, d, r, v, b in data], GOLD)
    window = start + F.make_interval(mins=F.col("minute"))
    return df.withColumn("window_start", window).withColumn("generated_at", start).drop("minute")


@pytest.fixture(scope="module")
def gold(spark):
    return gold_frame(
        spark,
        [
            (0, "d1", "cpu", 10.0, "b0"),
            (5, "d1", "cpu", 20.0, "b0"),
            (5, "d1", "cpu", 30.0, "b1"),
            (5, "d1", "mem", 50.0, "b0"),
            (10, "d2", "cpu", 95.0, "b0"),
        ],
    )


def now(text="2024-01-01 00:15:00"):
    return F.lit(text).cast("timestamp")


def test_latest(gold):
    assert serving.latest_metric(gold, "cpu", "d1").first().avg_value == 30.0
    assert serving.latest_metric(gold, "cpu", "none").count() == 0
    newest = serving.latest_metric_by_device(gold, ["cpu", "mem"])
    assert {(r.device_name, r.resource_name): r.avg_value for r in newest.collect()} == {
        ("d1", "cpu"): 30.0,
        ("d1", "mem"): 50.0,
        ("d2", "cpu"): 95.0,
    }


def test_trends(gold):
    times = [r.time.minute for r in serving.trend_metric(gold, "cpu", now(), 10, "d1").collect()]
    assert times == [5, 5]
    assert serving.trend_metric(gold, "cpu", now()).count() == 4
    pair = serving.trend_pair(gold, ["cpu", "mem"], now(), 60, "d1").collect()
    assert [(r.batch_id, r.cpu, r.mem) for r in pair] == [("b0", 10.0, None), ("b0", 20.0, 50.0), ("b1", 30.0, None)]


def test_ledger_and_tops(gold):
    ledger = serving.gold_ledger(gold, now(), 60, "d1").collect()
    assert [r.time_window for r in ledger] == ["2024-01-01 00:05:00"] * 3 + ["2024-01-01 00:00:00"]
    assert serving.gold_top10(gold).first().device_name == "d2"
    assert serving.device_latest50(gold, "d1").count() == 4


def test_thresholds(spark):
    df = spark.createDataFrame(
        [("cpu_data_usage_user", v) for v in (69.9, 70.0, 89.9, 90.0, None)] + [("x", 99.0)],
        "resource_name string, avg_value double",
    )
    states = [r.state for r in serving.threshold_state(df).collect()]
    assert states == ["green", "yellow", "yellow", "red", None, None]


def test_legend_and_checks(gold):
    legend = {r.resource_name: r for r in serving.legend_reduce(gold.filter("device_name = 'd1'")).collect()}
    assert (legend["cpu"].mean_value, legend["cpu"].last_value) == (20.0, 30.0)
    summary = {(r.device_name, r.resource_name): r.total_windows for r in serving.validate_gold_summary(gold).collect()}
    assert summary[("d1", "cpu")] == 3
    assert serving.count_layers({"a": gold, "b": gold.limit(1)}).collect()[1].row_count == 1
    assert serving.avg_of_avgs(gold).first()[0] == 41.0
    assert serving.probe_count(gold, "d2").first().arrived
    assert not serving.probe_count(gold, "d9").first().arrived
    hours = serving.hourly_avg(gold, "cpu").collect()
    assert hours[0].hour == datetime.datetime(2024, 1, 1) and hours[0].avg_value == 38.75


def test_units_and_lists(spark):
    df = spark.sql("select 45123 t, 2097153 b, ' a, ,b ,, c' l")
    row = df.select(
        columns.celsius("t").alias("t"),
        columns.whole_megabytes("b").alias("m"),
        columns.whole_kilobytes("b").alias("k"),
        columns.comma_list("l").alias("l"),
    ).first()
    assert (row.t, row.m, row.k, row.l) == (45.12, 2, 2048, ["a", "b", "c"])
    assert columns.split_names(" a, ,b ") == ["a", "b"]


def test_round_half_up(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (2.5,), (None,)], "x double")
    got = [r[0] for r in df.select(columns.round_half_up("x", 2)).collect()]
    assert got == [0.13, -0.13, 2.5, None]

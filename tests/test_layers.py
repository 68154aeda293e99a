from __future__ import annotations

import json
import math

from helpers import NS, at, encoded, event, reading, records, rows
from pyspark.sql import functions as F

from tidemeter.functions import time as times
from tidemeter.operators import bronze, gold, incremental, silver
from tidemeter.schemas import NUMERIC_VALUE_TYPES




def test_bronze_one_row_per_reading(spark):
    many = event(id="many", readings=[reading(f"r{i}", "Float32", str(i)) for i in range(25)])
    made = bronze.bronze_readings(records(spark, [event(), many]), F.lit("b0"), at())
    assert made.filter("event_id = 'e1'").count() == 1
    assert made.filter("event_id = 'many'").count() == 25


def test_bronze_leaves_out_events_without_origin_or_readings(spark):
    values = [
        event(id="no-origin", origin=...),
        event(id="empty", readings=[]),
        event(id="null", readings=None),
        event(id="absent", readings=...),
        '{"id": "cut", "origin": 5, "readings": [{"va',
        "[1, 2]",
        "7",
        None,
        b"\xff\xfe",
        event(id="good"),
    ]
    made = bronze.bronze_readings(records(spark, values), F.lit("b0"), at())
    assert [r.event_id for r in made.collect()] == ["good"]


def test_bronze_synthesizes_ids(spark):
    made = bronze.bronze_readings(records(spark, [event(), event(id=...)]), F.lit("b0"), at())
    assert {r.event_id for r in made.collect()} == {"e1", "0-1-CPUUsage"}
    nameless = event(id=..., readings=[{"origin": NS, "value": "1"}])
    made = bronze.bronze_readings(records(spark, [nameless]), F.lit("b0"), at())
    assert made.first().event_id == "0-0"


def test_bronze_keeps_a_null_reading_of_an_event(spark):
    made = bronze.bronze_readings(records(spark, [event(readings=[None])]), F.lit("b0"), at())
    assert [(r.event_id, r.raw_value) for r in made.collect()] == [("e1", None)]


def test_event_bronze_keeps_everything(spark):
    values = [
        event(),
        event(id="two", readings=[reading("a", "String", "1"), reading("b", "String", "2")]),
        event(id="empty", readings=[]),
        event(id="no-origin", origin=...),
        "not json",
        None,
    ]
    made = bronze.bronze_events_first_reading(records(spark, values), F.lit("b0"), at())
    got = {r.event_id: (r.raw_value, r.event_origin is None) for r in made.collect()}
    assert got == {
        "e1": ("45.2", False),
        "two": ("1", False),
        "empty": (None, False),
        "no-origin": ("45.2", True),
        "0-4": (None, True),
        "0-5": (None, True),
    }


def test_times_are_cut_to_seconds_unless_precise(spark):
    origin = NS + 987_654_321
    df = spark.createDataFrame([(origin,), (None,)], "origin bigint").select(
        times.ns_to_timestamp("origin").alias("cut"),
        times.ns_to_timestamp("origin", precise=True).alias("exact"),
    )
    first, missing = df.collect()
    assert first.cut.microsecond == 0 and first.exact.microsecond == 987_654
    assert missing.cut is None and missing.exact is None


def test_windows_equal_sparks_own(spark):
    seconds = [0, 299, 300, 1799, 1800, -1, -300, -301, 1_700_000_123]
    df = spark.createDataFrame([(s,) for s in seconds], "s bigint").select(
        F.timestamp_seconds("s").alias("t")
    )
    both = df.select(
        times.five_min_window("t").alias("a"),
        F.window("t", "5 minutes").start.alias("b"),
        times.half_hour_window("t").alias("c"),
    )
    assert all(r.a == r.b for r in both.collect())
    halves = df.select(times.half_hour_window("t").alias("a"), F.window("t", "30 minutes").start.alias("b"))
    assert all(r.a == r.b for r in halves.collect())


def test_silver_numbers(spark):
    cases = [
        ("Float32", "CPUUsage", "45.2", 45.2),
        ("Int8", "x", "5", None),
        ("String", "x", "5", None),
        ("Float64", "x", "-", None),
        ("Float64", "x", "", None),
        ("Float64", "x", "1e3", 1000.0),
        ("Uint64", "x", "18446744073709551615", 1.8446744073709552e19),
        ("String", "cpu_data", '{"usage_user": 12.5}', 12.5),
        ("String", "mem_data", '{"used": 7}', 7.0),
        ("String", "net_data", '{"ip_inreceives": 3}', 3.0),
        ("String", "net_data", '{"bytes_recv": 4, "ip_inreceives": 3}', 4.0),
        ("String", "gpu_proc_data", '{"sm_util": "-"}', None),
        ("String", "cpu_data", "broken {", None),
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "t string, r string, v string")
    number = silver.silver_number(F.col("t"), F.col("r"), F.col("v"))
    assert [r[0] for r in df.select(number).collect()] == [c[3] for c in cases]


def test_silver_drops_nameless_and_valueless_readings(spark):
    values = [
        event(id="a", readings=[reading("x", "Float32", "1"), reading(None, "Float32", "1")]),
        event(id="b", readings=[reading("x", "Float32", None)]),
    ]
    made = silver.silver_readings(bronze.bronze_readings(records(spark, values), F.lit("b0"), at()), at())
    assert [r.event_id for r in made.collect()] == ["a"]


def test_silver_counts_nan(spark):
    df = spark.createDataFrame([("b", float("nan")), ("b", 1.0), ("b", None)], "batch_id string, metric_value_num double")
    assert rows(silver.not_a_number_count(df)) == [("b", 1, 3)]


def test_metric_map_rows(spark):
    payload = encoded("cpu_data", {"usage_user": 12.5, "host": "h", "state": "-", "n": None})
    values = [
        event(id="ok", readings=[reading("cpu_data", "String", payload)]),
        event(id="flat", readings=[reading("cpu_data", "String", '{"usage_user": 1}')]),
        event(id="scalar"),
        event(id="lines", readings=[reading("cpu_data", "String", '{"cpu_data": "a:1, b:2\\na:2"}')]),
        event(id="other", sourceName="mem_data", readings=[reading("x", "String", payload)]),
    ]
    made = silver.silver_metric_map(
        bronze.bronze_events_first_reading(records(spark, values), F.lit("b0"), at()), at()
    )
    got = {(r.event_id, r.metric_key): (r.metric_value, r.metric_value_num) for r in made.collect()}
    assert got == {
        ("ok", "usage_user"): ("12.5", 12.5),
        ("ok", "host"): ("h", None),
        ("ok", "state"): ("-", None),
        ("ok", "n"): (None, None),
    }


def silver_frame(spark, data):
    schema = (
        "event_id string, device_name string, profile_name string, resource_name string, "
        "event_time timestamp, metric_value string, metric_value_num double, value_type string, "
        "batch_id string, processed_at timestamp"
    )
    return spark.createDataFrame(data, schema)


def silver_row(resource, value, kind="String", seconds=0, batch="b0", device="d", number=None):
    import datetime

    at = None
    if seconds is not None:
        at = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc) + datetime.timedelta(seconds=seconds)
    return ("e", device, "p", resource, at, value, number, kind, batch, at)


def test_gold_modes(spark):
    mixed = '{"a": 1, "host": "h", "flag": true, "text": "3.5", "none": null, "deep": {"x": 1}}'
    df = silver_frame(spark, [silver_row("r", mixed)])
    per_field = {r.resource_name: r.metric_num for r in gold.gold_metrics(df).collect()}
    assert per_field == {"r_a": 1.0}
    assert gold.gold_metrics(df, "strict").count() == 0
    plain = silver_frame(spark, [silver_row("r", '{"a": 1, "b": 2.5, "none": null}')])
    for mode in ("per_field", "strict"):
        got = {r.resource_name: r.metric_num for r in gold.gold_metrics(plain, mode).collect()}
        assert got == {"r_a": 1.0, "r_b": 2.5}


def test_gold_key_named_value_keeps_the_resource_name(spark):
    df = silver_frame(spark, [silver_row("r", '{"value": 5}'), silver_row("s", "7", "Float32")])
    assert {r.resource_name for r in gold.gold_metrics(df).collect()} == {"r", "s"}


def test_gold_windows_batches_and_unknowns(spark):
    data = [
        silver_row("r", "1", "Float32", 0),
        silver_row("r", "3", "Float32", 299),
        silver_row("r", "10", "Float32", 300),
        silver_row("r", "5", "Float32", 10, batch="b1"),
        silver_row(None, "8", "Float32", None, device=None),
        silver_row("r", "not a number", "Float32", 0, batch="b2"),
    ]
    got = {
        (r.window_start.strftime("%F %T"), r.device_name, r.resource_name, r.batch_id): (
            r.sample_count,
            r.avg_value,
            r.min_value,
            r.max_value,
        )
        for r in gold.gold_readings(silver_frame(spark, data), at()).collect()
    }
    assert got == {
        ("2024-01-01 00:00:00", "d", "r", "b0"): (2, 2.0, 1.0, 3.0),
        ("2024-01-01 00:05:00", "d", "r", "b0"): (1, 10.0, 10.0, 10.0),
        ("2024-01-01 00:00:00", "d", "r", "b1"): (1, 5.0, 5.0, 5.0),
        ("2024-05-01 12:00:00", "unknown", "unknown", "b0"): (1, 8.0, 8.0, 8.0),
    }


def test_gold_events_half_hours(spark):
    df = spark.createDataFrame(
        [("d", "p", "s", 0, "k", 1.0, "b"), ("d", "p", "s", 1799, "k", 3.0, "b"),
         ("d", "p", "s", 1800, "k", 9.0, "b"), ("d", "p", "s", 1, "text", None, "b")],
        "device_name string, profile_name string, source_name string, s bigint, metric_key string, "
        "metric_value_num double, batch_id string",
    ).withColumn("event_time", F.timestamp_seconds("s"))
    got = sorted((r.sample_count, r.avg_value) for r in gold.gold_events(df, at()).collect())
    assert got == [(1, 9.0), (2, 2.0)]


def test_pending(spark):
    up = spark.createDataFrame([("a",), ("b",), ("b",)], "batch_id string")
    done = spark.createDataFrame([("a",)], "batch_id string")
    assert incremental.pending_batches(up, done).count() == 2
    assert incremental.has_pending(up, done)
    assert not incremental.has_pending(up, up)


def test_a_message_is_parsed_once(spark, tmp_path):
    path = str(tmp_path / "records")
    records(spark, [event(), event(id=...)]).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = bronze.bronze_readings(stored, F.lit("b0"), at())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert "Exchange" not in plan


def test_numeric_types():
    assert "Int8" not in NUMERIC_VALUE_TYPES and len(NUMERIC_VALUE_TYPES) == 9
    assert math.isfinite(json.loads("1e3"))


def test_round_half_up_of_large_values(spark):
    from tidemeter.functions.columns import round_half_up

    values = [1e17, -1e17, float("inf"), 2.345, -2.345, 0.5, None]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    found = [r[0] for r in frame.select(round_half_up("v", 2).alias("r")).collect()]
    assert found == [1e17, -1e17, float("inf"), 2.35, -2.35, 0.5, None]


def test_last_of_equal_times(spark):
    from tidemeter.operators import series

    rows = [("f", i % 7, i, f"t{i}", i % 2 == 0) for i in range(100)]
    frame = spark.createDataFrame(rows, "field string, kafka_partition int, kafka_offset bigint, value_str string, value_bool boolean")
    points = frame.withColumns({"ts": at(), "value_num": F.lit(1.0)})
    found = {tuple(series.last_per_series(points.repartition(n), ["field"]).first()) for n in (1, 3, 8)}
    assert len(found) == 1 and next(iter(found))[3:] == ("t97", False)

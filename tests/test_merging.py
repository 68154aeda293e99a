"""Stream windows, mergeable gold, merged points, recorded lines, whole batches and newest days."""

from __future__ import annotations

import datetime

import pytest
from helpers import at, event, reading, records, rows
from pyspark.sql import functions as F

from tidemeter.functions.keyvalue import decode_kv_lines
from tidemeter.operators import partials, serving
from tidemeter.operators.newest import newest_days, newest_rows
from tidemeter.schemas import POINTS, READING_GOLD
from tidemeter.sinks.kafka import write_records
from tidemeter.sinks.points import PointStore
from tidemeter.sources.kafka import records_stream
from tidemeter.streaming.windows import gold_stream, written_windows

SECOND = 1_000_000_000
NOON = 1_704_110_400 * SECOND  # 2024-01-01 12:00


def samples(*minutes_and_values):
    """Events of one reading each, at minutes after noon."""
    return [
        event(id=f"e{i}", origin=NOON + int(m * 60) * SECOND, readings=[reading("r", "Float32", str(v), NOON + int(m * 60) * SECOND)])
        for i, (m, v) in enumerate(minutes_and_values)
    ]


# -- windows over a stream --


def test_stream_closes_windows_once_and_drops_late_readings(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))

    def arrive(*points):
        write_records(records(spark, samples(*points)), path)
        stream = gold_stream(records_stream(spark, path), out, checkpoint, "10 minutes")
        stream.awaitTermination()
        return stream.lastProgress

    def closed():
        found = written_windows(spark, out).orderBy("window_start")
        return [(r.window_start.minute, r.sample_count, r.avg_value, r.min_value, r.max_value) for r in found.collect()]

    arrive((1, 10), (6, 1))
    assert closed() == []
    arrive((2, 20), (16, 5))  # the watermark is minute 6: the window from 0 to 5 is closed
    assert closed() == [(0, 2, 15.0, 10.0, 20.0)]
    arrive((3, 1000), (7, 3), (17, 5))  # minute 3 is late, minute 7 is in an open window
    assert closed() == [(0, 2, 15.0, 10.0, 20.0)]
    progress = arrive((40, 1))
    assert closed() == [(0, 2, 15.0, 10.0, 20.0), (5, 2, 2.0, 1.0, 3.0), (15, 2, 5.0, 5.0, 5.0)]
    # only the open window of minute 40 is kept
    assert [s["numRowsTotal"] for s in progress["stateOperators"]] == [1]


def test_stream_started_again_without_news_writes_nothing(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    write_records(records(spark, [*samples((1, 1), (30, 2)), "broken", None]), path)
    for _ in range(3):
        gold_stream(records_stream(spark, path), out, checkpoint).awaitTermination()
    assert written_windows(spark, out).count() == 1


# -- mergeable gold --


def gold_rows(spark, found):
    schema = "window_start timestamp, device_name string, profile_name string, resource_name string, sample_count bigint, avg_value double, min_value double, max_value double, batch_id string"
    start = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame([(start, "d", "p", *row) for row in found], schema)


def test_gold_merged_weighs_means_by_counts(spark):
    gold = gold_rows(spark, [("cpu", 1, 10.0, 10.0, 10.0, "a"), ("cpu", 3, 2.0, 1.0, 3.0, "b"), ("mem", 2, 5.0, 5.0, 5.0, "a")])
    found = {r.resource_name: (r.sample_count, r.avg_value, r.min_value, r.max_value) for r in partials.gold_merged(gold).collect()}
    assert found == {"cpu": (4, 4.0, 1.0, 10.0), "mem": (2, 5.0, 5.0, 5.0)}


def test_partials_merge_in_any_grouping(spark):
    made = spark.createDataFrame(
        [(datetime.datetime(2024, 1, 1, 0, i % 7), "d", None, "r", f"b{i % 5}", float(i)) for i in range(100)]
        + [(datetime.datetime(2024, 1, 1), "d", None, "r", "b0", None), (None, "d", "p", "r", "b0", 1.0)],
        "event_time timestamp, device_name string, profile_name string, resource_name string, batch_id string, v double",
    )
    each = partials.gold_partials(made, "v", ["device_name", "profile_name", "resource_name"])
    whole = partials.merge_partials(each)
    halves = [partials.merge_partials(each.where(f"batch_id {op} 'b2'")) for op in ("<", ">=")]
    again = partials.merge_partials(halves[0].unionByName(halves[1]))
    assert sorted(rows(partials.finished(again)), key=str) == sorted(rows(partials.finished(whole)), key=str)
    assert {(r.sample_count, r.profile_name) for r in whole.collect()} == {(72, "unknown"), (28, "unknown"), (1, "p")}
    assert "SortAggregate" not in whole._jdf.queryExecution().executedPlan().toString()


# -- merged points --


def points(spark, found):
    """Rows of (device, second, field, value, offset)."""
    start = datetime.datetime(2024, 1, 1)
    made = [
        ("m", "s", device, None, "t", 0, offset, start + datetime.timedelta(seconds=second), field, value, None, None)
        for device, second, field, value, offset in found
    ]
    schema = "measurement string, source_name string, device_name string, profile_name string, topic string, kafka_partition int, kafka_offset bigint, ts timestamp, field string, value_num double, value_str string, value_bool boolean"
    return spark.createDataFrame(made, schema)


def held(store):
    return sorted(((r.device_name or "", r.ts.day, r.field, r.value_num) for r in store.points().collect()))


def test_later_offset_wins_in_whatever_batch(spark, store):
    kept = PointStore(store)
    kept.write(points(spark, [("d", 0, "f", 2.0, 7), ("d", 0, "g", 1.0, 1), (None, 0, "f", 4.0, 1)]), "b1")
    kept.write(points(spark, [("d", 0, "f", 1.0, 3), (None, 0, "f", 5.0, 2), ("d", 90_000, "f", 9.0, 1)]), "b2")
    expected = [("", 1, "f", 5.0), ("d", 1, "f", 2.0), ("d", 1, "g", 1.0), ("d", 2, "f", 9.0)]
    assert held(kept) == expected
    assert kept.compact(datetime.date(2024, 1, 3)) == 2
    assert held(kept) == expected
    batches = store.scan(POINTS.name).groupBy("event_date").agg(F.count_distinct("batch_id").alias("n")).collect()
    assert {r.n for r in batches} == {1} and kept.compact(datetime.date(2024, 1, 3)) == 0
    kept.write(points(spark, [("d", 0, "f", 6.0, 5), ("d", 0, "g", 8.0, 2)]), "b3")  # late: one point older, one newer
    assert held(kept) == [("", 1, "f", 5.0), ("d", 1, "f", 2.0), ("d", 1, "g", 8.0), ("d", 2, "f", 9.0)]
    with pytest.raises(ValueError):
        kept.write(points(spark, []), "compacted-x")


def test_compaction_that_dies_before_the_drop_changes_nothing(spark, store, monkeypatch):
    kept = PointStore(store)
    kept.write(points(spark, [("d", 0, "f", 1.0, 1)]), "b1")
    kept.write(points(spark, [("d", 0, "f", 2.0, 2)]), "b2")
    with monkeypatch.context() as patched:
        patched.setattr(store, "drop_partitions", lambda spec, parts: (_ for _ in ()).throw(RuntimeError()) if parts else None)
        with pytest.raises(RuntimeError):
            kept.compact(datetime.date(2024, 1, 2))
    assert held(kept) == [("d", 1, "f", 2.0)] and store.scan(POINTS.name).count() == 3
    kept.compact(datetime.date(2024, 1, 2))
    assert held(kept) == [("d", 1, "f", 2.0)] and store.scan(POINTS.name).count() == 1


# -- whole batches --


def test_batch_written_on_both_sides_of_midnight_is_found_once(spark, store):
    store.ensure([POINTS])
    for second in (86_390, 86_410, 86_410):  # a replay with a processing time after midnight
        made = points(spark, [("d", second, "f", 1.0, 1), ("d", second, "g", 1.0, 1)]).withColumn("batch_id", F.lit("it's 1/2 = 50%+"))
        store.overwrite_batches(made, POINTS, ["it's 1/2 = 50%+"])
    store.overwrite_batches(points(spark, [("d", 0, "f", 1.0, 1)]).withColumn("batch_id", F.lit("other")), POINTS, ["other"])
    assert [r.event_date.day for r in store.scan(POINTS.name).where("batch_id <> 'other'").collect()] == [2, 2]
    assert store.scan(POINTS.name).count() == 3
    store.overwrite_batches(points(spark, []).withColumn("batch_id", F.lit("other")), POINTS, ["other"])
    assert store.scan(POINTS.name).where("batch_id = 'other'").count() == 0


def test_files_follow_partitions(spark, store):
    store.ensure([POINTS])
    many = points(spark, [("d", 3600 * i, "f", float(i), i) for i in range(96)]).withColumn("batch_id", F.lit("b"))
    store.overwrite_batches(many.repartition(16), POINTS, ["b"])
    assert len(store.scan(POINTS.name).inputFiles()) == 4


def test_many_days_expire_in_as_many_jobs_as_few(spark, store):
    store.ensure([POINTS])
    many = points(spark, [("d", 86_400 * i, "f", 1.0, i) for i in range(60)]).withColumn("batch_id", F.lit("b"))
    store.append(many, POINTS)
    jobs = []
    for before in (datetime.date(2024, 1, 3), datetime.date(2024, 2, 20)):
        spark.sparkContext.setJobGroup(str(before), "expire")
        expired = store.expire(POINTS, before)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(before))))
        assert expired[-1] < str(before)
    assert jobs[0] == jobs[1]
    assert store.scan(POINTS.name).agg(F.min("ts"), F.count(F.lit(1))).first() == (datetime.datetime(2024, 2, 20), 10)
    assert store.expire(POINTS, datetime.date(2024, 1, 1)) == []


# -- newest days --


def test_newest_rows_read_the_newest_days_only(spark, store):
    store.ensure([READING_GOLD])
    days = spark.range(400).select(
        (F.lit("2023-01-01").cast("timestamp") + F.make_dt_interval(days=F.col("id").cast("int"))).alias("window_start"),
        F.when(F.col("id") % 100 == 7, "rare").otherwise("d").alias("device_name"),
        F.lit("p").alias("profile_name"),
        F.lit("cpu").alias("resource_name"),
        F.lit(1).alias("sample_count"),
        *[F.col("id").cast("double").alias(c) for c in ("avg_value", "min_value", "max_value")],
        F.lit("b0").alias("batch_id"),
        at().alias("generated_at"),
    )
    store.append(days, READING_GOLD)
    assert len(newest_days(store, READING_GOLD, 1).inputFiles()) == 1
    assert len(newest_days(store, READING_GOLD, 3).inputFiles()) == 4
    top = serving.stored_newest_gold(store, 10)
    assert [r.avg_value for r in top.collect()] == [399.0 - i for i in range(10)]
    assert len(top.inputFiles()) == 16
    assert serving.stored_latest_metric(store, "cpu", "rare").first().avg_value == 307.0
    assert [r.avg_value for r in serving.stored_newest_gold(store, 50, "rare").collect()] == [307.0, 207.0, 107.0, 7.0]
    assert newest_rows(store, READING_GOLD, 5, [], F.col("device_name") == "none").count() == 0


def test_newest_rows_of_an_empty_table(spark, store):
    store.ensure([READING_GOLD])
    assert serving.stored_newest_gold(store, 10).count() == 0


# -- recorded lines --


def test_kv_lines(spark):
    texts = [
        "cpu:total, usage:1.5, cpu:one, at:12:30:00, name:a, b, c\n\nx: 7 , :8, none, y:-\r\nz:",
        "",
        None,
        "no entries at all",
        "k:v:w, k:2, k:3",
    ]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, key string")
    found = decode_kv_lines(frame.withColumnRenamed("key", "text"), F.col("text")).drop("text").orderBy("id", "line_number", "position")
    assert [tuple(r) for r in found.collect()] == [
        (0, 0, 0, "cpu", "one", None),
        (0, 0, 1, "usage", "1.5", 1.5),
        (0, 0, 2, "at", "12:30:00", None),
        (0, 0, 3, "name", "a, b, c", None),
        (0, 2, 0, "x", "7", 7.0),
        (0, 2, 1, "y", "-", None),
        (0, 3, 0, "z", "", None),
        (4, 0, 0, "k", "3", 3.0),
    ]


# -- bounded micro-batches --


def test_micro_batches_bounded_by_bytes(spark, tmp_path):
    path = str(tmp_path / "in")
    write_records(records(spark, samples((1, 1), (2, 2), (3, 3))), path, files=3)
    seen = []
    stream = records_stream(spark, path, max_bytes=1)
    query = stream.writeStream.foreachBatch(lambda batch, epoch: seen.append(batch.count())).trigger(availableNow=True)
    query.option("checkpointLocation", str(tmp_path / "cp")).start().awaitTermination()
    assert sum(seen) == 3 and len(seen) > 1


def test_keys_of_short_and_long_lines_are_settled_alike(spark):
    from tidemeter.functions import keyvalue

    texts = ["a:1, b:2, a:3, :x, none, c:, b:4", "", "a:x, y, a:10:20", ", ".join(f"k{i % 50}:{i}" for i in range(120))]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, line string")
    entry = F.transform(
        F.split("line", keyvalue.ITEM_END),
        lambda item, at: F.struct(F.substring_index(item, ":", 1).alias("key"), item.alias("value"), at.alias("pos")),
    )
    both = frame.select(keyvalue._looked_up(entry).alias("found"), keyvalue._sorted(entry).alias("settled"))
    assert all(row.found == row.settled and row.found for row in both.collect())
    whole = frame.select(keyvalue.line_entries(F.col("line")).alias("e"), "id").orderBy("id").collect()
    assert [(e.key, e.value) for e in whole[0].e] == [("a", "3"), ("b", "4"), ("c", "")]
    assert [(e.key, e.value) for e in whole[3].e] == [(f"k{i}", str(100 + i if i < 20 else 50 + i)) for i in range(50)]

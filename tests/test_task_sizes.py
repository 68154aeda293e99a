"""Larger inputs make more tasks, not larger ones."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemeter import session
from tidemeter.schemas import POINTS, READING_GOLD
from tidemeter.sinks import kafka, tables
from tidemeter.sources.kafka import records_bounded
from tidemeter.workloads import collecting, inputs


def point_rows(spark, n: int, parts: int):
    """Points of one day and batch with texts that do not compress."""
    plain = {f.name: F.lit(None).cast(f.dataType) for f in POINTS.schema if f.name != "event_date"}
    made = plain | {
        "kafka_offset": F.col("id"),
        "ts": F.timestamp_seconds(F.lit(1_704_067_200)),
        "value_str": F.sha2(F.col("id").cast("string"), 512),
        "batch_id": F.lit("a"),
    }
    return spark.range(0, n, 1, parts).select(*[c.alias(name) for name, c in made.items()])


def test_a_large_partition_is_written_by_many_tasks(spark, store, monkeypatch):
    monkeypatch.setattr(tables, "WRITE_BYTES", 256 * 1024)
    before = spark.conf.get(tables.WRITE_SIZE)
    store.ensure([POINTS])
    assert store.overwrite_batches(point_rows(spark, 20_000, 16), POINTS, ["a"]) == 20_000
    assert len(store.scan(POINTS.name).inputFiles()) >= 4
    assert store.scan(POINTS.name).agg(F.count_distinct("kafka_offset")).first()[0] == 20_000
    assert spark.conf.get(tables.WRITE_SIZE) == before


def test_appended_batches_have_a_file_each(spark, store):
    store.ensure([READING_GOLD])
    gold = spark.range(0, 4000, 1, 8).select(
        F.timestamp_seconds(F.lit(1_704_067_200)).alias("window_start"),
        *[F.lit("x").alias(c) for c in ("device_name", "profile_name", "resource_name")],
        F.col("id").alias("sample_count"),
        *[F.lit(0.0).alias(c) for c in ("avg_value", "min_value", "max_value")],
        F.concat(F.lit("batch-"), F.col("id") % 10).alias("batch_id"),
        F.timestamp_seconds(F.lit(1_704_067_200)).alias("generated_at"),
    )
    assert store.append(gold, READING_GOLD) == 4000
    assert len(store.scan(READING_GOLD.name).inputFiles()) == 10
    assert rows(store.scan(READING_GOLD.name).agg(F.sum("sample_count"))) == [(4000 * 3999 // 2,)]


def test_stored_records_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(kafka, "RECORD_GROUP_BYTES", 256 * 1024)
    monkeypatch.setattr(session, "READ_BYTES", 1024 * 1024)
    value = F.sha2(F.col("id").cast("string"), 512)
    made = kafka.kafka_records(
        spark.range(0, 60_000, 1, 4), value, "t", F.lit(0), F.col("id"), F.timestamp_seconds("id")
    )
    before = spark.conf.get(session.READ_SETTING)
    try:
        spark.conf.set(session.READ_SETTING, str(128 * 1024 * 1024))
        back = records_bounded(spark, kafka.write_records(made, f"{tmp_path}/t", 1))
        counts = [n for (n,) in rows(back.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1))).drop("SPARK_PARTITION_ID()"))]
    finally:
        spark.conf.set(session.READ_SETTING, before)
    assert len(counts) >= 3 and sum(counts) == 60_000 and max(counts) < 40_000


@pytest.mark.parametrize(("limit", "tasks"), [(1000, 1), (100, 10), (30, 34)])
def test_messages_are_made_by_tasks_in_number_of_the_rows(spark, monkeypatch, limit, tasks):
    monkeypatch.setattr(inputs, "ROWS_PER_TASK", limit)
    dealt = inputs.spread(spark.range(0, 1000, 1, 1), "id")
    assert dealt.rdd.getNumPartitions() == tasks
    assert dealt.agg(F.sum("id")).first()[0] == 1000 * 999 // 2


def test_collector_batches_are_made_by_tasks_in_number_of_the_items(spark, monkeypatch):
    monkeypatch.setattr(inputs, "ROWS_PER_TASK", 500)
    made = collecting.batches(spark, "/root/testdata/sf0.001")
    assert made.rdd.getNumPartitions() == 12
    assert made.count() == 6000

from __future__ import annotations

from hashlib import sha256

import datetime

import pytest
from helpers import at, encoded, event, reading, records
from pyspark.sql import functions as F

from tidemeter.plans import datasets, medallion
from tidemeter.schemas import (
    EVENT_LAYERS,
    POINTS,
    READING_BRONZE,
    READING_GOLD,
    READING_LAYERS,
    READING_SILVER,
    TableSpec,
)
from tidemeter.sinks import exports
from tidemeter.sinks.kafka import kafka_records, kafka_values, write_records
from tidemeter.sinks.tables import TableStore
from tidemeter.sources import files
from tidemeter.sources.kafka import (
    kafka_bounded,
    kafka_options,
    records_bounded,
    records_stream,
)
from tidemeter.streaming import jobs


def some_events(start: int, n: int) -> list[dict]:
    return [event(id=f"e{i}", readings=[reading("r", "Float32", str(i))]) for i in range(start, start + n)]


def test_medallion_second_run_adds_nothing(spark, store, tmp_path):
    path, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    write_records(records(spark, some_events(0, 5)), path)
    for _ in range(2):
        medallion.run_readings_medallion(records_stream(spark, path), store, checkpoint)
    assert store.scan("reading_bronze").count() == 5
    assert store.scan("reading_silver").count() == 5
    assert store.scan("reading_gold").agg(F.sum("sample_count")).first()[0] == 5
    write_records(records(spark, some_events(5, 3)), path)
    summary = medallion.run_readings_medallion(records_stream(spark, path), store, checkpoint)
    assert store.scan("reading_bronze").count() == 8
    # the same window in two batches gives two gold rows
    assert summary.first().total_windows == 2


def test_replayed_micro_batch_leaves_the_same_rows(spark, store, tmp_path):
    path = str(tmp_path / "in")
    write_records(records(spark, some_events(0, 4)), path)
    for attempt in range(2):  # a lost checkpoint makes the stream start over
        stream = records_stream(spark, path)
        jobs.bronze_stream_readings(stream, store, str(tmp_path / f"cp{attempt}")).awaitTermination()
    assert store.scan("reading_bronze").count() == 4
    assert store.committed_batches("reading_bronze").count() == 1


def test_batch_without_rows_is_not_read_again(spark, store):
    store.ensure(READING_LAYERS)
    nameless = [event(readings=[reading(None, "Float32", "1")])]
    from tidemeter.operators.bronze import bronze_readings

    made = bronze_readings(records(spark, nameless), F.lit("b0"), at())
    store.overwrite_batches(made, READING_BRONZE, ["b0"])
    first, _ = medallion.refine_readings(store, at())
    again, _ = medallion.refine_readings(store, at())
    assert (first.batches, first.rows, again.batches) == (1, 0, 0)


def test_part_written_batch_is_done_again(spark, store):
    store.ensure(READING_LAYERS)
    from tidemeter.operators.bronze import bronze_readings
    from tidemeter.operators.silver import silver_readings

    made = bronze_readings(records(spark, some_events(0, 4)), F.lit("b0"), at())
    store.overwrite_batches(made, READING_BRONZE, ["b0"])
    # rows are there, the commit is not: the job died in between
    store._insert(silver_readings(made, at()).limit(2), READING_SILVER, overwrite=True)
    medallion.refine_readings(store, at())
    assert store.scan("reading_silver").count() == 4


def test_many_batches_are_processed_in_slices(spark, store):
    store.ensure(READING_LAYERS)
    from tidemeter.operators.bronze import bronze_readings
    from tidemeter.operators.silver import silver_readings

    batch = F.concat(F.lit("b"), F.col("kafka_offset"))
    made = bronze_readings(records(spark, some_events(0, 5)), batch, at())
    store.overwrite_batches(made, READING_BRONZE, [f"b{i}" for i in range(5)])
    report = medallion.refine(
        store, READING_BRONZE, READING_SILVER, lambda df: silver_readings(df, at()), batches_per_job=2
    )
    assert (report.batches, report.rows) == (5, 5)


def test_refine_reads_only_pending_partitions(spark, store):
    store.ensure(READING_LAYERS)
    from tidemeter.operators.bronze import bronze_readings

    for name in ("b0", "b1"):
        made = bronze_readings(records(spark, some_events(0, 2)), F.lit(name), at())
        store.overwrite_batches(made, READING_BRONZE, [name])
    source = store.scan("reading_bronze").filter(F.col("batch_id").isin("b1"))
    assert len(source.inputFiles()) < len(store.scan("reading_bronze").inputFiles())


def test_trend_reads_only_recent_days(spark, store):
    from tidemeter.operators.serving import trend_metric

    store.ensure([READING_GOLD])
    days = spark.range(10).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(days=F.col("id").cast("int"))).alias(
            "window_start"
        ),
        F.lit("d").alias("device_name"),
        F.lit("p").alias("profile_name"),
        F.lit("cpu").alias("resource_name"),
        F.lit(1).alias("sample_count"),
        *[F.lit(1.0).alias(c) for c in ("avg_value", "min_value", "max_value")],
        F.lit("b0").alias("batch_id"),
        at().alias("generated_at"),
    )
    store.append(days, READING_GOLD)
    gold = store.scan("reading_gold")
    recent = trend_metric(gold, "cpu", F.lit("2024-01-10 01:00:00").cast("timestamp"))
    assert recent.count() == 1
    assert len(recent.inputFiles()) == 1 and len(gold.inputFiles()) == 10


def test_event_flow(spark, store, tmp_path):
    path = str(tmp_path / "in")
    values = [
        event(id=f"e{i}", readings=[reading("cpu_data", "String", encoded("cpu_data", {"u": i, "host": "h"}))])
        for i in range(3)
    ]
    write_records(records(spark, [*values, "broken", None]), path)
    count = medallion.run_events_medallion(records_stream(spark, path), store, str(tmp_path / "cp"))
    assert count.first().row_count == 1
    assert store.scan("event_bronze").count() == 5
    gold = store.scan("event_gold").first()
    assert (gold.metric_key, gold.sample_count, gold.avg_value) == ("u", 3, 1.0)
    assert {spec.name for spec in EVENT_LAYERS} == {"event_bronze", "event_silver", "event_gold"}


def test_tables_survive_a_new_catalog_entry(spark, store):
    from tidemeter.operators.bronze import bronze_readings

    store.ensure([READING_BRONZE])
    made = bronze_readings(records(spark, some_events(0, 4)), F.lit("b0"), at())
    store.overwrite_batches(made, READING_BRONZE, ["b0"])
    for name in ("reading_bronze", "commits"):
        spark.sql(f"DROP TABLE {store.full_name(name)}")
    store.ensure([READING_BRONZE])
    assert store.scan("reading_bronze").count() == 4
    assert store.committed_batches("reading_bronze").count() == 1


def test_truncate_and_fill_again(spark, store):
    from tidemeter.operators.bronze import bronze_readings

    store.ensure([READING_BRONZE])
    made = bronze_readings(records(spark, some_events(0, 4)), F.lit("b0"), at())
    store.overwrite_batches(made, READING_BRONZE, ["b0"])
    outcome = store.truncate([TableSpec("missing", "a INT", None, ()), READING_BRONZE])
    assert outcome["missing"] is not None and outcome["reading_bronze"] is None
    assert store.scan("reading_bronze").count() == 0
    assert store.committed_batches("reading_bronze").count() == 0
    store.overwrite_batches(made, READING_BRONZE, ["b0"])
    assert store.scan("reading_bronze").count() == 4


def test_points_stream_and_retention(spark, store, tmp_path):
    path = str(tmp_path / "in")
    write_records(records(spark, [event(readings=[reading("r", "String", '{"a": 1}')]), "bad"]), path)
    stored = datasets.run_realtime_points(
        records_stream(spark, path), store, str(tmp_path / "cp"), processed_at=at()
    )
    assert {r.field for r in stored.collect()} == {"a", "meta_id"}
    assert store.expire(POINTS, datetime.date(2024, 5, 1)) == []
    assert store.scan("points").count() == 2
    assert store.expire(POINTS, datetime.date(2024, 5, 2)) == ["2024-05-01"]
    assert store.scan("points").count() == 0


def test_dead_letters(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_records(records(spark, [event(), "bad", b"\xff"]), path)
    jobs.dead_letter_stream(records_stream(spark, path), out, str(tmp_path / "cp")).awaitTermination()
    split = {r.status: r["count"] for r in spark.read.parquet(out).groupBy("status").count().collect()}
    assert split == {"valid": 1, "invalid": 2}


def test_append_replace_history(spark, store):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    assert store.replace(df, "products").count() == 2
    assert store.replace(df.limit(1), "products").count() == 1
    store.ensure([READING_GOLD])
    assert store.describe("reading_gold").count() > 0
    assert store.history("reading_gold").count() == 0


def test_preview(spark, store):
    store.ensure([READING_GOLD])
    assert exports.preview_table(store, "nothing").status == "not found"
    assert exports.preview_table(store, "reading_gold").status == "empty"
    store.replace(spark.range(30).toDF("id"), "numbers")
    preview = exports.preview_table(store, "numbers")
    assert (preview.status, preview.rows, preview.sample.count()) == ("ok", 30, 20)


def test_csv_export(spark, tmp_path):
    texts = [None, "", "two\nlines", 'a "quoted", text', "\\N no null", "back\\slash", " spaces "]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, note string").repartition(4)
    exports.export_csv(df, str(tmp_path / "notes.csv"))
    back = files.csv_asset(spark, str(tmp_path), "notes", df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(enumerate(texts))


def test_kafka_options():
    options = kafka_options(" a:1 , ,b:2", "t1, t2 ,,", "latest", 50_000, 64)
    assert options == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "t1,t2",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "50000",
        "minPartitions": "64",
    }


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        kafka_bounded(spark, "localhost:1", "t")


def test_bounded_twin(spark, tmp_path):
    df = spark.range(10).withColumn("name", F.lit("x"))
    values = kafka_values(df, F.col("id"))
    made = kafka_records(
        values, F.col("value"), "t", F.lit(0), F.monotonically_increasing_id(), at(), F.col("key")
    )
    path = write_records(made, str(tmp_path / "topic"))
    assert records_bounded(spark, path, "t").count() == 10
    assert records_bounded(spark, path, "u").count() == 0
    assert records_bounded(spark, path + "-missing").count() == 0


def test_landing(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("x\n1\n")
    (source / "b.json").write_text('{"x": 1}')
    for text in ("x\n1\n", "x\n2\n"):
        (source / "a.csv").write_text(text)
        landed = files.land_raw_files(spark, f"{source}/*", str(tmp_path), "sales", "HTTPS").collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in landed) == ["a.csv", "b.json"]
    folder = tmp_path / "raw" / "sales"
    assert (folder / "a.csv").read_text() == "x\n2\n"
    assert sorted(p.name for p in folder.iterdir() if not p.name.endswith(".crc")) == ["a.csv", "b.json"]
    assert files.land_raw_files(spark, f"{source}/*", str(tmp_path), "sales", "OTHER").count() == 0
    assert files.landing_path("/root/", "d", "https://host/x/y.csv") == "/root/raw/d/y.csv"


def test_landing_keeps_files_of_equal_names(spark, tmp_path):
    for folder, text in (("a", "x\n1\n"), ("b", "x\n2\n"), ("b/deep", "x\n3\n")):
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / "same.csv").write_text(text)
    landed = files.land_raw_files(spark, f"{tmp_path}/in/*/*.csv", str(tmp_path), "sales").collect()
    root = tmp_path / "raw" / "sales"
    assert sorted(r.path for r in landed) == [f"{root}/a/same.csv", f"{root}/b/same.csv"]
    assert [(root / name / "same.csv").read_text() for name in "ab"] == ["x\n1\n", "x\n2\n"]
    assert {r.sha256 for r in landed} == {sha256(t.encode()).hexdigest() for t in ("x\n1\n", "x\n2\n")}
    for source in (f"{tmp_path}/in/b/deep/same.csv", f"{tmp_path}/in/b/deep"):
        one = files.land_raw_files(spark, source, str(tmp_path), "one").collect()
        assert [(r.path, r.bytes) for r in one] == [(f"{tmp_path}/raw/one/same.csv", 4)]


def test_shared_dir_is_required_on_a_cluster(monkeypatch):
    from tidemeter import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Fake:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError):
        session.shared_dir(Fake())


def test_store_paths(spark):
    store = TableStore(spark, "/data/", "ns")
    assert store.path("t") == "/data/ns/t"

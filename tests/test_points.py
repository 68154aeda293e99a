from __future__ import annotations

import json
import random

import pytest
from helpers import at, encoded, event, reading, records, rows
from pyspark.sql import functions as F

from tidemeter.functions import payload
from tidemeter.operators import points, series


def fields(spark, *events, keep_scalars=False):
    """{field: value} of all points."""
    made = points.points_from_records(records(spark, list(events)), at(), keep_scalars)
    return {
        r.field: next((v for v in (r.value_num, r.value_str, r.value_bool) if v is not None), None)
        for r in made.collect()
    }


def reference_fields(doc: dict) -> dict:
    """What a point must hold, by plain Python."""
    merged = {}
    for item in doc.get("readings") or []:
        value = item.get("value")
        if not isinstance(value, str):
            continue
        try:
            outer = json.loads(value)
        except ValueError:
            continue
        if not isinstance(outer, dict):
            continue
        flat = {}
        for key, member in outer.items():
            inner = None
            if isinstance(member, str):
                try:
                    inner = json.loads(member)
                except ValueError:
                    pass
            if isinstance(inner, dict):
                flat.update(inner)
            else:
                flat[key] = member
        merged.update(flat)
    result = {}
    for key, value in merged.items():
        if isinstance(value, bool):
            result[key] = value
        elif isinstance(value, (int, float)):
            result[key] = float(value)
        elif isinstance(value, str):
            result[f"{key}_str"] = value
    if isinstance(doc.get("id"), str):
        result["meta_id"] = doc["id"]
    return result


PAYLOADS = [
    [encoded("cpu_data", {"usage_user": 12.5, "host": "h", "ok": True, "none": None})],
    ['{"a": 1, "b": "5", "c": "{\\"d\\": 2}", "e": "[1]", "f": [1], "g": {"x": 1}}'],
    ['{"a": 1, "a": "x"}'],
    ['{"a": "x", "a": null, "b": 2}'],
    ['{"a": 1, "c": "{\\"a\\": 9}"}'],
    ['{"c": "{\\"a\\": 9}", "a": 1}'],
    ['{"a": 1, "b": 1}', '{"a": "later"}', '{"b": null}'],
    ['{"n": 1e3, "big": 18446744073709551615, "neg": -0.5, "zero": 0}'],
    ["45.2", "[1]", "{broken", "", "null", '{"a": 1} trailing'],
    ['{"load": "cpu:1, host:h\\ncpu:2"}'],
    [" \n\t{\"spaced\": true} "],
    ["{'a': 1}"],
    ["{}"],
    ['{"c": "  {\\"d\\": 2}  ", "e": "{broken"}'],
    ['{"a": 1}]', '{"a": 1}]}', '{"a": 1}] x', '{"a": 1},{"b": 2}', '{"a": 1},{"seal": "1"}]', '{"a": 1},"seal": 1}'],
    ['{"c": "{\\"d\\": 2}] x", "seal": "s"}'],
]


@pytest.mark.parametrize("values", PAYLOADS)
def test_points_equal_plain_python(spark, values):
    doc = event(readings=[reading("r", "String", v) for v in values])
    assert fields(spark, doc) == reference_fields(doc)


KEYS = ["a", "b", "c", "a_str", "b_str", "meta_id", "long key", ""]
LEAVES = [0, 1, -2.5, 1e300, True, False, None, "text", "5", "true", "null", "[1]", "{bad", [1, 2], {"x": 1}, {}]


def random_object(rng, depth: int) -> str:
    """JSON text of an object whose keys may repeat."""
    members = []
    for _ in range(rng.randrange(6)):
        value = json.dumps(rng.choice(LEAVES))
        if depth and rng.random() < 0.4:
            value = json.dumps(random_object(rng, depth - 1))
        members.append(f"{json.dumps(rng.choice(KEYS))}: {value}")
    return "{" + ", ".join(members) + "}"


def test_random_events_equal_plain_python(spark):
    rng = random.Random(11)
    docs = []
    for i in range(400):
        texts = [random_object(rng, 1) for _ in range(rng.randrange(4))]
        docs.append(event(id=f"e{i}", readings=[reading("r", "String", t) for t in texts]))
    made = points.points_from_records(records(spark, docs), at())
    got = {i: {} for i in range(len(docs))}
    for r in made.collect():
        assert r.field not in got[r.kafka_offset]
        got[r.kafka_offset][r.field] = next(
            v for v in (r.value_num, r.value_str, r.value_bool) if v is not None
        )
    assert got == {i: reference_fields(doc) for i, doc in enumerate(docs)}


def test_field_name_clash_gives_one_field(spark):
    doc = event(readings=[reading("r", "String", '{"a": "text", "a_str": 5}')])
    made = points.points_from_records(records(spark, [doc]), at()).filter("field = 'a_str'")
    assert [(r.value_num, r.value_str) for r in made.collect()] == [(5.0, None)]
    # the key keeps its first place, so the text comes later
    doc = event(readings=[reading("r", "String", '{"a_str": 5, "a": "text", "a_str": 7}')])
    assert fields(spark, doc) == {"a_str": "text", "meta_id": "e1"}
    doc = event(readings=[reading("r", "String", '{"meta_id": 5}')])
    assert fields(spark, doc) == {"meta_id": "e1"}


def test_readings_without_value_are_skipped(spark):
    minimal = {"sourceName": "load", "deviceName": "gen", "readings": [{"value": '{"val": 0}'}]}
    assert fields(spark, minimal) == {"val": 0.0}
    odd = event(readings=[{"resourceName": "r"}, 7, None, {"value": 3}, {"value": '{"a": 1}'}])
    assert fields(spark, odd) == {"a": 1.0, "meta_id": "e1"}


def test_scalars_are_kept_on_request(spark):
    doc = event(readings=[reading("CPUUsage", "Float32", "45.2"), reading("x", "String", '{"a": 1}')])
    assert fields(spark, doc) == {"a": 1.0, "meta_id": "e1"}
    kept = fields(spark, doc, keep_scalars=True)
    assert kept == {"CPUUsage": 45.2, "a": 1.0, "meta_id": "e1"}


def test_tags(spark):
    doc = {"sourceName": None, "deviceName": 5, "readings": [{"value": '{"a": 1}'}]}
    row = points.points_from_records(records(spark, [doc]), at()).first()
    assert (row.source_name, row.device_name, row.profile_name) == ("None", "5", "unknown")
    assert (row.topic, row.kafka_partition, row.kafka_offset) == ("metrics", 0, 0)


def test_repeated_top_level_key_counts_once(spark):
    text = '{"id": "first", "id": "last", "deviceName": "a", "deviceName": "b", "readings": []}'
    made = points.points_from_records(records(spark, [text]), at()).collect()
    assert [(r.field, r.value_str, r.device_name) for r in made] == [("meta_id", "last", "b")]


def test_invalid_messages_are_dropped(spark):
    values = [event(), "{cut", "[1]", "7", "null", None, b"\xff\xfe{}", '{"a": 1} x', '{"a": 1}{"b": 2}']
    values += ['{"a":1}]', '{"a":1}]}', '{"a":1}] x', "[1]] x", '{"a":1},"end":1}', '{"a":1},{"seal":"1"}]']
    valid = points.valid_events(records(spark, values))
    assert [r.offset for r in valid.collect()] == [0]
    marked = points.dead_letter_status(points.parse_records(records(spark, values)))
    assert {r.status: r["count"] for r in marked.groupBy("status").count().collect()} == {
        "valid": 1,
        "invalid": 14,
    }


def test_annotations(spark):
    events = points.valid_events(records(spark, [event(), event(sourceName=...)]))
    notes = points.annotation_records(events, at())
    assert [r.text for r in notes.collect()] == [
        "source=cpu_data device=node-1",
        "source=unknown device=node-1",
    ]
    assert notes.first().tags == ["kafka", "cpu_data"]
    assert points.annotation_records(events, at(), enabled=False).count() == 0


def test_documents_are_stamped(spark):
    text = '{"id": "x", "_ingested_at": "old", "id": "y"}'
    doc = json.loads(points.documents(records(spark, [text, "bad"]), at()).first().document)
    assert doc == {"id": "y", "_ingested_at": "2024-05-01T12:00:00.000000Z"}


def test_documents_of_events_with_numbers_json_cannot_write(spark):
    texts = ['{"a": NaN, "b": [Infinity, {"x": -Infinity}]}', '{"a": 1}}', '{"a": 1.5}']
    found = [json.loads(r.document) for r in points.documents(records(spark, texts), at()).collect()]
    assert [{k: v for k, v in d.items() if k != "_ingested_at"} for d in found] == [
        {"a": "NaN", "b": ["Infinity", {"x": "-Infinity"}]},
        {"a": 1.5},
    ]


def test_normalize(spark):
    values = ['{ "b" : 1, "a": [1, 2] }', "{cut", "7 8", b"\xff", '{"a":1}] lost', "[1]] x", "1,2", ""]
    got = [(r.was_json, bytes(r.value)) for r in points.normalize_json_bytes(records(spark, values)).collect()]
    assert got[0][0] and json.loads(got[0][1]) == {"a": [1, 2], "b": 1}
    assert got[1:] == [(False, v if isinstance(v, bytes) else v.encode()) for v in values[1:]]


def test_points_do_not_shuffle(spark):
    plan = points.points_from_records(records(spark, [event()]), at())
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def point_frame(spark, data):
    return spark.createDataFrame(
        data,
        "measurement string, source_name string, device_name string, profile_name string, "
        "topic string, kafka_partition int, kafka_offset bigint, s bigint, field string, "
        "value_num double, value_str string, value_bool boolean",
    ).withColumn("ts", F.timestamp_seconds("s"))


def test_series_selections(spark):
    def p(offset, s, field, value, device="d"):
        return ("m", "src", device, "pr", "t", 0, offset, s, field, value, None, None)

    df = point_frame(spark, [p(1, 10, "a", 1.0), p(2, 20, "a", 2.0), p(3, 5, "b", 3.0), p(4, 20, "a", 9.0, "e")])
    newest = {(r.device_name, r.field): r.value_num for r in series.last_per_series(df).collect()}
    assert newest == {("d", "a"): 2.0, ("d", "b"): 3.0, ("e", "a"): 9.0}
    first = series.first_per_group(df, ["field", "device_name"])
    assert {(r.field, r.device_name): r.value_num for r in first.collect()}[("a", "d")] == 1.0
    start, stop = F.timestamp_seconds(F.lit(10)), F.timestamp_seconds(F.lit(20))
    assert [r.kafka_offset for r in series.range_series(df, "m", "a", start, stop).collect()] == [1]
    stop = F.timestamp_seconds(F.lit(30))
    assert series.probe_lookup(df, "m", "d", "a", 2.0, start, stop).count() == 1
    assert series.probe_lookup(df, "m", "d", "a", 7.0, start, stop).count() == 0
    assert series.retained(df, F.timestamp_seconds(F.lit(110)), 100).count() == 3


def test_member_kinds(spark):
    df = spark.sql("select parse_json(v) v from values ('1'),('1.5'),('true'),('\"x\"'),('null'),('[1]'),('{}') t(v)")
    kinds = [r[0] for r in df.select(payload.member_kind(F.col("v"))).collect()]
    assert kinds == ["num", "num", "bool", "str", "none", "none", "none"]
    assert rows(df.select(payload.variant_number(F.col("v"))))[:2] == [(1.0,), (1.5,)]


def test_ranges_read_their_days_only(spark, tmp_path):
    day = 86_400
    rows = [("m", "a", i * day // 2, 0, i, float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "measurement string, field string, s bigint, kafka_partition int, kafka_offset bigint, value_num double")
    timed = df.withColumn("ts", F.timestamp_seconds("s")).withColumn("event_date", F.to_date("ts"))
    timed.write.partitionBy("event_date").parquet(str(tmp_path / "points"))
    stored = spark.read.parquet(str(tmp_path / "points"))
    start, stop = (F.timestamp_seconds(F.lit(s)) for s in (day + day // 2, 3 * day))
    for found, offsets, days in (
        (series.range_series(stored, "m", "a", start, stop), [3, 4, 5], 3),
        (series.retained(stored, F.timestamp_seconds(F.lit(5 * day)), day), [8, 9, 10, 11], 2),
    ):
        assert sorted(r.kafka_offset for r in found.collect()) == offsets
        plan = found._jdf.queryExecution().executedPlan()
        assert "PartitionFilters: [isnotnull(event_date" in plan.toString()
        leaf = plan.collectLeaves().head()
        assert leaf.metrics().get("numPartitions").get().value() <= days

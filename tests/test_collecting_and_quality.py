from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemeter.operators import collector, profiles, quality, sessions
from tidemeter.plans import datasets
from tidemeter.schemas import AGENT_METRICS, ENVELOPE
from tidemeter.sources import collector as source
from tidemeter.sources.generate import SOURCE_KINDS, generate_events


def batch_frame(spark, *documents):
    texts = [d if isinstance(d, str) else json.dumps(d) for d in documents]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, document string")


def metric(plugin, **fields):
    return {"name": plugin, "fields": fields}


def routes(spark, *documents):
    made = collector.route_batches(batch_frame(spark, *documents), "document", ["doc_id"])
    return {(r.doc_id, r.resource_name): json.loads(r.value) for r in made.collect()}


def test_routing(spark):
    got = routes(
        spark,
        {
            "metrics": [
                metric("cpu", usage_user=1.5, cpu="cpu-total"),
                metric("diskio", reads=1, name="a"),
                metric("diskio", reads=2),
                metric("net", bytes_recv=1, err=0, note="5"),
                metric("net", bytes_recv=2, drop=1),
                metric("unknown", x=1),
                metric("mem"),
                {"name": "system"},
            ]
        },
        "[1]",
        "7",
        "broken",
        {"other": 1},
    )
    assert got == {
        (0, "cpu_data"): {"usage_user": 1.5, "cpu": "cpu-total"},
        (0, "disk_data"): {"reads": 2},
        (0, "net_data"): {"bytes_recv": 2, "err": 0, "note": "5", "drop": 1},
    }


def test_entries_and_events(spark):
    batches = batch_frame(spark, {"metrics": [metric("cpu", a=1), metric("mem"), metric("x", b="t")]})
    entries = source.collector_entries(batches, "doc_id", "document").collect()
    assert [(r.pos, r.plugin) for r in entries] == [(0, "cpu"), (1, "x")]
    made = datasets.run_collector_to_events(
        batches, "doc_id", "document", F.lit("n"), F.lit("p"), F.lit(5).cast("bigint")
    ).first()
    event = json.loads(made.event)
    assert event["sourceName"] == "cpu_data" and json.loads(event["readings"][0]["value"]) == {"a": 1}


def test_metrics_are_read_and_merged_once(spark):
    made = collector.route_batches(batch_frame(spark, {"metrics": []}), "document", ["doc_id"])
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("aggregate(") == 1
    assert "array_contains" not in plan


def test_repeated_keys_and_odd_entries_are_routed(spark):
    """A repeated key of a merged entry failed the job."""
    net = {"name": "net", "fields": {"b": 2, "c": 1}}
    odd = [
        {"fields": {"a": 1}},
        {"name": None, "fields": {"a": 1}},
        metric("mem", x=1),
        metric("cpu", y=1),
        metric("mem", x=2),
        metric("mem"),
        None,
        metric("net", a=1, b=1),
        net,
        metric("net", a=3),
    ]
    got = routes(
        spark,
        '{"metrics":[{"name":"net","fields":{"a":1,"a":2}}]}',
        '{"metrics":[{"name":"net","fields":{"a":1,"a":2}},{"name":"net","fields":{"b":1,"b":3}}]}',
        {"metrics": odd},
        {"metrics": None},
        {"metrics": [metric("system")]},
    )
    assert got == {
        (0, "net_data"): {"a": 2},
        (1, "net_data"): {"a": 2, "b": 3},
        (2, "mem_data"): {"x": 2},
        (2, "cpu_data"): {"y": 1},
        (2, "net_data"): {"a": 3, "b": 2, "c": 1},
    }


def test_routes_and_events_are_made_by_generated_code(spark):
    """No lambdas where rows are made of a batch, and the text of an event is not part of its reader's projection."""
    batches = batch_frame(spark, {"metrics": [metric("cpu", a=1)]})
    made = datasets.run_collector_to_events(
        batches, "doc_id", "document", F.lit("n"), F.lit("p"), F.lit(5).cast("bigint")
    )
    read = made.select(F.from_json("event", ENVELOPE).alias("event"))
    plan = read._jdf.queryExecution().optimizedPlan().toString().splitlines()
    inline = next(line for line in plan if "Generate inline" in line)
    assert "lambda" not in inline and "from_json(" not in inline
    reader = next(line for line in plan if "from_json(StructField(apiVersion" in line)
    assert "StructsToJson" not in reader
    assert read.first().event.readings[0].value == '{"a":1}'


def test_only_objects_are_given_to_the_reader(spark):
    documents = [' \t\r\n{"metrics":[{"name":"cpu","fields":{"a":1}}]}', '[{"metrics":[]}]', "", "7", "\u00a0{}", None]
    rows = [(i, d) for i, d in enumerate(documents)]
    made = source.collector_fields(spark.createDataFrame(rows, "doc_id int, document string"), "doc_id", "document")
    assert [(r.doc_id, r.pos, list(r.fields)) for r in made.collect()] == [(0, 0, ["a"])]
    assert "startswith" in made._jdf.queryExecution().optimizedPlan().toString().lower()


def test_rename_promote(spark):
    df = spark.createDataFrame(
        [
            (1, "mem", {"total": "9", "used": "1"}, {}),
            (2, "mem", {"total": "9", "mem_total": "old"}, {}),
            (3, "processes", {"total": "7"}, {}),
            (4, "cpu", {"total": "5"}, {}),
            (5, "gpu_process_metrics", {"sm": "1", "pid": "old"}, {"pid": "42", "host": "h"}),
        ],
        "id int, plugin string, fields map<string,string>, tags map<string,string>",
    )
    renamed = {r.id: r.fields for r in collector.rename_fields(df).collect()}
    assert renamed[1] == {"mem_total": "9", "used": "1"}
    assert renamed[2] == {"mem_total": "9"}
    assert renamed[3] == {"proc_total": "7"}
    assert renamed[4] == {"total": "5"}
    promoted = {r.id: r for r in collector.promote_tags(df).collect()}
    assert promoted[5].fields == {"sm": "1", "pid": "42"} and promoted[5].tags == {"host": "h"}


def test_merge(spark):
    df = spark.createDataFrame(
        [
            ("cpu", {"h": "1", "g": "2"}, 1, {"a": "1", "b": "1"}, 1),
            ("cpu", {"g": "2", "h": "1"}, 1, {"b": "2", "c": "3"}, 2),
            ("cpu", {"h": "2"}, 1, {"a": "9"}, 3),
            ("cpu", {"h": "1", "g": "2"}, 2, {"a": "8"}, 4),
        ],
        "n string, tags map<string,string>, t int, fields map<string,string>, seq int",
    )
    made = collector.merge_same_key_metrics(df, "n", "tags", "t", "fields", "seq").collect()
    got = {(tuple(sorted(r.tags.items())), r.time): r.fields for r in made}
    assert got[((("g", "2"), ("h", "1")), 1)] == {"a": "1", "b": "2", "c": "3"}
    assert len(got) == 3


def test_unpivot(spark):
    wide = spark.range(1).select("id", *[F.lit(i).alias(m) for i, m in enumerate(AGENT_METRICS)])
    made = collector.unpivot_metrics(wide, ["id"], AGENT_METRICS).collect()
    assert len(made) == 25 and {r.resource_name: r.value for r in made}["Uptime"] == "24"


def profile(name, *resources):
    return {
        "name": name,
        "deviceResources": [
            {"name": n, "properties": {"valueType": t, "readWrite": "R"}} for n, t in resources
        ],
    }


def test_profiles(spark):
    documents = batch_frame(
        spark,
        [{"apiVersion": "v3", "profile": profile("p1", ("a", "Float32"), ("b", "Uint64"))}],
        profile("p2", ("a", "Int16")),
        "broken",
    )
    dimension = profiles.profile_dimension(documents)
    got = {(r.profile_name, r.resource_name, r.value_type) for r in dimension.collect()}
    assert got == {("p1", "a", "Float32"), ("p1", "b", "Uint64"), ("p2", "a", "Int16")}
    known = dimension.filter("profile_name = 'p1'")
    assert {r.profile_name for r in profiles.new_profiles(dimension, known).collect()} == {"p2"}
    readings = spark.createDataFrame(
        [("p1", "a", "1.5"), ("p1", "a", "-"), ("p1", "b", "7"), ("p1", "b", "-7"), ("p2", "b", "1"),
         ("p2", "a", "1.5"), ("p1", "b", None)],
        "profile_name string, resource_name string, raw_value string",
    )
    checked = profiles.profile_conformance(readings, dimension)
    verdicts = {(r.profile_name, r.resource_name, r.raw_value): r.verdict for r in checked.collect()}
    assert verdicts == {
        ("p1", "a", "1.5"): "ok",
        ("p1", "a", "-"): "bad value",
        ("p1", "b", "7"): "ok",
        ("p1", "b", "-7"): "bad value",
        ("p2", "b", "1"): "unknown resource",
        ("p2", "a", "1.5"): "bad value",
        ("p1", "b", None): "bad value",
    }
    assert profiles.rejects(checked).count() == 5


def test_device_filters(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "device_name string")
    names = spark.createDataFrame([("a",), ("a",)], "device_name string")
    assert profiles.filter_devices(df, ["a", "b"]).count() == 2
    assert profiles.filter_devices(df, ["a"], filter_out=True).count() == 2
    assert profiles.filter_devices_by_table(df, names).count() == 1
    assert profiles.filter_devices_by_table(df, names, filter_out=True).count() == 2


def test_sessions(spark):
    df = spark.createDataFrame(
        [(1, "my app,x", "a", 1, "b", 2, 1024, 0), (1, "my app,x", "a", 1, "b", 2, 1024, 3000),
         (2, "z", "a", 1, "b", 2, 9000, 9000)],
        "pid int, comm string, laddr string, lport int, daddr string, dport int, "
        "send_bytes bigint, recv_bytes bigint",
    )
    made = sessions.tcp_session_throughput(df)
    assert [(r.pid, r.rx_kb, r.tx_kb) for r in made.collect()] == [(2, 8, 8), (1, 2, 2)]
    line = sessions.sessions_to_lines(made).collect()[1].line
    assert line == r'tcp_top pid="1",comm="my_app\,x",laddr="a",lport="1",raddr="b",dport="2",rx_kb=2,tx_kb=2'


def test_generator_is_repeatable_and_in_range(spark):
    keys = spark.range(900).withColumn("kind", F.element_at(
        F.array(*[F.lit(k) for k in (*SOURCE_KINDS, "strange")]), (F.col("id") % 9 + 1).cast("int")))
    def make(seed, parts):
        return generate_events(
            keys.repartition(parts), "id", F.col("kind"), F.lit(5), F.lit("d"), F.lit("p"), seed
        )
    first = {r.id: r.value for r in make(1, 2).collect()}
    assert first == {r.id: r.value for r in make(1, 7).collect()}
    assert first != {r.id: r.value for r in make(2, 2).collect()}
    event = json.loads(first[0])
    cpu = json.loads(json.loads(event["readings"][0]["value"])["cpu_data"])
    assert 75 <= cpu["usage_idle"] <= 95 and 4 <= cpu["usage_user"] <= 20
    memory = json.loads(json.loads(json.loads(first[3])["readings"][0]["value"])["mem_data"])
    assert memory["available"] + memory["used"] == memory["mem_total"]
    load = json.loads(json.loads(json.loads(first[5])["readings"][0]["value"])["sys_data"])
    assert load["load15"] <= load["load5"] <= load["load1"] <= 4.0
    states = json.loads(json.loads(json.loads(first[7])["readings"][0]["value"])["proc_data"])
    known = sum(states[k] for k in ("running", "sleeping", "stopped", "zombies"))
    assert 40 <= states["proc_total"] - known <= 80
    process = json.loads(json.loads(json.loads(first[2])["readings"][0]["value"])["gpu_proc_data"])
    assert process["sm_util"] == "-" and 1000 <= process["pid"] <= 9999
    other = json.loads(json.loads(json.loads(first[8])["readings"][0]["value"])["strange"])
    assert set(other) == {"host", "value"}
    assert len({json.loads(v)["id"] for v in first.values()}) == 900


ORDERS = {
    "data_asset_name": "orders",
    "table_rules": [{"rule_name": "check_table_row_count_not_zero", "add_info": {"min_value": 1}}],
    "columns": [
        {
            "column_name": "status",
            "dq_rule(s)": [
                {"rule_name": "check_if_values_in_list", "add_info": {"value_set": ["pending", "shipped", "delivered"]}},
                {"rule_name": "no_such_rule"},
            ],
        }
    ],
}
USERS = {
    "data_asset_name": "users",
    "table_rules": [{"rule_name": "check_table_row_count_not_zero"}],
    "columns": [{"column_name": "user_id", "dq_rule(s)": [{"rule_name": "check_if_not_null", "add_info": {}}]}],
}


def test_quality_folder(spark, tmp_path):
    suites, data = tmp_path / "suites", tmp_path / "data"
    suites.mkdir(), data.mkdir()
    (suites / "orders.json").write_text(json.dumps(ORDERS, indent=1))
    (suites / "users.json").write_text(json.dumps(USERS))
    (data / "orders.csv").write_text("order_id,status,amount\n1,nah,1.5\n2,shipped,2\n3,,3\n")
    (data / "users.csv").write_text("user_id,username,email\n1,a,b\n2,c,d\n")
    schemas = {
        "orders": "order_id int, status string, amount double",
        "users": "user_id int, username string, email string",
    }
    results = datasets.run_quality(spark, str(suites), str(data), schemas)
    got = {(r.asset, r.rule): (r.unexpected, r.success) for r in results.collect()}
    assert got == {
        ("orders", "check_table_row_count_not_zero"): (0, True),
        ("orders", "check_if_values_in_list"): (1, False),
        ("users", "check_table_row_count_not_zero"): (0, True),
        ("users", "check_if_not_null"): (0, True),
    }
    success = {r.asset: r.success for r in quality.suite_success(results).collect()}
    assert success == {"orders": False, "users": True}
    with pytest.raises(quality.DataQualityError, match="status"):
        datasets.run_quality(spark, str(suites), str(data), schemas, stop_on_failure=True)


def test_rules_on_edge_cases(spark):
    empty = spark.createDataFrame([], "user_id int")
    assert [r.success for r in quality.run_suite(empty, USERS).collect()] == [False, True]
    assert quality.run_suite(empty, {"data_asset_name": "x"}).count() == 0
    df = spark.createDataFrame([(1,), (6,), (7,), (None,)], "n int")
    counts = df.agg(
        quality.between("n", 1, 6).alias("a"),
        quality.between("n", low=2).alias("b"),
        quality.not_null("n").alias("c"),
        quality.row_count_min(5).alias("d"),
    ).first()
    assert tuple(counts) == (1, 1, 1, 1)


def test_benchmark_stats(spark):
    df = spark.createDataFrame([("a", 1.0, True), ("a", 3.0, False)], "k string, latency_ms double, ok boolean")
    row = sessions.benchmark_stats(df, F.lit(4.0), ["k"]).first()
    assert tuple(row) == ("a", 1.0, 2.0, 3.0, 1, 1, 0.5)

"""Small frames are written by few tasks, whatever the number of shuffle partitions."""

from __future__ import annotations

from tidemeter.llm.components import components


def test_small_components_are_written_by_few_tasks(spark):
    settings = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        edges = spark.createDataFrame([(i, i + 1) for i in range(300) if i % 10 != 9], "a bigint, b bigint")
        found = components(edges)
        labels = {r["node"]: r["label"] for r in found.collect()}
        assert len(found.inputFiles()) == 1
        assert all((labels[i] == labels[i + 1]) == (i % 10 != 9) for i in range(299))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)

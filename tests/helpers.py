"""Literal frames."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidemeter.schemas import KAFKA_RECORD

NS = 1_700_000_000_000_000_000


def at():
    """Load or processing time."""
    return F.lit("2024-05-01 12:00:00").cast("timestamp")


def event(**over) -> dict:
    base = {
        "apiVersion": "v3",
        "id": "e1",
        "deviceName": "node-1",
        "profileName": "profile-1",
        "sourceName": "cpu_data",
        "origin": NS,
        "readings": [reading("CPUUsage", "Float32", "45.2")],
    }
    base.update(over)
    return {k: v for k, v in base.items() if v is not ...}


def reading(resource: str, value_type: str, value, origin: int = NS) -> dict:
    return {
        "origin": origin,
        "deviceName": "node-1",
        "resourceName": resource,
        "profileName": "profile-1",
        "valueType": value_type,
        "value": value,
    }


def encoded(source: str, members: dict) -> str:
    return json.dumps({source: json.dumps(members)})


def records(spark, values: list, topic: str = "metrics"):
    """Kafka-shaped rows of events (dicts), texts, bytes or None; the offset is the position."""
    rows = []
    for offset, value in enumerate(values):
        if isinstance(value, dict):
            value = json.dumps(value)
        if isinstance(value, str):
            value = value.encode()
        rows.append((None, None if value is None else bytearray(value), topic, 0, offset, None))
    return spark.createDataFrame(rows, KAFKA_RECORD)


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]

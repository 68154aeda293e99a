"""Envelope schema, table layouts and the constants that decide results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

READING = T.StructType(
    [
        T.StructField("origin", T.LongType()),
        T.StructField("deviceName", T.StringType()),
        T.StructField("resourceName", T.StringType()),
        T.StructField("profileName", T.StringType()),
        T.StructField("valueType", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

ENVELOPE = T.StructType(
    [
        T.StructField("apiVersion", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("deviceName", T.StringType()),
        T.StructField("profileName", T.StringType()),
        T.StructField("sourceName", T.StringType()),
        T.StructField("origin", T.LongType()),
        T.StructField("readings", T.ArrayType(READING)),
    ]
)

# Column layout of Spark's Kafka source; file-backed twins use the same one.
KAFKA_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# --- Fixed values: results depend on them -----------------------------------------------------

# Value types whose text is a number. Int8 is not one of them.
NUMERIC_VALUE_TYPES = (
    "Float32",
    "Float64",
    "Int16",
    "Int32",
    "Int64",
    "Uint8",
    "Uint16",
    "Uint32",
    "Uint64",
)

# Resource -> JSON paths tried in order for the silver number of a JSON payload.
RESOURCE_NUMBER_PATHS = {
    "cpu_data": ("$.usage_user",),
    "mem_data": ("$.used",),
    "sys_data": ("$.load1",),
    "proc_data": ("$.running",),
    "disk_data": ("$.read_bytes",),
    "net_data": ("$.bytes_recv", "$.ip_inreceives"),
    "gpu_data": ("$.utilization_gpu",),
    "gpu_process_metrics": ("$.sm_util",),
    "gpu_proc_data": ("$.sm_util",),
}

# Collector plugin -> resource.
PLUGIN_RESOURCES = {
    "cpu": "cpu_data",
    "mem": "mem_data",
    "diskio": "disk_data",
    "system": "sys_data",
    "processes": "proc_data",
    "nvidia_smi": "gpu_data",
    "net": "net_data",
}
# The one plugin whose entries are merged; for all others the last entry wins.
MERGED_PLUGIN = "net"

# Plugin -> {field: new name}.
FIELD_RENAMES = {"mem": {"total": "mem_total"}, "processes": {"total": "proc_total"}}

# Plugin -> tags that become text fields.
PROMOTED_TAGS = {"gpu_process_metrics": ("gpu_idx", "pid", "process_name")}

# Metrics of the wide dataset, in column order.
WIDE_METRICS = (
    "Temperature",
    "CPUUsage",
    "CPUFreq",
    "ContextSwitches",
    "Interrupts",
    "SoftInterrupts",
    "MemUsed",
    "MemFree",
    "LoadAvg1",
    "LoadAvg5",
    "LoadAvg15",
    "ProcessCount",
    "Uptime",
)
WIDE_BIN_NS = 500_000_000

# Metrics of the host agent's record, in reporting order.
AGENT_METRICS = (
    "Temperature",
    "CPUUsage",
    "CPUFreq",
    "ContextSwitches",
    "Interrupts",
    "SoftInterrupts",
    "Syscalls",
    "MemUsed",
    "MemFree",
    "SwapIn",
    "SwapOut",
    "DiskRead",
    "DiskWrite",
    "NetBytesSent",
    "NetBytesRecv",
    "NetPacketsSent",
    "NetPacketsRecv",
    "NetErrorsIn",
    "NetErrorsOut",
    "LoadAvg1",
    "LoadAvg5",
    "LoadAvg15",
    "ProcessCount",
    "ThreadCount",
    "Uptime",
)

POINT_MEASUREMENT = "edge_computer_stats"
RETENTION_SECONDS = 2_592_000

# Resource -> (yellow from, red from).
THRESHOLDS = {
    "cpu_data_usage_user": (70.0, 90.0),
    "gpu_data_utilization_gpu": (75.0, 90.0),
    "mem_data_used_percent": (75.0, 90.0),
    "gpu_data_temperature_gpu": (60.0, 75.0),
}

# Minutes a dashboard user may choose for the trend panels, and the default.
TREND_MINUTES = (15, 30, 60, 120, 240)
DEFAULT_TREND_MINUTES = 60

# --- Tables -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """A stored table: DDL columns, the time its date partition comes from, its partition columns."""

    name: str
    columns: str
    time_column: str | None = None
    partition_by: tuple[str, ...] = ("event_date", "batch_id")

    @property
    def ddl(self) -> str:
        date = ", event_date DATE" if "event_date" in self.partition_by else ""
        return self.columns + date

    @property
    def schema(self) -> T.StructType:
        """Column order of the stored files: partition columns last."""
        fields = T.StructType.fromDDL(self.ddl)
        plain = [f for f in fields if f.name not in self.partition_by]
        return T.StructType(plain + [fields[name] for name in self.partition_by])


# One row per reading.
READING_BRONZE = TableSpec(
    "reading_bronze",
    "event_id STRING NOT NULL, api_version STRING, device_name STRING, profile_name STRING, "
    "source_name STRING, event_origin TIMESTAMP, resource_name STRING, value_type STRING, "
    "raw_value STRING, reading_origin TIMESTAMP, kafka_partition INT, kafka_offset BIGINT, "
    "batch_id STRING NOT NULL, ingested_at TIMESTAMP NOT NULL",
    "event_origin",
)
READING_SILVER = TableSpec(
    "reading_silver",
    "event_id STRING NOT NULL, device_name STRING, profile_name STRING, resource_name STRING, "
    "event_time TIMESTAMP, metric_value STRING, metric_value_num DOUBLE, value_type STRING, "
    "batch_id STRING NOT NULL, processed_at TIMESTAMP NOT NULL",
    "event_time",
)
READING_GOLD = TableSpec(
    "reading_gold",
    "window_start TIMESTAMP NOT NULL, device_name STRING NOT NULL, profile_name STRING NOT NULL, "
    "resource_name STRING NOT NULL, sample_count BIGINT NOT NULL, avg_value DOUBLE NOT NULL, "
    "min_value DOUBLE NOT NULL, max_value DOUBLE NOT NULL, batch_id STRING NOT NULL, "
    "generated_at TIMESTAMP NOT NULL",
    "window_start",
)

# Mergeable aggregates of one window and batch.
READING_PARTIAL = TableSpec(
    "reading_partial",
    "window_start TIMESTAMP, device_name STRING, profile_name STRING, resource_name STRING, sample_count BIGINT, "
    "value_sum DOUBLE, min_value DOUBLE, max_value DOUBLE, batch_id STRING",
    "window_start",
)

# One row per event.
EVENT_BRONZE = TableSpec(
    "event_bronze",
    "event_id STRING NOT NULL, api_version STRING, device_name STRING, profile_name STRING, "
    "source_name STRING, event_origin TIMESTAMP, reading_origin TIMESTAMP, raw_value STRING, "
    "kafka_partition INT, kafka_offset BIGINT, batch_id STRING NOT NULL, "
    "ingested_at TIMESTAMP NOT NULL",
    "event_origin",
)
EVENT_SILVER = TableSpec(
    "event_silver",
    "event_id STRING NOT NULL, device_name STRING, profile_name STRING, source_name STRING, "
    "event_time TIMESTAMP, metric_key STRING NOT NULL, metric_value STRING, "
    "metric_value_num DOUBLE, batch_id STRING NOT NULL, processed_at TIMESTAMP NOT NULL",
    "event_time",
)
EVENT_GOLD = TableSpec(
    "event_gold",
    "window_start TIMESTAMP NOT NULL, device_name STRING NOT NULL, profile_name STRING NOT NULL, "
    "source_name STRING NOT NULL, metric_key STRING NOT NULL, sample_count BIGINT NOT NULL, "
    "avg_value DOUBLE NOT NULL, min_value DOUBLE NOT NULL, max_value DOUBLE NOT NULL, "
    "batch_id STRING NOT NULL, generated_at TIMESTAMP NOT NULL",
    "window_start",
)

POINTS = TableSpec(
    "points",
    "measurement STRING, source_name STRING, device_name STRING, profile_name STRING, "
    "topic STRING, kafka_partition INT, kafka_offset BIGINT, ts TIMESTAMP, field STRING, "
    "value_num DOUBLE, value_str STRING, value_bool BOOLEAN, batch_id STRING",
    "ts",
)

READING_LAYERS = (READING_BRONZE, READING_SILVER, READING_GOLD)
EVENT_LAYERS = (EVENT_BRONZE, EVENT_SILVER, EVENT_GOLD)

"""Layer tables: partitioned Parquet under one root, known to the catalog by name.

A table is partitioned by day and batch. A batch is written with dynamic partition overwrite, so
writing it again leaves the same rows, and a commit log (one row per write) says which batches are
complete. The log is written last: a batch whose job died before that is simply done again.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemeter.schemas import TableSpec
from tidemeter.session import read_in_small_tasks

# The folder name of an unknown partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"

# Shuffled bytes that one task of a write takes. It sorts them in memory, where they are about ten times as large.
WRITE_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
WRITE_BYTES = 16 * 1024 * 1024

COMMITS = TableSpec(
    "commits",
    "table_name STRING, operation STRING, batches ARRAY<STRING>, rows BIGINT, "
    "committed_at TIMESTAMP",
    partition_by=(),
)


def _literal(value: str | None) -> str:
    """A partition value in a statement."""
    if value is None:
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class TableStore:
    """The tables of one namespace."""

    def __init__(self, spark: SparkSession, root: str, namespace: str):
        read_in_small_tasks(spark)
        self.spark = spark
        self.root = f"{root.rstrip('/')}/{namespace}"
        self.namespace = namespace

    def full_name(self, name: str) -> str:
        return f"`{self.namespace}`.`{name}`"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # -- definition --

    def ensure(self, specs: Iterable[TableSpec]) -> None:
        """Create namespace, tables and commit log where missing; existing data is attached."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.namespace}`")
        for spec in [*specs, COMMITS]:
            if not self.exists(spec.name):
                self._create(spec)

    def _create(self, spec: TableSpec) -> None:
        partitions = f"PARTITIONED BY ({', '.join(spec.partition_by)})" if spec.partition_by else ""
        # Appending nothing makes the folder; partitions an earlier session wrote are then found.
        empty = self._no_rows(spec).write.mode("append")
        (empty.partitionBy(*spec.partition_by) if partitions else empty).parquet(self.path(spec.name))
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.full_name(spec.name)} ({spec.ddl}) USING parquet "
            f"{partitions} LOCATION '{self.path(spec.name)}'"
        )
        if partitions:
            self.spark.catalog.recoverPartitions(self.full_name(spec.name))

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.namespace}.{name}")

    # -- reading --

    def scan(self, name: str) -> DataFrame:
        return self.spark.table(self.full_name(name))

    def describe(self, name: str) -> DataFrame:
        return self.spark.sql(f"DESCRIBE EXTENDED {self.full_name(name)}")

    def history(self, name: str) -> DataFrame:
        return self.scan(COMMITS.name).filter(F.col("table_name") == name)

    def committed_batches(self, name: str) -> DataFrame:
        """Distinct ids of the batches a table holds completely, from the log alone."""
        return self.history(name).select(F.explode("batches").alias("batch_id")).distinct()

    # -- writing --

    def _arranged(self, df: DataFrame, spec: TableSpec) -> DataFrame:
        if "event_date" in spec.partition_by:
            df = df.withColumn("event_date", F.to_date(spec.time_column))
        return df.select(*[F.col(f.name).cast(f.dataType) for f in spec.schema])

    def _insert(self, df: DataFrame, spec: TableSpec, overwrite: bool, mode: str = "dynamic") -> int:
        """Insert and count in the same pass. ``dynamic`` replaces the partitions that get rows,
        ``static`` all of them.
        """
        seen = Observation()
        counted = self._arranged(df, spec).observe(seen, F.count(F.lit(1)).alias("rows"))
        conf = df.sparkSession.conf  # a micro-batch has a session of its own
        before = {name: conf.get(name) for name in (OVERWRITE_MODE, WRITE_SIZE)}
        conf.set(OVERWRITE_MODE, mode)
        conf.set(WRITE_SIZE, str(WRITE_BYTES))
        try:
            counted.write.insertInto(self.full_name(spec.name), overwrite=overwrite)
        finally:
            for name, value in before.items():
                conf.set(name, value)
        return seen.get["rows"]

    def _no_rows(self, spec: TableSpec) -> DataFrame:
        return self.spark.createDataFrame([], spec.schema)

    def _by_partition(self, df: DataFrame, spec: TableSpec) -> DataFrame:
        """Rows dealt by partition, so that there is about a file for each partition, not for each task and partition;
        a large partition is split."""
        if "event_date" in spec.partition_by:
            df = df.withColumn("event_date", F.to_date(spec.time_column))
        return df.hint("rebalance", *spec.partition_by)

    def append(self, df: DataFrame, spec: TableSpec) -> int:
        rows = self._insert(self._by_partition(df, spec), spec, overwrite=False)
        self.log(spec.name, "append", [], rows)
        return rows

    def overwrite_batches(self, df: DataFrame, spec: TableSpec, batches: list[str]) -> int:
        """Write whole batches; the same batches written before are replaced, also on days that get no rows now.

        New rows come first, then what the batches had on other days is dropped, then the commit is logged.
        """
        earlier = self._partitions_of(spec, batches)
        rows, written = self._insert_watched(self._by_partition(df, spec), spec, earlier)
        self.drop_partitions(spec, [p for p in earlier if (p.get("event_date"), p["batch_id"]) not in written])
        self.log(spec.name, "overwrite", batches, rows)
        return rows

    def _partitions_of(self, spec: TableSpec, batches: list[str]) -> list[dict[str, str | None]]:
        """Partitions that hold rows of these batches now."""
        if not batches or "batch_id" not in spec.partition_by:
            return []
        found = self.partitions(spec, batch_id=batches[0]) if len(batches) == 1 else self.partitions(spec)
        return [row.asDict() for row in found.where(F.col("batch_id").isin(batches)).collect()]

    def _insert_watched(self, df: DataFrame, spec: TableSpec, earlier: list) -> tuple[int, set]:
        """Insert and count; if there were earlier partitions, also tell which are written now."""
        if not earlier:
            return self._insert(df, spec, overwrite=True), set()
        seen = Observation()
        day = F.col("event_date").cast("string") if "event_date" in spec.partition_by else F.lit(None).cast("string")
        place = F.struct(day.alias("day"), F.col("batch_id").alias("batch"))
        rows = self._insert(df.observe(seen, F.collect_set(place).alias("places")), spec, overwrite=True)
        return rows, {(p["day"], p["batch"]) for p in seen.get["places"]}

    def replace(self, df: DataFrame, name: str) -> DataFrame:
        """Create or replace a table from a DataFrame and read it back."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.namespace}`")
        df.write.mode("overwrite").format("parquet").option("path", self.path(name)).saveAsTable(
            f"{self.namespace}.{name}"
        )
        return self.scan(name)

    def truncate(self, specs: Iterable[TableSpec]) -> dict[str, str | None]:
        """Empty each table; one failing does not stop the others. Name -> error or None.

        The batches leave the commit log as well. A stream that fills the table again needs a new
        checkpoint and a new stream name.
        """
        outcome: dict[str, str | None] = {}
        for spec in specs:
            try:
                self.scan(spec.name)
                self._insert(self._no_rows(spec), spec, overwrite=True, mode="static")
                outcome[spec.name] = None
            except AnalysisException as error:
                outcome[spec.name] = str(error)
        emptied = [name for name, error in outcome.items() if error is None]
        if self.exists(COMMITS.name) and emptied:
            self._forget(emptied)
        return outcome

    def _forget(self, names: list[str]) -> None:
        """Rewrite the log without some tables, by way of a copy beside it."""
        kept = self.scan(COMMITS.name).filter(~F.col("table_name").isin(names))
        copy = f"{self.root}/commits_kept/{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}"
        kept.write.parquet(copy)
        survivors = self.spark.read.schema(COMMITS.schema).parquet(copy)
        survivors.write.insertInto(self.full_name(COMMITS.name), overwrite=True)

    def partitions(self, spec: TableSpec, **known: str) -> DataFrame:
        """The partitions of a table, one column each, from the catalog; no data is read. Null is the unknown value."""
        fixed = ", ".join(f"{name} = {_literal(value)}" for name, value in known.items())
        listed = self.spark.sql(f"SHOW PARTITIONS {self.full_name(spec.name)}" + (f" PARTITION ({fixed})" if fixed else ""))
        levels = F.split("partition", "/")
        values = [F.url_decode(F.replace(F.regexp_replace(F.get(levels, F.lit(i)), "^[^=]*=", ""), F.lit("+"), F.lit("%2B"))) for i in range(len(spec.partition_by))]
        return listed.select(*(F.nullif(v, F.lit(NO_VALUE)).alias(name) for v, name in zip(values, spec.partition_by)))

    def drop_partitions(self, spec: TableSpec, partitions: list[dict[str, str | None]]) -> None:
        """Take partitions out of the catalog with one statement, then remove their folders. No job runs."""
        if not partitions:
            return

        listed = ", ".join(
            "PARTITION (" + ", ".join(f"{name} = {_literal(value)}" for name, value in p.items()) + ")" for p in partitions
        )
        context = self.spark.sparkContext
        gateway = context._jvm.org.apache.hadoop.fs.Path
        escaped = context._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        self.spark.sql(f"ALTER TABLE {self.full_name(spec.name)} DROP IF EXISTS {listed}")
        for partition in partitions:
            steps = [f"{name}={NO_VALUE if v is None else escaped.escapePathName(v)}" for name, v in partition.items()]
            folder = gateway("/".join([self.path(spec.name), *steps]))
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)

    def expire(self, spec: TableSpec, before: date) -> list[str]:
        """Drop all partitions of days before the date ``before``; returns the days. Rows without a day stay.

        The days come from the catalog, no data is read, and all of them go with one statement.
        """
        old = self.partitions(spec).where(F.col("event_date") < before.isoformat())
        expired = [row.asDict() for row in old.collect()]
        self.drop_partitions(spec, expired)
        return sorted({row["event_date"] for row in expired})

    # -- commit log --

    def log(self, name: str, operation: str, batches: list[str], rows: int) -> None:
        now = datetime.now(timezone.utc)
        commit = [(name, operation, batches, rows, now)]
        entry = self.spark.createDataFrame(commit, COMMITS.schema).coalesce(1)
        entry.write.insertInto(self.full_name(COMMITS.name))

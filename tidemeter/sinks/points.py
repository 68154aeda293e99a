"""A store of points in which equal points overwrite each other.

Points of the same measurement, tags, topic, time and field are one point, whichever batch they came in; the one of the latest offset
counts. Batches are only ever added. Readers merge the points they read, day by day, and compaction replaces the batches of a day by the
merged points, so that readers have less to merge. Compacted points keep their offsets and are merged like any others.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemeter.schemas import POINTS, TableSpec
from tidemeter.session import run_dir
from tidemeter.sinks.tables import TableStore

KEY = ("measurement", "source_name", "device_name", "profile_name", "topic", "ts", "field")
VALUES = ("value_num", "value_str", "value_bool")
COMPACTED = "compacted-"


def merge_points(points: DataFrame) -> DataFrame:
    """One row per point: that of the latest offset, of equal offsets that of the highest partition, then of the latest batch.

    Each task keeps one row per point before the shuffle. A null tag is a tag value of its own.
    """
    days = [c for c in ("event_date",) if c in points.columns]
    newest = F.max(F.struct("kafka_offset", "kafka_partition", "batch_id", *VALUES)).alias("newest")
    merged = points.groupBy(*days, *KEY).agg(newest)
    kept = {"kafka_partition": "newest.kafka_partition", "kafka_offset": "newest.kafka_offset", "batch_id": "newest.batch_id"}
    return merged.select(*(F.col(kept.get(c, f"newest.{c}" if c in VALUES else c)).alias(c) for c in points.columns))


class PointStore:
    """Points of one table."""

    def __init__(self, store: TableStore, spec: TableSpec = POINTS):
        self.store, self.spec = store, spec
        store.ensure([spec])

    def write(self, points: DataFrame, batch_id: str) -> int:
        """Write one batch; written again, it is replaced as a whole."""
        if batch_id.startswith(COMPACTED):
            raise ValueError(f"names of batches do not begin with {COMPACTED!r}")
        return self.store.overwrite_batches(points.withColumn("batch_id", F.lit(batch_id)), self.spec, [batch_id])

    def points(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """The points of the given days (all without); other days are not read."""
        rows = self.store.scan(self.spec.name)
        if first is not None:
            rows = rows.where(F.col("event_date") >= F.lit(first))
        if last is not None:
            rows = rows.where(F.col("event_date") <= F.lit(last))
        return merge_points(rows)

    def compact(self, before: date) -> int:
        """Replace the batches of every day before ``before`` by merged points; returns the number of batches replaced.

        Merged points are written as a batch of their own first, then the merged batches are dropped. A run that
        dies in between leaves points twice, which readers merge. Days of one batch are left alone, so compacting again does
        nothing. A batch that arrives later for such a day is merged by readers and by the next compaction.
        """
        old = self.store.partitions(self.spec).where(F.col("event_date") < before.isoformat())
        several = old.groupBy("event_date").agg(F.collect_list("batch_id").alias("batches")).where(F.size("batches") > 1)
        parts = [
            {"event_date": row["event_date"], "batch_id": batch} for row in several.collect() for batch in row["batches"]
        ]
        if not parts:
            return 0
        days = sorted({p["event_date"] for p in parts})
        rows = self.store.scan(self.spec.name).where(F.col("event_date").isin([date.fromisoformat(d) for d in days]))
        merged = merge_points(rows.where(F.col("batch_id").isin(sorted({p["batch_id"] for p in parts}))))
        # Written aside first: a table is not overwritten from itself.
        aside = f"{run_dir(self.store.spark, 'compacted')}/rows"
        merged.write.parquet(aside)
        batch_id = f"{COMPACTED}{uuid.uuid4().hex}"
        made = self.store.spark.read.schema(merged.schema).parquet(aside).withColumn("batch_id", F.lit(batch_id))
        self.store.overwrite_batches(made, self.spec, [batch_id])
        self.store.drop_partitions(self.spec, parts)
        return len(parts)

"""Helpers the operators share: stored intermediates, id filters, gapless numbering, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemeter.session import configure, run_dir

# An id is eight bytes, so this many are 8 MB in a broadcast.
BROADCAST_IDS = 1_000_000

# Narrow rows that one task writes at least, where their number is known.
NARROW_ROWS = 5_000

# Batches handed to Python: few rows, since one text may be long.
ARROW_ROWS = 2_000


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings of the operators: those of the library, and small Arrow batches."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Folders written inside of the open ``scratch`` blocks, the innermost last.
_scratch: list[list[str]] = []


def stored(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write to a new folder of the shared store and read it back.

    This cuts the lineage: whatever executor is lost later, the rows are read from the store. Inside of a ``scratch`` block the folder is
    removed at the block's end.
    """
    return _stored(df, label, partition_by, _scratch[-1:])


def _stored(df: DataFrame, label: str, partition_by: tuple[str, ...], owners: list[list[str]]) -> DataFrame:
    spark = df.sparkSession
    path = f"{run_dir(spark, label)}/rows"
    for owner in owners:
        owner.append(path)
    df.write.partitionBy(*partition_by).parquet(path)
    frame = spark.read.schema(df.schema).parquet(path)
    frame.stored_at = path
    return frame


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """Remove at the end what is ``stored`` inside. Gives a function that stores as well, but for the block around.

    What leaves the block must be stored by that function, as nothing else can be read afterwards.
    """
    own: list[str] = []
    around = _scratch[-1:]
    _scratch.append(own)
    try:
        yield lambda df, label, *partition_by: _stored(df, label, partition_by, around)
    finally:
        _scratch.remove(own)
        for path in own:
            _removed(spark, path)


def discard(frame: DataFrame) -> None:
    """Remove a stored frame that nothing reads any more."""
    _removed(frame.sparkSession, frame.stored_at)


def _removed(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getParent()
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def by_ids(df: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """``df`` semi- or anti-joined with a stored table of distinct ids.

    Counting a stored id column is cheap. Up to ``BROADCAST_IDS`` ids are broadcast, so that texts need no
    shuffle; more ids are joined by shuffle.
    """
    small = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if small else ids, key, how)


def by_pairs(df: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """``df`` joined with a stored table of narrow pairs; up to half of ``BROADCAST_IDS`` of them are broadcast, as with ids."""
    small = pairs.count() <= BROADCAST_IDS // 2
    return df.join(F.broadcast(pairs) if small else pairs, key)


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """Computed by no more tasks than one for each ``NARROW_ROWS`` of so many rows; a task that writes a handful of rows costs as
    much as one that writes thousands."""
    return df.coalesce(max(1, -(-rows // NARROW_ROWS)))


def map_arrow(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """One record batch in, one out; None is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = function(batch)
                if made is not None:
                    yield made

    return df.mapInArrow(run, schema)


def numbered(df: DataFrame, group: str, order: list[Column], name: str, spread: Column, buckets: int) -> DataFrame:
    """Gapless numbers from 0 within each group, without one task per group.

    Rows are numbered within (group, bucket), and buckets are shifted by the counts of earlier buckets.
    """
    cut = df.withColumn("_bucket", F.pmod(F.xxhash64(spread), F.lit(buckets)).cast("int"))
    counts = cut.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        F.col(group).alias("_g"),
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"),
    )
    within = Window.partitionBy(group, "_bucket").orderBy(*order)
    ranked = cut.withColumn("_rank", F.row_number().over(within) - 1)
    joined = ranked.join(
        shifts, ranked[group].eqNullSafe(shifts["_g"]) & (ranked["_bucket"] == shifts["_b"])
    )
    return joined.withColumn(name, (F.col("_shift") + F.col("_rank")).cast("long")).drop(
        "_bucket", "_rank", "_g", "_b", "_shift"
    )

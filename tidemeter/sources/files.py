"""Literal rows, CSV assets and raw landing."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quotes inside a text are doubled, and null differs from empty text.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

COPY_BLOCK = 8 * 1024 * 1024
LANDING_PROVIDERS = ("HTTPS", "FTP", "SPARK")


def rows(
    spark: SparkSession, data: Sequence[tuple], schema: T.StructType | str | list[str]
) -> DataFrame:
    """Literal rows with a declared schema, or with names only and inferred types."""
    return spark.createDataFrame(list(data), schema)


def csv_asset(
    spark: SparkSession, directory: str, asset: str, schema: T.StructType | str
) -> DataFrame:
    """``<asset>.csv`` with a header; the path may be one file or a folder of part files. Quoted texts may hold
    newlines and doubled quotes; ``""`` is empty text, an empty field and ``\\N`` are null."""
    return read_csv(spark, f"{directory.rstrip('/')}/{asset}.csv", schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine="true").csv(path)


def landing_path(root: str, dataset: str, url: str) -> str:
    """``raw/<dataset>/<last part of the url>`` under ``root``."""
    return f"{root.rstrip('/')}/raw/{dataset}/{url.split('/')[-1]}"


def _copier():
    """Function that copies files; it brings all it needs along to the executors."""

    def filesystem(path: str):
        from urllib.parse import urlparse

        from pyarrow import fs

        if urlparse(path).scheme:
            return fs.FileSystem.from_uri(path)
        return fs.LocalFileSystem(), path

    def copy(source: str, target: str, block_size: int) -> tuple[int, str]:
        """Copy in blocks beside the target, then move: a retried task replaces, never appends.

        Gives size and digest of what was read.
        """
        from hashlib import sha256
        from uuid import uuid4

        source_fs, source_path = filesystem(source)
        target_fs, target_path = filesystem(target)
        target_fs.create_dir(target_path.rsplit("/", 1)[0], recursive=True)
        part = f"{target_path}.{uuid4().hex}"
        size, digest = 0, sha256()
        with source_fs.open_input_stream(source_path) as reader:
            with target_fs.open_output_stream(part) as writer:
                while block := reader.read(block_size):
                    writer.write(block)
                    size += len(block)
                    digest.update(block)
        target_fs.move(part, target_path)
        return size, digest.hexdigest()

    return copy


LANDED = "source string, path string, bytes bigint, sha256 string"


def _below(spark: SparkSession, source: str) -> Column:
    """Name of a listed file below the folders that ``source`` names without a wildcard."""
    fixed = re.split(r"[*?\[{]", source, maxsplit=1)[0]
    folder = fixed if fixed == source else fixed[: fixed.rfind("/") + 1]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder or ".")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    start = str(system.makeQualified(path).toString()).rstrip("/") + "/"
    inside = F.col("path").startswith(start)
    last = F.element_at(F.split("path", "/"), -1)
    return F.when(inside, F.substring("path", len(start) + 1, 2**31 - 1)).otherwise(last)


def land_raw_files(
    spark: SparkSession, source: str, root: str, dataset: str, provider: str = "SPARK"
) -> DataFrame:
    """Land every file ``source`` matches, unchanged, replacing earlier copies.

    Files keep their names below the folders that ``source`` names without a wildcard, so files of equal names in
    several folders stay apart. They are listed without reading them, spread over all cores, and copied block by block
    by the executors; the digest is of the bytes read. A provider that is not known lands nothing.
    """
    if provider not in LANDING_PROVIDERS:
        return spark.createDataFrame([], LANDED)

    copy, block_size = _copier(), COPY_BLOCK

    def copy_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            copied = [copy(old, new, block_size) for old, new in zip(batch["source"], batch["path"])]
            yield batch.assign(bytes=[size for size, _ in copied], sha256=[digest for _, digest in copied])

    target = F.concat(F.lit(landing_path(root, dataset, "")), _below(spark, source))
    listing = spark.read.format("binaryFile").load(source)
    files = listing.select(F.col("path").alias("source"), target.alias("path"))
    tasks = spark.sparkContext.defaultParallelism  # a given number is not merged into fewer tasks
    return files.repartition(tasks, "source").mapInPandas(copy_files, LANDED)

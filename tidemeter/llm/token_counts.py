"""Token counts through a cache of digests.

The cache holds (content digest, tokenizer digest, n_tokens). Contents found there are not encoded; of the others each
distinct one is encoded once and its count appended, as a new write of its own, after which the cache is joined.
"""

from __future__ import annotations

import hashlib
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemeter.llm.pieces import count_tokens
from tidemeter.llm.shared import by_ids, map_arrow, prepared, stored

CACHE_SCHEMA = "content string, tokenizer string, n_tokens bigint"


def tokenizer_digest(path: str) -> str:
    """Version of a tokenizer: digest of its file."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def read_cache(spark: SparkSession, path: str | None) -> DataFrame:
    if path is None:
        return spark.createDataFrame([], CACHE_SCHEMA)
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    except Exception as error:  # a cache that nobody has written yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def token_counts(
    docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Columns: id, n_bytes, n_tokens, over_limit, cached (whether the count was in the cache before).

    Contents are normalised only so far as no count changes: null becomes empty. Special strings in a text count as
    the library treats them; no begin or end token is added. Rows that repeat an id or a text each get a row. Texts of any
    length are counted whole. With ``cache`` (a folder of the shared store) new counts are appended; a job that dies before leaves the cache as
    it was, and repeated entries of two jobs at once are harmless. An empty input gives an empty result.
    """
    spark = prepared(docs.sparkSession)
    version = tokenizer_digest(tokenizer)
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    keyed = texts.select("id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("content"))
    keyed = stored(keyed, "contents")
    known = read_cache(spark, cache).where(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    missing = keyed.join(known, "content", "left_anti")
    # One document for each missing content; its id, not its text, is shuffled.
    chosen = stored(missing.groupBy("content").agg(F.min("id").alias("id")), "chosen")
    spare = keyed.join(chosen.select(F.col("id").alias("_id"), "content"), "content", "left").where("NOT id <=> _id")
    spared = stored(spare.select("id").distinct().join(chosen, "id", "left_anti").where("id IS NOT NULL"), "spared")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch["content"], pa.array(count_tokens(batch["text"], tokenizer))], ["content", "n_tokens"])

    misses = by_ids(texts, spared, "id", "left_anti").select(F.sha2("text", 256).alias("content"), "text")
    counted = map_arrow(misses, count, "content string, n_tokens bigint")
    fresh = stored(counted.select("content", F.lit(version).alias("tokenizer"), "n_tokens"), "counts")
    if cache is not None:
        fresh.join(known, "content", "left_anti").dropDuplicates(["content"]).select("content", "tokenizer", "n_tokens").write.mode("append").parquet(cache)
    old = known.select("content", "n_tokens", F.lit(True).alias("cached"))
    new = fresh.groupBy("content").agg(F.max("n_tokens").alias("n_tokens")).join(known, "content", "left_anti")
    counts = old.unionByName(new.withColumn("cached", F.lit(False)))
    return keyed.join(counts, "content").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "cached"
    )

"""Training-corpus pipeline over ``documents``: each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemeter.llm.decontamination import decontaminate
from tidemeter.llm.jaccard_join import jaccard_join
from tidemeter.llm.mixing import mix_sources
from tidemeter.llm.quality_rules import quality_rules
from tidemeter.llm.shared import by_ids, prepared, read_table, scratch, stored
from tidemeter.llm.sharding import kd_shards


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules(docs).where("kept").select(*docs.columns)


def document_key() -> Column:
    """Null-safe key of id and text, in the order of ids, null ones last, then of the digests of the texts."""
    number = F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(2**63)))
    place = F.coalesce(F.concat(F.lit("00"), F.lpad(F.hex(number), 16, "0")), F.lit("01" + "0" * 16))
    digest = F.coalesce(F.concat(F.lit("01"), F.md5(F.col("text"))), F.lit("00" * 17))
    return F.unhex(F.concat(place, digest))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class, once: that of the smallest id, null ones last, then of the smallest digest.

    Rows that are equal in id and text are one document; an id that repeats with other texts is several.
    """
    keyed = docs.withColumn("_key", document_key())
    classes = jaccard_join(keyed, words=5, num=4, den=5, id_col="_key").classes
    others = stored(classes.where("_key <> component_id").select("_key").distinct(), "others")
    heads = by_ids(keyed, others, "_key", "left_anti")
    again = stored(classes.where("_key = component_id").groupBy("_key").count().where("count > 1").select("_key"), "repeated")
    once, twice = (by_ids(heads, again, "_key", how) for how in ("left_anti", "left_semi"))
    return once.select(*docs.columns).union(twice.dropDuplicates(["_key"]).select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any span of a benchmark item, whether their ids are null, repeat or not."""
    keyed = docs.withColumn("_key", document_key())
    with scratch(spark) as kept:
        found = decontaminate(keyed, read_table(spark, sf_dir, "benchmark"), id_col="_key").documents
        hit = kept(found.where("n_hit > 0").select("_key").distinct(), "hit")
    return by_ids(keyed, hit, "_key", "left_anti").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, at tempered weights of the sources, none passed over more than twice."""
    return mix_sources(docs).select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, with its text, and its shard and slot."""
    return kd_shards(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Near duplicates and permutations are not expressible in SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in their shards: the last stage is written to a folder for each shard."""
    docs = read_table(prepared(spark), sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        by = ["shard"] if stage is sharding else []
        docs = stored(stage(spark, docs, sf_dir), f"stage-{number}", *by)
    return docs

"""The thirteen operators as queries over the whole given tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemeter.llm.decontamination import decontaminate
from tidemeter.llm.fixity import archived, audit_replicas
from tidemeter.llm.jaccard_join import jaccard_join
from tidemeter.llm.license_scan import license_scan
from tidemeter.llm.manifest import merkle_manifest
from tidemeter.llm.mixing import mix_sources
from tidemeter.llm.quality_rules import quality_rules
from tidemeter.llm.shared import prepared, read_table
from tidemeter.llm.sharding import kd_shards
from tidemeter.llm.simhash import simhash_groups
from tidemeter.llm.spelling import spelling_groups
from tidemeter.llm.token_counts import token_counts
from tidemeter.llm.token_files import read_token_files, write_token_files
from tidemeter.llm.url_filter import filter_urls
from tidemeter.session import run_dir

URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
WORD_END = 2


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(prepared(spark), sf_dir, "documents")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir), words=3, num=9, den=10).classes


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is labelled by the document of its number: bad if of low quality or toxic."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = read_table(prepared(spark), sf_dir, "labels").select(F.col("doc_id").alias("id"), bad.cast("int").alias("bad"))
    return filter_urls(read_table(spark, sf_dir, "pages"), labels, URL_RULES)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark")).documents
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through a cache that already holds the counts of those in English, as of an earlier delivery."""
    docs = documents(spark, sf_dir)
    cache = f"{run_dir(spark, 'token-cache')}/counts"
    tokenizer = _tokenizer("byte_bpe_50k.json")
    token_counts(docs.where("lang = 'en'"), tokenizer, cache)
    return token_counts(docs, tokenizer, cache)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(documents(spark, sf_dir))
    return mixed.select("doc_id", "source", "mix_weight", "mix_pass", "mix_block", "mix_tokens")


def op6_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replica holds the same records, with the first character overwritten in those whose id's digest begins with 00."""
    pages = read_table(prepared(spark), sf_dir, "pages")
    lost = F.substring(F.md5(F.col("page_id").cast("string")), 1, 2) == "00"
    copied = F.when(lost, F.concat(F.lit("x"), F.expr("substring(html, 2)"))).otherwise(F.col("html"))
    replicas = audit_replicas(archived(pages), archived(pages.withColumn("html", copied)))
    audit = replicas.records.unionByName(replicas.surplus)
    return audit.select(F.col("id").alias("page_id"), "archive", "seq", F.col("at").alias("record_at"), "length", "digest", "intact")


def op7_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards(documents(spark, sf_dir), keep_text=False)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(documents(spark, sf_dir), keep_text=False)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    folder = f"{run_dir(spark, 'token-files')}/files"
    index = write_token_files(docs, _tokenizer("word_bpe_49k.json"), folder, WORD_END)
    return read_token_files(index, folder).select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = license_scan(documents(spark, sf_dir))
    return scanned.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(documents(spark, sf_dir)).words


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir), words=3, differ=2).documents


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the documents is found in lower case later on."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return merkle_manifest(documents(spark, sf_dir), tampered).rows


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_jaccard_join,
        op2_url_filter,
        op3_decontamination,
        op4_token_counts,
        op5_source_mix,
        op6_warc_fixity,
        op7_kd_shards,
        op8_quality_rules,
        op9_token_files,
        op10_license_scan,
        op11_spelling_variants,
        op12_simhash_dedup,
        op13_merkle_manifest,
    )
}

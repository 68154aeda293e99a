"""SimHash near duplicates by deletion-variant signatures.

A fingerprint has 64 bits, each the majority of that bit in the hashes of all word shingles of a text. Two fingerprints link
when few bits differ (2). A signature cuts the bits that may still differ into two segments, so that one of them differs in at most
one bit, and says one of three things: the first segment is equal, the second is equal, or the first differs in exactly this bit, which
is deleted (a wildcard). Each fingerprint is indexed under all these variants; an equality join of the index with itself gives the candidates,
every linked pair among them, and their bits are compared.

*Large groups.* Fingerprints that share a signature may be very many. Those of a signature with up to ``MEETING`` of them meet
each other. The others are indexed again: their signature is extended by one of the segment that it left free, cut in the same way, which
loses no pair. After four turns four bits are free, so no signature has more than 2**5 fingerprints, and
nothing is left over. So no group is ever paired as a whole, and no pair is given up.

Copies of a text have one fingerprint and are one row of the index.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.llm.components import components
from tidemeter.llm.shared import map_arrow, prepared, stored

BITS = 64
SEED = 42
WORD = re.compile(rb"[^\x20\x09-\x0D]+")

# Fingerprints of one signature that meet each other directly; at least 2**5.
MEETING = 64

# Shingles of a text whose bits are added up at once.
ADDED = 1 << 14

# Fingerprints with more than this part of all documents; there are fewer than so many.
HOT = 4096


def fingerprint(text: str | None, size: int) -> int:
    """Bits set in over half of the hashes of the word shingles, repeats included; without words zero."""
    if not text:
        return 0
    words = WORD.findall(text.encode().lower())
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.dtype(">u8"), len(words) - size + 1)
    counts = np.zeros(BITS, dtype=np.int64)
    for first in range(0, len(hashes), ADDED):
        part = hashes[first : first + ADDED]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """id, fp (the 64 bits as a signed number)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(text.as_py(), size) for text in batch["text"]], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([batch["id"], pa.array(found.view(np.int64))], ["id", "fp"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_arrow(texts, measure, f"id {kind}, fp bigint")


def bits(value: Column, low: Column, width: int) -> Column:
    """``width`` (under 64) bits from bit ``low``."""
    return F.call_function("shiftrightunsigned", value, low).bitwiseAND((1 << width) - 1)


def signatures(rows: DataFrame, free: int) -> DataFrame:
    """Rows key, fp, low (lowest free bit), differ (bits that may differ there), extended by one of two segments of the
    ``free`` bits: key, side (the deleted bit, else null), fp, low, differ."""
    half = free // 2
    fp, low = F.col("fp"), F.col("low")
    upper = low + half
    key, first, second = F.col("key"), bits(fp, low, half), bits(fp, upper, half)

    def variant(kind: int, kept: Column, side: Column, left_low: Column, left: Column) -> Column:
        names = F.xxhash64(key, F.lit(kind), kept)
        return F.struct(names.alias("key"), side.alias("side"), left_low.alias("low"), left.alias("differ"))

    no_side = F.lit(None).cast("int")
    equal = [variant(-1, first, no_side, upper, F.col("differ")), variant(-2, second, no_side, low, F.col("differ"))]
    deleted = [
        variant(i, first.bitwiseAND(~(1 << i)), bits(first, F.lit(i), 1).cast("int"), upper, F.lit(1)) for i in range(half)
    ]
    every = F.when(F.col("differ") > 1, F.array(*equal, *deleted)).otherwise(F.array(*equal))
    return rows.select("fp", F.inline(every))


def links(distinct: DataFrame, differ: int = 2) -> DataFrame:
    """Pairs of the stored fingerprints ``fp`` that differ in at most ``differ`` (2) bits: a, b; enough pairs, each exact."""
    if not 1 <= differ <= 2:
        raise ValueError("signatures of two segments stand for one or two bits")
    rows = distinct.select("fp", F.lit(0).cast("long").alias("key"), F.lit(0).alias("low"), F.lit(differ).alias("differ"))
    free, found = BITS, []
    while True:
        index = signatures(rows, free)
        free //= 2
        sizes = index.groupBy("key").agg(
            F.count(F.lit(1)).alias("size"), F.min("side").alias("least"), F.max("side").alias("most"), F.min("low").alias("low"), F.min("differ").alias("differ")
        )
        several = (F.col("size") > 1) & (F.col("least").isNull() | (F.col("least") < F.col("most")))
        sizes = stored(sizes.where(several), "signatures")
        small = sizes.where((F.col("size") <= MEETING) | F.lit(free <= 4)).select("key")
        members = stored(index.join(small, "key").select("key", "side", "fp"), "members")
        one, other = members.alias("one"), members.alias("other")
        # Members of a side meet those of the other; without sides, each pair meets once.
        order = F.when(F.col("one.side").isNull(), F.col("one.fp") < F.col("other.fp")).otherwise(F.col("one.side") < F.col("other.side"))
        close = F.bit_count(F.col("one.fp").bitwiseXOR(F.col("other.fp"))) <= differ
        met = one.join(other, (F.col("one.key") == F.col("other.key")) & order & close)
        found.append(stored(met.select(F.col("one.fp").alias("a"), F.col("other.fp").alias("b")), "links"))
        large = sizes.where(F.col("size") > MEETING).select("key")
        if free <= 4 or large.isEmpty():
            break
        # The side stays part of the bits that are compared; the deleted bit may differ.
        rows = stored(index.join(large, "key").select("fp", "key", "low", "differ"), "large")
    for more in found[1:]:
        found[0] = found[0].union(more)
    return found[0].distinct()


@dataclass(frozen=True)
class SimHashGroups:
    """``documents``: id, fingerprint (16 hex digits), component_id, one row per input row. ``links``: pairs of fingerprints
    (a, b, as signed numbers) that connect the components."""

    documents: DataFrame
    links: DataFrame


def simhash_groups(
    docs: DataFrame, words: int = 5, differ: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> SimHashGroups:
    """Documents linked by fingerprints over shingles of ``words`` words that differ in at most ``differ`` bits.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A text of fewer words is one shingle; null, empty and wordless texts
    have the fingerprint zero and link like others. ``component_id`` is the smallest id reachable by links (null ids
    aside). Texts are read whole, long ones in parts. Rows that repeat, also an id, are documents of their own. Other columns are not
    touched; an empty input gives an empty result.
    """
    prepared(docs.sparkSession)
    marked = stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("size")), "distinct")
    pairs = stored(links(distinct.select("fp"), differ), "pairs")
    labels = components(pairs)
    labelled = distinct.join(labels, distinct["fp"] == labels["node"], "left").select("fp", "least", "size", F.coalesce("label", "fp").alias("label"))
    labelled = stored(labelled, "labelled")
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = stored(labelled.join(smallest, "label").select("fp", "size", "component_id"), "named")
    # Fingerprints of a large part of all documents are few, so their documents need no shuffle.
    hot = F.col("size") > marked.count() / HOT
    common = named.where(hot).select(F.col("fp").alias("fp"), "component_id")
    rare = named.where(~hot).select("fp", "component_id")
    of_common = marked.join(F.broadcast(common), "fp")
    of_rare = marked.join(F.broadcast(common.select("fp")), "fp", "left_anti").join(rare, "fp")
    documents = of_common.unionByName(of_rare).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
    return SimHashGroups(documents, pairs)

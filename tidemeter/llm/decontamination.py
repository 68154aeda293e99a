"""Benchmark decontamination by winnowing.

Of each run of ``window`` consecutive k-gram hashes the smallest is kept (of equal ones the last) as a fingerprint, in documents and in
benchmark items alike. A shared span of ``k + window - 1`` words holds the same run of hashes on both sides and so
the same fingerprint, which makes every shared span of that many words certain to be found. Fingerprints are joined;
each hit names a diagonal (document place minus item place) on which the words are compared in both directions; runs
of equal words of the guaranteed length are the contaminated spans.

Items shorter than that length match as a whole: for each such length L, all L-grams are fingerprints.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemeter.llm.shared import by_ids, map_arrow, prepared, stored
from tidemeter.llm.words import ALNUM, U64, mix, runs, word_hashes

# The filter that spares most fingerprints a shuffle: a bit set of fixed size, so its broadcast is bounded.
FILTER_BITS = 22


@dataclass(frozen=True)
class Decontamination:
    """``documents``: id, n_words, n_hit, items (sorted item ids), spans (start, end), one row per document row.
    ``hits``: id, item, start, end: each shared span by item."""

    documents: DataFrame
    hits: DataFrame


def winnow(words: np.ndarray, at: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the fingerprints of all texts of a slice; a text's k-grams stay within it."""
    grams = runs(words, k, 20 + k)
    count = len(grams) - window + 1
    if count <= 0:
        return np.zeros(0, dtype=np.int64), grams[:0]
    least, place = grams[:count].copy(), np.zeros(count, dtype=np.int64)
    for j in range(1, window):
        later = grams[j : j + count]
        take = later <= least
        least[take], place[take] = later[take], j
    starts = np.arange(count)
    text = np.searchsorted(at, starts, "right") - 1
    inside = starts + k + window - 1 <= at[text + 1]
    places = np.unique((starts + place)[inside])
    return places, grams[places]


def fingerprints(words: np.ndarray, at: np.ndarray, span: int, k: int, short: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed fingerprints and, for each length of ``short``, all runs of it."""
    found = [winnow(words, at, k, span - k + 1)]
    for length in short:
        grams = runs(words, length, 50 + length)
        starts = np.arange(len(grams))
        text = np.searchsorted(at, starts, "right") - 1
        inside = starts + length <= at[text + 1]
        found.append((starts[inside], grams[inside]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _bit(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes, 30) >> U64(64 - FILTER_BITS)).astype(np.int64)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def equal_spans(doc: np.ndarray, item: np.ndarray, diagonal: int, least: int) -> list[tuple[int, int]]:
    """Maximal runs of at least ``least`` equal words on a diagonal, as places in the document."""
    start, end = max(0, diagonal), min(len(doc), len(item) + diagonal)
    same = np.concatenate([[False], doc[start:end] == item[start - diagonal : end - diagonal], [False]])
    edges = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2)
    return [(start + a, start + b) for a, b in edges.tolist() if b - a >= least]


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    span: int = 10,
    k: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> Decontamination:
    """Spans of ``span`` or more words that documents share with benchmark items; shorter items count as a whole.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Null and wordless texts have no words and
    no hits; rows of the benchmark with a null id or no words match nothing. A document is an id and a text: rows that
    repeat an id, or have none, have the hits of their own text only. Items of one id share their name. Long texts are read
    whole. An empty benchmark gives no hits, empty documents an empty result.
    """
    spark = prepared(docs.sparkSession)
    text = F.col(text_col)
    texts = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("digest"), text.alias("text"))
    tests = benchmark.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(item_text_col), F.lit("")).alias("item_text")
    ).distinct()
    kind = texts.schema["id"].dataType.simpleString()

    def item_prints(batch: pa.RecordBatch) -> pa.RecordBatch:
        items, lengths, places, hashes = [], [], [], []
        for first, at, words in word_hashes(batch["item_text"], ALNUM):
            for i, (start, end) in enumerate(zip(at[:-1], at[1:])):
                own, n = words[start:end], int(end - start)
                if not n:
                    continue
                edge = np.array([0, n])
                where, found = winnow(own, edge, k, span - k + 1) if n >= span else (np.zeros(1, np.int64), runs(own, n, 50 + n))
                items.append(np.full(len(found), first + i))
                lengths.append(np.full(len(found), min(n, span)))
                places.append(where)
                hashes.append(found)
        items, lengths, places = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (items, lengths, places))
        hashes = np.concatenate([np.zeros(0, U64), *hashes])
        columns = [batch["item"].take(pa.array(items)), pa.array(hashes.view(np.int64)), pa.array(places), pa.array(lengths), pa.array(_bit(hashes))]
        return pa.RecordBatch.from_arrays(columns, ["item", "hash", "at", "least", "bit"])

    prints = stored(map_arrow(tests, item_prints, "item string, hash bigint, at bigint, least bigint, bit bigint"), "prints")
    # 2**FILTER_BITS bits at most, as words of 32; and the lengths below the span, of which there are span - 1.
    word = F.shiftright("bit", 5).alias("word")
    mask = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.expr("int(bit & 31)"))).alias("mask")
    filled = np.zeros(1 << (FILTER_BITS - 5), dtype=np.int64)
    for row in prints.groupBy(word).agg(mask).toLocalIterator():
        filled[row["word"]] = row["mask"]
    short = tuple(sorted(r[0] for r in prints.where(F.col("least") < span).select("least").distinct().collect()))

    def doc_prints(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, counts, places, hashes = [], [], [np.zeros(0, np.int64)], [np.zeros(0, U64)]
        for _, at, words in word_hashes(batch["text"], ALNUM):
            where, found = fingerprints(words, at, span, k, short)
            bit = _bit(found)
            likely = (filled[bit >> 5] >> (bit & 31)) & 1 == 1
            where, found = where[likely], found[likely]
            order = np.argsort(where, kind="stable")
            where, found = where[order], found[order]
            text = np.searchsorted(at, where, "right") - 1
            n_words.append(np.diff(at))
            counts.append(np.bincount(text, minlength=len(at) - 1))
            places.append(where - at[text])
            hashes.append(found)
        counts = np.concatenate(counts)
        lists = _lists(np.concatenate(places), counts), _lists(np.concatenate(hashes).view(np.int64), counts)
        columns = [batch["id"], batch["digest"], pa.array(np.concatenate(n_words).astype(np.int64)), *lists]
        return pa.RecordBatch.from_arrays(columns, ["id", "digest", "n_words", "places", "hashes"])

    schema = f"id {kind}, digest binary, n_words bigint, places array<bigint>, hashes array<bigint>"
    counted = stored(map_arrow(texts, doc_prints, schema), "counted")
    doc_marks = counted.where(F.size("hashes") > 0).select("id", "digest", F.explode(F.arrays_zip("places", "hashes")).alias("mark"))
    marks = doc_marks.select("id", "digest", F.col("mark.places").alias("place"), F.col("mark.hashes").alias("hash"))
    diagonal = (F.col("place") - F.col("at")).alias("diagonal")
    lines = marks.join(prints, "hash").groupBy("id", "digest", "item", diagonal).agg(F.min("least").alias("least"))
    pairs = lines.groupBy("id", "digest", "item").agg(F.collect_set("diagonal").alias("diagonals"), F.min("least").alias("least"))
    pairs = stored(pairs, "candidates")

    suspects = stored(pairs.where("id IS NOT NULL").select("id").distinct(), "suspects")
    texts_of = by_ids(texts, suspects, "id", "left_semi").union(texts.where("id IS NULL"))

    def extend(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Compare words along the diagonals."""
        doc_words = _by_row(batch["text"])
        item_words = _by_row(batch["item_text"])
        rows, starts, ends = [], [], []
        for i, (diagonals, least) in enumerate(zip(batch["diagonals"].to_pylist(), batch["least"].to_pylist())):
            for d in diagonals:
                for start, end in equal_spans(doc_words[i], item_words[i], d, least):
                    rows.append(i)
                    starts.append(start)
                    ends.append(end)
        taken = pa.array(rows, pa.int64())
        own = [batch[name].take(taken) for name in ("id", "digest", "item")]
        return pa.RecordBatch.from_arrays([*own, pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["id", "digest", "item", "start", "end"])

    same = pairs["id"].eqNullSafe(texts_of["id"]) & (pairs["digest"] == texts_of["digest"])
    filled_in = pairs.join(tests, "item").join(texts_of, same).select(
        pairs["id"], pairs["digest"], "item", "item_text", "text", "diagonals", "least"
    )
    hits = stored(
        map_arrow(filled_in, extend, f"id {kind}, digest binary, item string, start bigint, end bigint").distinct(), "hits"
    )
    spans = hits.groupBy("id", "digest").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"),
        F.array_sort(F.collect_set("item")).alias("items"),
    )
    # Length of the union: each span counts from where the ones before it end.
    added = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["to"]))).alias("n"),
            F.greatest(acc["to"], s["end"]).alias("to"),
        ),
    )
    found = spans.select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), "spans", "items", added["n"].alias("n_hit"))
    joined = counted.select("id", "digest", "n_words").join(
        found, F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left"
    )
    none = F.array().cast("array<string>"), F.array().cast("array<struct<start:bigint,end:bigint>>")
    result = joined.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", none[0]).alias("items"),
        F.coalesce("spans", none[1]).alias("spans"),
    )
    return Decontamination(result, hits.select(F.col("id").alias(id_col), "item", "start", "end"))


def _by_row(texts: pa.Array) -> list[np.ndarray]:
    rows = []
    for _, at, words in word_hashes(texts, ALNUM):
        rows += [words[a:b] for a, b in zip(at[:-1], at[1:])]
    return rows

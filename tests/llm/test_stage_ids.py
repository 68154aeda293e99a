"""Stages of the pipeline on null and repeated ids, against brute force."""

from __future__ import annotations

import hashlib
import random

from frames import documents, rows, sentence
from test_pairs import brute_classes, brute_hits, edited

import corpus_pipeline


def odd_ids():
    rng, data = random.Random(11), []
    for group in range(6):
        base = sentence(700 + group, 60)
        for i in range(6):
            number = [None, 10 * group + i, 5, -group, 10 * group + i, None][i]
            data.append((number, edited(base, rng, i % 3), "en", "s", 1))
    leak = sentence(31, 25)
    same = [sentence(41, 30), sentence(42, 10) + " " + leak[: leak.rindex(" ")] + " " + sentence(43, 10 - 4)]
    data += [(None, sentence(5, 30) + " " + leak, "en", "s", 1), (8, leak + " " + sentence(6, 30), "en", "s", 1), (8, sentence(7, 55), "en", "s", 1)]
    data += [(9, t, "en", "s", 1) for t in same] + [(None, sentence(8, 30), "en", "s", 1)] * 2
    return data, [(0, leak)]


def order(row):
    return row[0] is None, row[0] or 0, hashlib.md5(row[1].encode()).hexdigest()


def test_near_duplicates(spark):
    data, _ = odd_ids()
    distinct = sorted({r[:2] for r in data}, key=order)
    classes = brute_classes([(i, text) for i, (_, text) in enumerate(distinct)], 5, 4, 5)
    expected = [distinct[i] for i in sorted({least for _, _, least in classes})]
    found = corpus_pipeline.near_duplicates(spark, documents(spark, data), "")
    assert len(expected) < len(distinct) < len(data)
    assert sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=order) == expected


def test_decontamination(spark, tmp_path):
    data, items = odd_ids()
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = [r for r, hit in zip(data, brute_hits(data, items, 10)) if not hit[2]]
    found = corpus_pipeline.decontamination(spark, documents(spark, data), str(tmp_path))
    assert 0 < len(data) - len(clean) < 6
    assert rows(found, "doc_id", "text") == rows(documents(spark, clean), "doc_id", "text")

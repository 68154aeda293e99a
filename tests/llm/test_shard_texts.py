"""Shards hold the texts of their documents."""

from __future__ import annotations

import zlib

from frames import awkward, clashing, documents, rows, sentence

import corpus_pipeline
from tidemeter.llm.sharding import kd_shards


def test_rows_keep_their_texts(spark):
    data = awkward() + [(100 + i, sentence(i % 150, 30), "en", f"s{i % 7}", i) for i in range(300)]
    data += [(0, "", "en", "t", 1), (0, None, "de", "u", 2), (0, None, "de", "u", 2), (0, "other", "de", "u", 2), (None, "", "fr", "v", 3)]
    frame = documents(spark, data)
    placed = kd_shards(clashing(frame))
    assert rows(placed, *frame.columns) == rows(frame, *frame.columns)
    assert all(r["text_crc32"] == zlib.crc32((r["text"] or "").encode()) for r in placed.collect())
    assert "text" not in kd_shards(frame, keep_text=False).columns
    assert kd_shards(documents(spark, [])).count() == 0


def test_pipeline_writes_texts_into_shards(spark, tmp_path):
    data = [(i, sentence(i, 40), "en", "s", 1) for i in range(300)] + [(300, sentence(1, 40) + " tail", "en", "s", 1)]
    documents(spark, data).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, "no such words here")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path))
    texts = {r[0]: r[1] for r in data}
    assert found.count() > 290 and all(r["text"] == texts[r["doc_id"]] for r in found.collect())
    assert {f.split("shard=")[1].split("/")[0] for f in found.inputFiles()} == {str(i) for i in range(8)}

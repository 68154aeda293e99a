"""Reading of requested documents from token files."""

from __future__ import annotations

import pytest
from frames import awkward, documents, rows, sentence
from pyspark.sql import functions as F

from tidemeter.llm import token_files

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_only_frames_of_requested_documents_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_BYTES", 2_000)
    folder = tmp_path / "files"
    data = awkward() + [(100 + 3 * i, sentence(i, 30), "en", "s", 1) for i in range(400)]
    index = token_files.write_token_files(documents(spark, data), str(public_tokenizers.path("word_bpe_49k.json")), str(folder), 2)
    everything = token_files.read_token_files(index, str(folder)).collect()
    assert index.count() > 40
    for wanted in ([100, 1003, 5], [None, 400, 400], [101], [], [None]):
        ids = spark.createDataFrame([(i,) for i in wanted], "id bigint")
        chosen = {(r["file"], r["at"]) for r in token_files.requested_frames(index, ids).collect()}
        expected = set()
        for r in index.collect():
            inside = any(r["first_id"] is not None and r["first_id"] <= i <= r["last_id"] for i in wanted if i is not None)
            if inside or r["unknown"] and None in wanted:
                expected.add((r["file"], r["at"]))
        assert chosen == expected and len(chosen) <= 6
        kept = {}
        for r in index.collect():  # a frame that is read though not requested fails
            path = folder / r["file"]
            kept.setdefault(path, path.read_bytes())
            if (r["file"], r["at"]) not in chosen:
                with path.open("r+b") as file:
                    file.seek(r["at"])
                    file.write(bytes(r["packed"]))
        found = token_files.read_documents(index, str(folder), ids)
        names = ["id", "start", "n_tokens", "ids_crc32", "tokens"]
        key = lambda r: [(v is not None, str(v)) for v in r]
        assert rows(found, *names) == sorted((tuple(r[n] for n in names) for r in everything if r["id"] in wanted), key=key)
        for path, whole in kept.items():
            path.write_bytes(whole)


def test_frames_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_BYTES", 2_000)
    data = [(i, sentence(i, 30), "en", "s", 1) for i in range(200)]
    index = token_files.write_token_files(documents(spark, data), str(public_tokenizers.path("word_bpe_49k.json")), str(tmp_path / "files"), 2)
    found = token_files.read_token_files(index, str(tmp_path / "files"))
    assert index.count() >= 8 and found.count() == 200
    assert found.select(F.spark_partition_id()).distinct().count() > 1

"""Copies of a text share a shard; blocks of a source are summed in runs; counts come from a cache that is partly filled."""

from __future__ import annotations

from collections import Counter, defaultdict

from frames import documents, rows, sentence

from tidemeter.llm import mixing, queries
from tidemeter.llm.pieces import library
from tidemeter.llm.sharding import kd_shards


def test_copies_share_a_shard(spark):
    texts = [sentence(i, 20 + i % 30) for i in range(400)]
    data = [(i, text, "en", f"s{i % 5}", 1) for i, text in enumerate(texts)]
    data += [(1000 + 10 * i + j, texts[i], "de", f"s{j}", 1) for i in range(60) for j in range(1 + i % 3)]
    placed = kd_shards(documents(spark, data)).collect()
    shards = defaultdict(set)
    for row in placed:
        shards[row["text"]].add(row["shard"])
    assert {len(s) for s in shards.values()} == {1}
    sizes = Counter()
    for row in placed:
        sizes[row["shard"]] += row["size"]
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and max(abs(s - mean) for s in sizes.values()) < mean / 8


def test_heavy_copies_are_split(spark):
    data = [(i, sentence(i, 30), "en", "s", 1) for i in range(400)] + [(1000 + i, sentence(7, 30), "en", "s", 1) for i in range(300)]
    placed = kd_shards(documents(spark, data)).collect()
    sizes = Counter()
    for row in placed:
        sizes[row["shard"]] += row["size"]
    mean = sum(sizes.values()) / 8
    assert len({row["shard"] for row in placed if row["text"] == sentence(7, 30)}) > 1
    assert len(sizes) == 8 and max(abs(s - mean) for s in sizes.values()) < mean / 8
    others = defaultdict(set)
    for row in placed:
        others[row["text"]].add(row["shard"])
    assert all(len(s) == 1 for text, s in others.items() if text != sentence(7, 30))
    assert kd_shards(documents(spark, data), tolerance=10).where(f"text = '{sentence(7, 30)}'").select("shard").distinct().count() == 1


def test_block_sums_in_runs(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN_BLOCKS", 4)
    blocks = [(s, 5, b, 1 + (7 * b) % 11) for s in (None, "a", "b") for b in range(50) if (b + len(s or "")) % 3]
    frame = spark.createDataFrame(blocks, "_source string, _rest bigint, block bigint, tokens bigint")
    wanted = [(s, r, b, t, sum(t2 for s2, _, b2, t2 in blocks if s2 == s and b2 < b)) for s, r, b, t in blocks]
    found = rows(mixing._tokens_before(frame), "_source", "_rest", "block", "tokens", "gone")
    assert found == sorted(wanted, key=lambda r: [(v is not None, str(v)) for v in r])


def test_token_query_meets_hits_and_misses(spark, tmp_path):
    data = [(i, sentence(i % 40, 15), "en" if i % 3 else "fr", "s", 1) for i in range(90)]
    data += [(100, None, None, None, None), (101, "", "en", "s", 0), (102, "only French", "fr", "s", 1)]
    documents(spark, data).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["doc_id"]: r for r in queries.op4_token_counts(spark, str(tmp_path)).collect()}
    english = {text or "" for _, text, lang, *_ in data if lang == "en"}
    encode = library(queries._tokenizer("byte_bpe_50k.json")).encode
    counts = [len(encode(text or "", add_special_tokens=False).ids) for _, text, *_ in data]
    assert [found[d]["n_tokens"] for d, *_ in data] == counts
    assert [found[d]["cached"] for d, *_ in data] == [(text or "") in english for _, text, *_ in data]
    assert {r["cached"] for r in found.values()} == {True, False}

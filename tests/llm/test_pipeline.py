"""The pipeline's stages against plain Python, and the queries that SQL can express."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from frames import awkward, clashing, documents, rows, sentence
from test_pairs import brute_classes, brute_hits, near_copies
from test_rows import brute_quality
from test_stage_ids import order

import corpus_pipeline
from tidemeter.llm.oracle import ORACLE_SQL
from tidemeter.llm.queries import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A data folder with a benchmark whose item stands in one document."""
    path = tmp_path_factory.mktemp("data")
    items = [(0, sentence(31, 25)), (1, None)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(path / "benchmark.parquet"))
    leak = (7000, sentence(5, 30) + " " + sentence(31, 25) + " " + sentence(6, 30), "en", "a", 1)
    documents(spark, [*near_copies(), leak]).write.parquet(str(path / "documents.parquet"))
    return str(path), [*near_copies(), leak], items


def test_stages(spark, folder):
    path, data, items = folder
    docs = documents(spark, data)
    kept = corpus_pipeline.quality(spark, docs, path)
    good = [r for r in data if (m := brute_quality(r[1]))[0] >= 20 and 100 * m[4] <= 30 * m[0]]
    assert rows(kept, "doc_id", "text") == rows(documents(spark, good), "doc_id", "text")

    single = corpus_pipeline.near_duplicates(spark, kept, path)
    distinct = sorted({r[:2] for r in good}, key=order)
    classes = brute_classes([(i, text) for i, (_, text) in enumerate(distinct)], 5, 4, 5)
    one = [distinct[i] for i in sorted({least for _, _, least in classes})]
    assert sorted(((r["doc_id"], r["text"]) for r in single.collect()), key=order) == one
    assert len({i for i, _ in one}) < len(one) < len(distinct)  # an id stays twice, with two texts

    clean = corpus_pipeline.decontamination(spark, single, path)
    free = [row for row, hit in zip(one, brute_hits(one, items, 10)) if not hit[2]]
    assert len(free) == len(one) - 1 and 7000 in {i for i, _ in free}
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=order) == free

    mixed = corpus_pipeline.mixing(spark, clean, path)
    assert mixed.columns == docs.columns
    assert {r["doc_id"] for r in mixed.collect()} <= {r["doc_id"] for r in clean.collect()}
    placed = corpus_pipeline.sharding(spark, mixed, path)
    assert placed.count() == mixed.count()


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder[0]).count() > 0


def test_empty_and_awkward_stages(spark, folder):
    for data in ([], awkward()):
        docs = clashing(documents(spark, data))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder[0])
            docs.count()
        assert corpus_pipeline.sharding(spark, docs, folder[0]).count() == docs.count()


@pytest.mark.skipif(not SF_DIR.exists(), reason="no test data")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries(spark, name):
    result = QUERIES[name](spark, str(SF_DIR))
    if name not in ORACLE_SQL:
        assert result.count() > 0
        return
    database = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        database.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    cursor = database.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(result.columns)
    assert rows(result, *names) == sorted(cursor.fetchall(), key=lambda r: [(v is not None, str(v)) for v in r])

"""Jaccard join, components and decontamination against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from frames import ALNUM, awkward, clashing, documents, rows, sentence, words

from tidemeter.llm.components import components
from tidemeter.llm.decontamination import decontaminate
from tidemeter.llm.jaccard_join import jaccard_join, parities
from tidemeter.llm.words import SPACED, word_hashes


def shingles(text, size):
    found = words(text)
    if len(found) < size:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def brute_classes(data, size, num, den):
    sets = [shingles(text, size) for _, text, *_ in data]
    parent = list(range(len(data)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and den * shared >= num * len(sets[i] | sets[j]):
                parent[top(i)] = top(j)
    groups = {}
    for i, row in enumerate(data):
        groups.setdefault(top(i), []).append(row[0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return [(row[0], len(sets[i]), least[top(i)]) for i, row in enumerate(data)]


def edited(text, rng, changes):
    found = text.split()
    for _ in range(changes):
        found[rng.randrange(len(found))] = f"e{rng.randrange(10_000)}"
    return " ".join(found)


def test_parities_never_differ_in_more_bits_than_the_sets_in_members():
    rng = np.random.default_rng(5)
    universe = rng.integers(0, 2**63, 3_000, dtype=np.uint64)
    base = universe[:400]
    sets = [base[:0], base, base, np.delete(base, 3), *(np.unique(np.append(base[k:], universe[400 : 400 + 40 * k])) for k in range(1, 60))]
    sizes = np.array([len(s) for s in sets])
    found = np.array(parities(sizes, np.concatenate(sets))).T.view(np.uint64)
    bits = lambda a, b: sum(int(x).bit_count() for x in a ^ b)
    assert bits(found[1], found[2]) == 0 and bits(found[1], found[3]) == 1
    assert not found[0].any()
    for one, a in zip(sets, found):
        for other, b in zip(sets, found):
            assert bits(a, b) <= len(np.setxor1d(one, other))


def near_copies():
    """Chains, dense groups around a hidden base, and unrelated texts that share most of their words."""
    rng = random.Random(7)
    data = awkward()
    for group in range(4):
        base = sentence(100 + group, 120)
        data += [(1000 * group + 100 + i, edited(base, rng, rng.randrange(6)), "en", "a", 1) for i in range(25)]
        chain = base
        for i in range(10):
            chain = edited(chain, rng, 1)
            data.append((1000 * group + 500 + i, chain, "en", "b", 1))
    border = sentence(998, 120)
    data += [(7000 + i, edited(border, rng, 2 + i % 4), "en", "d", 1) for i in range(60)]
    passage = sentence(999, 80)
    data += [(9000 + i, passage + " " + sentence(2000 + i, 20), "en", "c", 1) for i in range(30)]
    return data


@pytest.mark.parametrize(("size", "num", "den"), [(3, 9, 10), (5, 4, 5)])
def test_classes(spark, size, num, den):
    data = near_copies()
    found = jaccard_join(clashing(documents(spark, data)), size, num, den).classes
    key = lambda r: [(v is not None, str(v)) for v in r]
    assert rows(found, "doc_id", "n_shingles", "component_id") == sorted(brute_classes(data, size, num, den), key=key)


def test_empty_tables(spark):
    none = documents(spark, [])
    assert jaccard_join(none).classes.count() == 0
    assert decontaminate(none, spark.createDataFrame([], "item_id bigint, text string")).documents.count() == 0


def test_components_of_long_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    found = components(spark.createDataFrame([*path, *star, (5000, 5000)], "a bigint, b bigint"))
    groups = {}
    for row in found.collect():
        groups.setdefault(row["label"], set()).add(row["node"])
    assert sorted(map(len, groups.values())) == [200, 301]


def test_words_of_a_batch_equal_single_words():
    texts = [t for _, t, *_ in awkward()]
    seen = {}
    for first, at, hashes in word_hashes(pa.array(texts), SPACED):
        for i, (a, b) in enumerate(zip(at[:-1], at[1:])):
            found = words(texts[first + i])
            assert len(found) == b - a
            for word, value in zip(found, hashes[a:b]):
                assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def brute_hits(data, items, span):
    windows = {}
    for item, text in items:
        found = words(text, ALNUM)
        size = min(span, len(found))
        for i in range(len(found) - size + 1 if found else 0):
            windows.setdefault(tuple(found[i : i + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    result = []
    for doc_id, text, *_ in data:
        found, hit, names = words(text, ALNUM), set(), set()
        for size in sizes:
            for i in range(len(found) - size + 1):
                if got := windows.get(tuple(found[i : i + size])):
                    hit.update(range(i, i + size))
                    names |= got
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        result.append((doc_id, len(found), len(hit), len(names), digest))
    return result


def test_decontamination(spark):
    from pyspark.sql import functions as F

    rng = random.Random(3)
    items = [(i, sentence(50 + i, rng.choice([1, 3, 9, 10, 11, 30, 59]))) for i in range(20)]
    items += [(20, items[5][1]), (21, None), (22, ""), (None, "w1"), (23, "..."), (24, sentence(55, 30) + " " + sentence(55, 30))]
    data = [*awkward(), (None, "no hit here", None, None, None)]
    leak, clean = " ".join(words(items[5][1], ALNUM)[:9]) + " w1 " + sentence(61, 20, 5000), sentence(62, 30, 5000)
    data += [(i, t, "en", "s", 1) for i in (5, None, 7) for t in (leak, clean, leak)]  # of equal length
    for i in range(60):
        text = sentence(3000 + i, 40, 5000)
        found = words(items[rng.randrange(20)][1], ALNUM)
        cut = found[rng.randrange(len(found)) :][: rng.randrange(1, 40)]
        data.append((100 + i, f"{text}, {'; '.join(cut).title()}! {sentence(4000 + i, 30, 5000)}", "en", "s", 1))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate(clashing(documents(spark, data)), bench).documents.select(
        "doc_id", "n_words", "n_hit", F.size("items").alias("m"), F.sha2(F.array_join("items", ","), 256).alias("d")
    )
    real = [x for x in items if x[0] is not None]
    key = lambda r: [(v is not None, str(v)) for v in r]
    assert rows(found, "doc_id", "n_words", "n_hit", "m", "d") == sorted(brute_hits(data, real, 10), key=key)


def test_winnowing_guarantee():
    """Every shared run of ten words shares a fingerprint, at whatever place."""
    from tidemeter.llm.decontamination import winnow

    rng = np.random.default_rng(1)
    for _ in range(200):
        run = rng.integers(0, 2**63, 10).astype(np.uint64)
        marks = []
        for _ in range(2):
            parts = [rng.integers(0, 2**63, rng.integers(0, 20)).astype(np.uint64), run, rng.integers(0, 2**63, rng.integers(0, 20)).astype(np.uint64)]
            text = np.concatenate(parts)
            marks.append(set(winnow(text, np.array([0, len(text)]), 8, 3)[1].tolist()))
        assert marks[0] & marks[1]


def test_cells_of_sizes_too_far_apart_are_not_kept(spark, monkeypatch):
    """Every word is shared by a long and a short document, which cannot link; two short ones are near copies."""
    from tidemeter.llm import jaccard_join as module

    rows = [(i, " ".join(f"w{k}" for k in range(100) if k % 2 == i)) for i in range(2)]
    rows += [(10 + i, " ".join(f"w{k}" for k in range(5 * i, 5 * i + 5))) for i in range(20)]
    kept = {}

    def counted(df, label, *by, of=module.stored):
        frame = of(df, label, *by)
        kept.setdefault(label, frame.count())
        return frame

    monkeypatch.setattr(module, "stored", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = module.jaccard_join(docs, words=1, segments=False).classes
    assert all(r.doc_id == r.component_id for r in classes.collect()) and kept["cells"] == 0
    copies = docs.union(spark.createDataFrame([(50, rows[5][1] + " x")], docs.schema))
    linked = module.jaccard_join(copies, words=1, segments=False).classes.where("doc_id <> component_id")
    assert [(r.doc_id, r.component_id) for r in linked.collect()] == [(50, rows[5][0])]

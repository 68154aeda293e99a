"""Fine parities of the Jaccard join."""

from __future__ import annotations

import numpy as np

from tidemeter.llm.jaccard_join import Threshold, fine_parities


def fine_rows(sets):
    sizes = np.array([len(s) for s in sets])
    counts, words = fine_parities(sizes, np.concatenate(sets))
    ends = np.cumsum(counts)
    return [([int(w) for w in words[end - count : end]], int(size)) for end, count, size in zip(ends, counts, sizes)]


def test_fine_parities_drop_large_unrelated_sets_and_no_linked_pair(spark):
    rng = np.random.default_rng(11)
    universe = np.unique(rng.integers(0, 2**63, 60_000, dtype=np.uint64))
    pairs = []
    for size in (1, 5, 31, 33, 500, 2_048, 2_100, 9_000):  # 2,048 and 9,000 lie on or near a change of length
        base = universe[:size]
        for more in (0, size // 20, size // 4):
            pairs.append((base, universe[: size + more], 5 * size >= 4 * (size + more)))
    large = [(universe[s : s + 5_000], universe[s + 5_000 : s + 9_800], False) for s in (0, 10_000, 20_000)]
    shown = []
    for one, two, linked in pairs + large:
        (fine, n), (p_fine, p_n) = fine_rows([one, two])
        shown.append((fine, n, p_fine, p_n, linked))
    frame = spark.createDataFrame(shown, "fine array<bigint>, n bigint, p_fine array<bigint>, p_n bigint, linked boolean")
    for flip in (False, True):
        seen = frame.select("linked", (Threshold(4, 5)).finely_near().alias("near"), "n")
        if flip:
            swapped = frame.toDF("p_fine", "p_n", "fine", "n", "linked")
            seen = swapped.select("linked", (Threshold(4, 5)).finely_near().alias("near"), "n")
        found = [(r["linked"], r["near"]) for r in seen.collect()]
        assert all(near for linked, near in found if linked)
        assert [near for _, near in found[-len(large) :]] == [False] * len(large)

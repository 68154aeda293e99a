"""Entropies of source weights below that of the natural shares, and those that no exponent reaches."""

from __future__ import annotations

import math

import pytest
from frames import documents, sentence

from tidemeter.llm.mixing import MixTarget, find_exponent, mix_sources


def weights(totals, exponent):
    largest = max(totals.values())
    powers = {s: (t / largest) ** exponent for s, t in totals.items()}
    return {s: p / sum(powers.values()) for s, p in powers.items()}


def entropy(shares):
    return -sum(w * math.log(w) for w in shares if w > 0)


@pytest.mark.parametrize("totals", [{"a": 600, "b": 300, "c": 100}, {"a": 10**9, "b": 10**9 - 1000, "c": 5}])
@pytest.mark.parametrize("wanted", [0.9, 0.5, 0.02])
def test_exponent_over_one(spark, totals, wanted):
    frame = spark.createDataFrame(list(totals.items()), "source string, tokens bigint")
    if wanted > math.log(2) and totals["c"] == 5:
        wanted = 0.693
    exponent = find_exponent(frame, MixTarget(entropy=wanted))[0]
    assert abs(entropy(weights(totals, exponent).values()) - wanted) < 1e-6
    assert exponent > 1 or wanted >= entropy(t / sum(totals.values()) for t in totals.values())


def test_entropies_out_of_reach_fail(spark):
    frame = spark.createDataFrame([("a", 500), ("b", 500), ("c", 100)], "source string, tokens bigint")
    for wanted in (0.6, 1.2, -0.1):
        with pytest.raises(ValueError):
            find_exponent(frame, MixTarget(entropy=wanted))


def test_mix_of_low_entropy(spark):
    data = [(1000 * k + i, sentence(i, 20), "en", f"s{k}", 1) for k, n in enumerate((200, 100, 50)) for i in range(n)]
    mixed = mix_sources(documents(spark, data), MixTarget(entropy=0.5, block_tokens=100)).collect()
    found = {r["source"]: r["mix_weight"] for r in mixed}
    assert abs(entropy(found.values()) - 0.5) < 1e-6
    taken = {s: sum(r["mix_tokens"] for r in mixed if r["source"] == s) for s in found}
    assert all(abs(taken[s] - 7000 * w) <= 21 for s, w in found.items())

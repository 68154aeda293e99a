"""Spelling variants, SimHash and the Merkle manifest against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from frames import awkward, clashing, documents, rows, words
from pyspark.sql import functions as F

from tidemeter.llm import simhash, spelling
from tidemeter.llm.manifest import merkle_manifest
from tidemeter.llm.simhash import simhash_groups
from tidemeter.llm.spelling import neighbours, spelling_groups


def ordered(found):
    return sorted(found, key=lambda r: [(v is not None, str(v)) for v in r])


# -- spelling variants --


def near_words(known):
    """Pairs one edit apart, from words without one code point and with one left open."""
    near, wild = defaultdict(set), defaultdict(set)
    for word in known:
        for i in range(len(word)):
            wild[word[:i], word[i + 1 :]].add(word)
            if (shorter := word[:i] + word[i + 1 :]) in known:
                near[word].add(shorter)
                near[shorter].add(word)
    for group in wild.values():
        for word in group:
            near[word] |= group - {word}
    return near


def brute_spelling(data):
    counts = Counter()
    for doc_id, text, *_ in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.encode().lower().decode()
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    known = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = near_words(known)
    form = {w: min(near[w], key=lambda x: (-known[x], x)) for w in known if near[w]}
    form = {w: f for w, f in form.items() if known[f] >= 10 * known[w]}
    found = []
    for word, n in known.items():
        root = word
        while root in form:
            root = form[root]
        found.append((word, form.get(word), root, n, len(near[word]), known.get(form.get(word))))
    return ordered(found)


def edited(word, rng):
    i, kind = rng.randrange(len(word) + 1), rng.randrange(3)
    letter = rng.choice("abcdeéÀÿ")
    return [word[:i] + letter + word[i:], word[:i] + word[i + 1 :], word[:i] + letter + word[i + 1 :]][kind]


def misspelt():
    rng, data = random.Random(4), awkward()
    base = ["".join(rng.choice("abcdefgé") for _ in range(rng.choice([7, 8, 9, 14]))) for _ in range(40)]
    base += ["a" * k for k in (7, 8, 9, 63, 64, 65, 66, 127, 128, 129)] + ["ab" * k for k in (31, 32, 33, 100)]
    base += ["".join(rng.choice("acgt") for _ in range(k)) for k in (62, 63, 64, 65, 127, 128, 129, 300, 1500)]
    for number in range(300):
        chosen = rng.choice(base)
        text = [chosen.upper() if number % 7 == 0 else chosen] * rng.choice([1, 2, 3, 30])
        text += [edited(chosen, rng)] * 2 + [edited(edited(chosen, rng), rng)] * 2
        data.append((100 + number, "; ".join(text) + " × Ωmega42", "en", "s", 1))
    data.append((3, "qwertzuiop " * 400 + "qwertzuio " * 30 + "qwertzui " * 2, "en", "s", 1))
    return data


@pytest.fixture()
def short_blocks(monkeypatch):
    """Blocks of 16 code points, so that long words are cut often and the frontier takes few turns."""
    monkeypatch.setattr(spelling, "BLOCK", 16)


def test_spelling_groups(spark, short_blocks):
    data = misspelt()
    found = spelling_groups(clashing(documents(spark, data)))
    expected = brute_spelling(data)
    assert rows(found.words, "word", "form", "root", "n", "n_near", "form_n") == expected
    assert sum(r[1] is not None for r in expected) > 20 and any(r[1] != r[2] for r in expected if r[1])
    assert max(len(r[0]) for r in expected if r[4]) > 1000


def test_every_place_of_an_edit(spark, short_blocks):
    """Each edit of words around the borders of blocks, and the shortest words."""
    rng = random.Random(9)
    known = {"", "a", "b", "ab", "ba", "abc"}
    for length in (15, 16, 17, 32, 49):
        word = "".join(rng.choice("ab") for _ in range(length))
        known |= {word} | {word[:i] + "c" + word[i:] for i in range(length + 1)} | {word[:i] + "d" + word[i + 1 :] for i in range(length)}
    frame = spark.createDataFrame([(w, 1) for w in known], "word string, n bigint")
    expected = {(a, b) for a, others in near_words(known).items() for b in others}
    found = [(r["word"], r["other"]) for r in neighbours(frame).collect()]
    assert len(found) == len(set(found)) and set(found) == expected


# -- SimHash --


def brute_fingerprint(text, size):
    found = [w.encode() for w in words(text)]
    if not found:
        return 0
    grams = [b" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, differ=2):
    distinct = sorted(set(prints))
    label = {p: p for p in distinct}
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(distinct):
            for b in distinct[:i]:
                if (a ^ b).bit_count() <= differ and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def copies():
    rng, data = random.Random(6), awkward()
    for group in range(6):
        base = [f"v{rng.randrange(5000)}" for _ in range(300)]
        for i in range(20):
            near = base.copy()
            near[rng.randrange(300)] = f"e{i}"
            data.append((1000 * group + i, " ".join(near), "en", "s", 1))
    return data


@pytest.mark.parametrize("size", [3, 5])
def test_simhash_groups(spark, size):
    data = copies()
    prints = [brute_fingerprint(text, size) for _, text, *_ in data]
    label, least = brute_components(prints), {}
    for (doc_id, *_), p in zip(data, prints):
        least[label[p]] = min((x for x in (least.get(label[p]), doc_id) if x is not None), default=None)
    expected = [(row[0], f"{p:016x}", least[label[p]]) for row, p in zip(data, prints)]
    found = simhash_groups(clashing(documents(spark, data)), words=size).documents
    assert rows(found, "doc_id", "fingerprint", "component_id") == ordered(expected)
    assert len({r[2] for r in expected}) < len({r[1] for r in expected})


@pytest.mark.parametrize(("meeting", "differ"), [(64, 2), (2, 2), (0, 2), (0, 1)])
def test_links_of_dense_groups(spark, monkeypatch, meeting, differ):
    """All pairs of close fingerprints in balls that share most signatures, also if every large group is cut again."""
    monkeypatch.setattr(simhash, "MEETING", meeting)
    rng = random.Random(8)
    known = {0, 1, 2**63, 2**64 - 1}
    for _ in range(3):
        center = rng.getrandbits(64)
        for _ in range(60):
            known.add(center ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))))
        known |= {center ^ b for b in range(16)} | {center ^ (b << 40) for b in range(16)}
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in known]
    found = simhash.links(spark.createDataFrame(signed, "fp bigint"), differ).collect()
    pairs = {frozenset((r["a"] % 2**64, r["b"] % 2**64)) for r in found}
    assert pairs == {frozenset((a, b)) for a in known for b in known if a != b and (a ^ b).bit_count() <= differ}


# -- Merkle manifest --


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([digest(*found[-1][i : i + 16]) for i in range(0, len(found[-1]), 16)])
    return found


def brute_manifest(data):
    leaves = defaultdict(list)
    for doc_id, text, lang, source, n_chars in data:
        row = (doc_id, source, lang, n_chars, text)
        leaves[source].append((doc_id is not None, doc_id or 0, brute_leaf(row), row))
    sources = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(leaves[s], key=lambda x: x[:3])]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    found = []
    for place, source in enumerate(sources):
        for at, (_, _, leaf, row) in enumerate(sorted(leaves[source], key=lambda x: x[:3])):
            node, siblings = leaf, []
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                node = brute_leaf((*row[:4], row[4] and row[4].encode().lower().decode()))
            for levels, i in ((trees[source], at), (top, place)):
                for level in levels[:-1]:
                    first = i // 16 * 16
                    before, after = level[first:i], level[i + 1 : first + 16]
                    siblings += before + after
                    node, i = digest(*before, node, *after), i // 16
            found.append((row[0], leaf, trees[source][-1][0], top[-1][0], digest(*siblings), node, node == top[-1][0]))
    return ordered(found)


MANIFEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def tampered():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def test_manifest(spark):
    """Trees of 1 to 70,000 leaves, more than one run of sources, null and repeated ids and sources."""
    data = awkward() + [(i, f"Text {i} É" if i % 11 else None, "en", "many" if i % 3 else f"S{i % 40}", i) for i in range(6000)]
    data += [(i, "One", None, source, None) for source, n in (("é", 1), ("x", 15), ("y", 16), ("z", 17), ("Z", 256), ("q", 257)) for i in range(n)]
    made = merkle_manifest(clashing(documents(spark, data)), tampered())
    expected = brute_manifest(data)
    assert rows(made.rows, *MANIFEST) == expected
    assert 0 < sum(not r[-1] for r in expected) < len(expected)
    assert made.root.collect()[0]["root"] == expected[0][3]
    assert made.sources.agg(F.sum("rows")).first()[0] == len(data)


def test_manifest_of_three_rounds(spark):
    data = [(i, f"T{i}", "en", "one", i) for i in range(65_600)]
    made = merkle_manifest(documents(spark, data), tampered())
    assert rows(made.rows, *MANIFEST) == brute_manifest(data)


def test_one_row_is_its_own_root(spark):
    row = (3, "a", None, None, 1)
    found = merkle_manifest(documents(spark, [row])).rows.collect()
    leaf = brute_leaf((3, None, None, 1, "a"))
    assert [tuple(r) for r in found] == [(3, leaf, leaf, leaf, digest(), leaf, True)]


def test_empty_tables(spark):
    none = documents(spark, [])
    assert spelling_groups(none).words.count() == 0
    assert simhash_groups(none).documents.count() == 0
    assert merkle_manifest(none).rows.count() == 0

"""Operators on rows against brute force: quality, urls, licences, tokens, files, mixing, shards, archives."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from frames import ALNUM, SPACED, awkward, clashing, documents, lowered, rows, sentence, words
from pyspark.sql import functions as F

from tidemeter.llm.fixity import archived, differing, fixity_audit, merkle_tree
from tidemeter.llm.license_scan import TEMPLATES, license_scan
from tidemeter.llm.mixing import MixTarget, mix_sources
from tidemeter.llm.quality_rules import quality_rules
from tidemeter.llm.sharding import kd_shards
from tidemeter.llm.token_counts import token_counts
from tidemeter.llm.token_files import checked, read_token_files, token_index, write_token_files
from tidemeter.llm.url_filter import TemplateLimits, filter_urls

public_tokenizers = pytest.importorskip("public_tokenizers")


def order(data):
    return sorted(data, key=lambda r: [(v is not None, str(v)) for v in r])


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(str(public_tokenizers.path(name)))


# Quality rules


def brute_quality(text):
    text = text or ""
    found = SPACED.findall(text)
    places = defaultdict(list)
    for i in range(len(found) - 7):
        places[tuple(found[i : i + 8])].append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def quality_data():
    extra = [sentence(9, 12) * 3, "a b c d e f g h " * 5, "# $ & <b> | 100%\n" * 3 + sentence(8, 40), "a " * 9, sentence(5, 8) + " " + sentence(5, 8)]
    return awkward() + [(200 + i, t, "en", "s9", 1) for i, t in enumerate(extra)]


def test_quality_measures(spark):
    data = quality_data()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for keep_text in (True, False):
        judged = quality_rules(clashing(documents(spark, data)), keep_text=keep_text)
        expected = []
        for doc_id, text, *_ in data:
            m = brute_quality(text)
            expected.append((doc_id, *m, m[0] < 20 or 100 * m[4] > 30 * m[0]))
        assert rows(judged, "doc_id", *names, "base_failed") == order(expected)
    assert quality_rules(documents(spark, [])).count() == 0


SYMBOLS = " " + " ".join(f"#{i}" for i in range(30))


def test_bad_hosts_lose_suspects_only(spark):
    good = [(i, sentence(i, 40), "en", "good", 1) for i in range(60)]
    bad = [(100 + i, "short", "en", "bad", 1) for i in range(60)]
    suspect = [(300, sentence(1, 40) + SYMBOLS, "en", "bad", 1), (301, sentence(1, 40) + SYMBOLS, "en", "good", 1), (302, sentence(2, 40), "en", "bad", 1)]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules(documents(spark, good + bad + suspect)).collect()}
    assert (kept[300], kept[301], kept[302]) == (False, True, True)
    assert all(kept[i] for i in range(60)) and not any(kept[100 + i] for i in range(60))


# Urls

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("org/fr/", "allow")]


def test_url_parts_and_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?y#z", "http://example.net/de/", "http://badexample.net/en/1", "http://x.org/fr/", "http://x.org#a", "a://b://c/d", "http://net", "http://é.org/fr/é"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate([*urls, urls[4]])] + [(None, "http://q.net/")], "page_id bigint, url string")
    none = spark.createDataFrame([], "id bigint, bad int")
    found = {r["page_id"]: tuple(r)[1:5] for r in filter_urls(clashing(pages), none, RULES).collect()}
    assert len(found) == 14
    assert found[0] == found[1] == found[2] == found[3] == ("", "", None, "allow")
    assert found[4] == found[12] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert found[5] == ("example.net", "/de/", "net/", "block")
    assert found[6] == ("badexample.net", "/en/1", "net/", "block")
    assert found[7] == ("x.org", "/fr/", "org/fr/", "allow")
    assert found[8] == ("x.org", "", None, "allow")
    assert found[9] == ("b:", "//c/d", None, "allow")
    assert found[10] == ("net", "", None, "allow")
    assert found[11] == ("é.org", "/fr/é", "org/fr/", "allow")
    assert found[None] == ("q.net", "/", "net/", "block")
    assert filter_urls(pages.limit(0), none, RULES).count() == 0


def test_templates_generalise_merge_and_reject(spark):
    data, bad = [], []
    for i in range(300):
        data.append((i, f"http://a.com/user/{chr(97 + i % 26)}{i}x/post"))
        bad.append((i, 0))
        data.append((1000 + i, f"http://a.com/spam/{i}"))
        bad.append((1000 + i, 1 if i < 200 else None))
        data.append((2000 + i, f"http://a.com/{'en' if i % 2 else 'fr'}/{i}"))
        bad.append((2000 + i, i % 20 < 2))
    pages = spark.createDataFrame(data, "page_id bigint, url string")
    labels = spark.createDataFrame([(i, None if b is None else int(b)) for i, b in bad], "id bigint, bad int")
    found = {r["page_id"]: (r["template"], r["verdict"]) for r in filter_urls(pages, labels, [], TemplateLimits()).collect()}
    assert {found[i][0].split("/", 2)[2] for i in range(300)} == {"*/post"}
    assert {found[i][1] for i in range(300)} == {"allow"}
    assert {found[1000 + i] for i in range(300)} == {("/spam/*", "block")}
    assert len({found[2000 + i] for i in range(300)}) == 1


def judged_urls(spark, branches, limits=TemplateLimits()):
    """(template, verdict) of each branch (path, pages, labelled pages, bad pages), all on one host."""
    data, labels, at = [], [], {}
    for path, count, labelled, bad in branches:
        at[path] = len(data)
        for i in range(count):
            if i < labelled:
                labels.append((len(data), int(i < bad)))
            data.append((len(data), f"http://a.com/{path}/{i}"))
    pages = spark.createDataFrame(data, "page_id bigint, url string")
    found = filter_urls(pages, spark.createDataFrame(labels, "id bigint, bad int"), [], limits)
    rows = {r["page_id"]: (r["template"], r["verdict"]) for r in found.collect()}
    assert len(rows) == len(data)
    return {path: rows[i] for path, i in at.items()}


@pytest.mark.parametrize("more", [0, 60])
def test_unlabelled_branches_are_no_bridge(spark, more):
    few = [("halves", 4, 2, 1)]
    found = judged_urls(spark, [("good", 100 + more, 100 + more, 0), ("bad", 160 - more, 160 - more, 160 - more), ("none", 50, 0, 0), *few])
    assert found["good"][1] == "allow" and found["bad"][1] == "block"
    assert len({found["good"][0], found["bad"][0]}) == 2
    assert found["none"][0] in (found["good"][0], found["bad"][0])


@pytest.mark.parametrize("sections", [19, 40])
def test_wide_nodes_keep_supported_branches(spark, sections):
    branches = [(f"good{chr(97 + i // 26)}{chr(97 + i % 26)}", 40, 30, 0) for i in range(sections)]
    small = [(f"tiny{chr(97 + i // 26)}{chr(97 + i % 26)}", 3, 1, 0) for i in range(30)]
    found = judged_urls(spark, [*branches, *small, ("spam", 40, 30, 30), ("few", 9, 9, 9), ("onebad", 1, 1, 1)])
    assert {found[b[0]][1] for b in branches} == {"allow"}
    assert found["spam"][1] == "block" and found["few"] == found["spam"]
    assert {found[b[0]] for b in small} == {("/*/*", "allow")} == {found["onebad"]}


def test_paths_are_not_cut(spark):
    start = "/".join("abcdefghijkl")
    found = judged_urls(spark, [(f"{start}/good", 60, 60, 0), (f"{start}/bad", 60, 60, 60), (f"{start}/bad/more/yet", 1, 0, 0)])
    assert found[f"{start}/good"] == (f"/{start}/good/*", "allow")
    assert found[f"{start}/bad"] == (f"/{start}/bad/*", "block")
    assert found[f"{start}/bad/more/yet"][0] == f"/{start}/bad/more/yet/*"


# Licences


def brute_base(text):
    found, hits = words(text, ALNUM), []
    for t in TEMPLATES:
        if t.base:
            hits += [(i, t.label) for i in range(len(found)) if found[i : i + len(t.words)] == t.words]
    starts = [i for i, _ in hits]
    return len(found), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({n for _, n in hits}))


def license_data():
    texts = [
        "Licensed Under THE MIT-License. under the mit license",
        "Apache License, Version 2.0 and CC BY-NC; cc by nc by nc cc by nc",
        "under the mit",
        "under the \u212amit license",
        sentence(1, 20) + " " + TEMPLATES[4].text.title() + " " + sentence(2, 20),
        TEMPLATES[5].text.replace("modification", "changes"),
        TEMPLATES[5].text.replace("source", "sauce"),
        "under the mit license " * 2000,
    ]
    return awkward() + [(300 + i, t, "en", "s", 1) for i, t in enumerate(texts)]


def test_license_scan(spark):
    data = license_data()
    scanned = license_scan(clashing(documents(spark, data)))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    assert rows(scanned, *names) == order([(d, *brute_base(t)) for d, t, *_ in data])
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in scanned.collect()}
    assert found[304] == ("mit", 1.0)
    assert found[305][0] == "bsd" and 0.9 < found[305][1] < 1
    assert found[306] == ("", 0.0)
    assert all(0 <= s <= 1 for _, s in found.values())
    assert license_scan(documents(spark, [])).count() == 0


# Tokens

ODD = ["a  b", " lead", "trail ", "x\n y", "x \ny", "<|endoftext|>", "<|ENDOFTEXT|> z", "é. e\u0301.", "ΑΣ. ς", "don't #*", "\x85 \u3000 q", "中 文."]


def token_data():
    return awkward() + [(400 + i, t, "en", "s", 1) for i, t in enumerate(ODD)]


def test_token_counts_and_cache(spark, tmp_path):
    path, cache = str(public_tokenizers.path("byte_bpe_50k.json")), str(tmp_path / "cache")
    data, plain = token_data(), library("byte_bpe_50k.json")
    expected = []
    for doc_id, text, *_ in data:
        n = len(plain.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), n, n > 512))
    names = ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    docs = clashing(documents(spark, data))
    first = token_counts(docs.where("doc_id < 8"), path, cache)
    assert rows(first.where("cached")) == []
    size = spark.read.parquet(cache).count()
    assert size == len({t or "" for d, t, *_ in data if d is not None and d < 8})
    again = token_counts(docs, path, cache)
    assert rows(again, *names) == order(expected)
    known = {t or "" for d, t, *_ in data if d is not None and d < 8}
    assert rows(again, "doc_id", "cached") == order([(d, (t or "") in known) for d, t, *_ in data])
    assert spark.read.parquet(cache).count() == len({t or "" for _, t, *_ in data})
    assert token_counts(documents(spark, []), path).count() == 0


def test_token_files(spark, tmp_path):
    path, folder = str(public_tokenizers.path("word_bpe_49k.json")), str(tmp_path / "files")
    data, plain = token_data(), library("word_bpe_49k.json")
    index = write_token_files(clashing(documents(spark, data)).drop("id"), path, folder, 2)
    found = read_token_files(index, folder)
    expected, start = [], 0
    for doc_id, text, *_ in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        expected.append((doc_id, start, len(ids), crc, ids))
        start += len(ids)
    assert rows(found, "id", "start", "n_tokens", "ids_crc32", "tokens") == order(expected)
    for row in index.select("file").distinct().collect():
        entries = [(r["packed"], r["size"], r["check"]) for r in index.where(F.col("file") == row["file"]).orderBy("frame").collect()]
        assert token_index(spark, folder, row["file"]) == entries
    assert read_token_files(write_token_files(documents(spark, []), path, str(tmp_path / "none"), 2), folder).count() == 0


def test_broken_frame_is_noticed():
    import zstandard

    packed = zstandard.ZstdCompressor().compress(b"data")
    with pytest.raises(ValueError):
        checked(packed, 4, 0)


# Mixing


def mix_data():
    data = awkward()
    for source, count in (("big", 300), ("mid", 60), ("small", 6)):
        data += [(1000 * len(source) + i, sentence(i, 10 + i % 50), "en", source, 1) for i in range(count)]
    return data


@pytest.mark.parametrize("target", [MixTarget(max_passes=2.0, block_tokens=200), MixTarget(max_passes=None, entropy=1.2, block_tokens=200)])
def test_mix(spark, target):
    import math

    data = mix_data()
    mixed = mix_sources(clashing(documents(spark, data)).drop("tokens"), target)
    got = mixed.select("doc_id", "source", "mix_weight", "mix_pass", "mix_tokens").collect()
    totals = Counter()
    for _, text, _, source, _ in data:
        totals[source] += len(SPACED.findall(text or ""))
    budget = sum(totals.values())
    weights = {r["source"]: r["mix_weight"] for r in got if r["mix_tokens"]}
    assert abs(sum(weights.values()) - 1) < 1e-9
    if target.entropy is None:
        assert max(weights[s] * budget / totals[s] for s in weights) <= target.max_passes + 1e-6
    else:
        assert abs(-sum(w * math.log(w) for w in weights.values()) - target.entropy) < 1e-6
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["mix_tokens"]
    longest = max(len(SPACED.findall(t or "")) for s in ("big", "mid", "small") for _, t, _, x, _ in data if x == s)
    for s in ("big", "mid", "small"):
        assert weights[s] * budget - longest - 1 <= taken[s] <= weights[s] * budget
        passes = Counter(r["doc_id"] for r in got if r["source"] == s)
        assert max(passes.values()) - min(passes[d] for d, _, _, x, _ in data if x == s) <= 1
    assert sum(r["mix_tokens"] == 0 for r in got) == sum(not SPACED.search(t or "") for _, t, *_ in data)
    assert mix_sources(documents(spark, []), target).count() == 0


# Shards


def test_shards(spark):
    rng = random.Random(5)
    copies = sentence(77, 30)
    data = awkward()[:11] + [(1000 + i, sentence(i, rng.randrange(5, 60)), "en", f"s{i % 7}", 1) for i in range(3000)]
    data += [(9000 + i, copies, "en", f"s{i % 7}", 1) for i in range(1500)]
    data += [data[5], (None, "null id", None, None, None)]
    placed = kd_shards(clashing(documents(spark, data))).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in placed) == sorted(
        (str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in data
    )
    sizes, slots = Counter(), defaultdict(list)
    for r in placed:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(sizes) == set(range(8)) and {r["law"] for r in placed} == {"bytes"}
    assert max(sizes.values()) < 1.05 * min(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    homes, weights = defaultdict(set), Counter()
    for r in placed:
        homes[r["text_crc32"]].add(r["shard"])
        weights[r["text_crc32"]] += r["size"]
    apart = {c for c, h in homes.items() if len(h) > 1}
    assert zlib.crc32(copies.encode()) in apart
    assert all(weights[c] > sum(sizes.values()) // (8 * 256) for c in apart)
    assert kd_shards(documents(spark, [])).count() == 0
    assert len({r["shard"] for r in kd_shards(documents(spark, data), target_bytes=60_000).collect()}) == -(-sum(sizes.values()) // 60_000)


# Archives


def test_fixity(spark):
    pages = [(i, f"http://h/{i}", "<p>" + sentence(i, 10)) for i in range(2500)] + [(7, "http://h/7", "again"), (None, None, None), (None, None, None)]
    frame = clashing(spark.createDataFrame(pages, "page_id bigint, url string, html string"))
    flipped = {3, 1500, 2499}
    broken = frame.withColumn("html", F.when(F.col("page_id").isin(*flipped), F.concat(F.lit("X"), F.expr("substring(html, 2)"))).otherwise(F.col("html")))
    found = fixity_audit(archived(frame), archived(broken))
    assert found.count() == len(pages)
    assert {r["id"] for r in found.where("NOT intact").collect()} == flipped
    tree = merkle_tree(archived(frame))
    assert differing(tree, merkle_tree(archived(frame.repartition(7)))).count() == 0
    lost = fixity_audit(archived(frame), archived(frame.where("page_id <> 2400 OR page_id IS NULL")))
    assert {r["id"] for r in lost.where("NOT intact").collect()} == set(range(2400, 2500))
    assert fixity_audit(archived(frame.limit(0)), archived(frame)).count() == 0
    assert fixity_audit(archived(frame), archived(frame.limit(0))).where("intact").count() == 0


def test_lowering_is_of_ascii_only():
    assert lowered("ÀBC") == "Àbc"

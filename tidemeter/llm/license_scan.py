"""License scan with a positional rare-token index, in DataFrame functions only.

The index lists, for the rarest words of each template, the template and the word's place in it. A file's licence words are
looked up; place in the file minus place in the template names a start, and starts that enough rare words agree on are
candidates. A candidate counts if the template's mandatory key phrase stands at its place, and its score is the share of
template words that stand at theirs. Rarity is measured over all files.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.llm.shared import prepared

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """``key``: phrase that must stand at its place. Base templates are nothing but their key."""

    label: str
    text: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(SEPARATOR, self.text.lower()) if w]

    @property
    def key_words(self) -> list[str]:
        return [w for w in re.split(SEPARATOR, self.key.lower()) if w]

    @property
    def key_at(self) -> int:
        words, key = self.words, self.key_words
        return next(i for i in range(len(words)) if words[i : i + len(key)] == key)


# Phrases and openings of public licence notices.
TEMPLATES = [
    Template("mit", "under the mit license", "under the mit license", True),
    Template("apache-2", "apache license version 2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", "cc by nc", True),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "free of charge to any person obtaining a copy"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "source and binary forms"),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee"),
    Template("cc-by-sa", "creative commons attribution sharealike", "attribution sharealike"),
    Template("cc-by", "creative commons attribution 4 0 international license", "commons attribution 4 0 international"),
    Template("all-rights-reserved", "all rights reserved", "all rights reserved"),
    Template("proprietary", "proprietary and confidential", "proprietary and confidential"),
]


def _with(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    """Words after lower-casing A-Z. ``lower`` also changes other letters, of which only the Kelvin sign would become
    a letter of the alphabet; it is replaced by another letter beyond ASCII first."""
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("é")))
    return F.filter(F.split(lowered, SEPARATOR), lambda w: w != "")


def document_frequencies(docs: DataFrame, vocabulary: list[str], text_col: str) -> dict[str, int]:
    """Number of files with each word of the vocabulary; the templates bound the rows that reach the driver."""
    found = F.array_distinct(F.filter(words_of(F.col(text_col)), lambda w: w.isin(vocabulary)))
    counted = docs.select(F.explode(found).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return dict.fromkeys(vocabulary, 0) | {r["word"]: r["n"] for r in counted.collect()}


def rare_places(words: list[str], frequency: dict[str, int], files: int, count: int) -> list[int]:
    """Places of the rarest words (by inverse document frequency), one place for each word; ties by place."""
    idf = {w: math.log((1 + files) / (1 + frequency[w])) for w in words}
    places = {w: i for i, w in reversed(list(enumerate(words)))}
    return sorted(places.values(), key=lambda i: (-idf[words[i]], i))[:count]


def license_scan(
    docs: DataFrame, templates: list[Template] = TEMPLATES, rare: int = 4, votes: int = 2, least: float = 0.8, text_col: str = "text"
) -> DataFrame:
    """Input rows without the text, and n_words, n_base, first_word, last_word, base_labels, labels, score.

    Base phrases count at every place where their words stand one after the other. A longer template needs ``votes``
    of its ``rare`` rarest words at one start, its key phrase at its place and a score of ``least``. ``score`` is the best
    score of a file's labels, 0 without any. Null and empty texts have no words and no labels; repeated rows are
    scanned one by one; input columns with the names of the results are replaced; empty input, empty result.
    """
    prepared(docs.sparkSession)
    vocabulary = sorted({w for t in templates for w in t.words})
    frequency = document_frequencies(docs, vocabulary, text_col)
    files = docs.count()
    postings: dict[str, list[tuple[int, int]]] = {}
    needed = []
    for number, t in enumerate(templates):
        if t.base:  # every place of the phrase holds its rarest word
            places = rare_places(t.words, frequency, files, 1)
        else:
            places = rare_places(t.words, frequency, files, rare)
        needed.append(1 if t.base else min(votes, len(places)))
        for place in places:
            postings.setdefault(t.words[place], []).append((number, place))
    index = F.create_map(
        *(
            x
            for word, entries in sorted(postings.items())
            for x in (F.lit(word), F.array(*(F.struct(F.lit(n).alias("t"), F.lit(p).alias("p")) for n, p in entries)))
        )
    )
    texts = F.array(*(F.array(*map(F.lit, t.words)) for t in templates))
    keys = F.array(*(F.array(*map(F.lit, t.key_words)) for t in templates))
    key_at = F.array(*(F.lit(t.key_at) for t in templates))
    enough = F.array(*map(F.lit, needed))
    anchors = sorted(postings)

    def starts(words: Column) -> Column:
        """(template, start) that enough rare words name, each once."""
        marks = F.array_compact(F.transform(words, lambda w, i: F.when(w.isin(anchors), F.struct(w.alias("w"), i.alias("i")))))
        named = F.flatten(
            F.transform(marks, lambda m: F.transform(F.element_at(index, m["w"]), lambda e: F.struct(e["t"].alias("t"), (m["i"] - e["p"]).alias("s"))))
        )
        # Equal starts stand side by side after sorting; the first of each run knows its length from the votes needed.
        return _with(
            F.array_sort(named),
            lambda s: F.filter(
                s, lambda x, i: F.coalesce(F.get(s, i - 1) != x, F.lit(True)) & (F.get(s, i + F.get(enough, x["t"]) - 1) == x)
            ),
        )

    def checked(words: Column, found: Column) -> Column:
        """Template, start and score of the candidates whose key phrase is in place."""

        def at(start: Column, expected: Column) -> Column:
            return F.transform(expected, lambda w, k: F.coalesce(F.get(words, start + k) == w, F.lit(False)))

        held = F.filter(found, lambda x: F.forall(at(x["s"] + F.get(key_at, x["t"]), F.get(keys, x["t"])), lambda ok: ok))

        def scored(x: Column) -> Column:
            wanted = F.get(texts, x["t"])
            same = F.size(F.filter(at(x["s"], wanted), lambda ok: ok))
            return F.struct(x["t"].alias("t"), x["s"].alias("s"), (same / F.size(wanted)).alias("score"))

        return F.filter(F.transform(held, scored), lambda x: x["score"] >= least)

    def scanned(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"), checked(words, starts(words)).alias("found"))

    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    rows = docs.drop(*(c for c in names if c != text_col)).withColumn("_scan", _with(words_of(F.col(text_col)), scanned)).drop(text_col)
    is_base = F.array(*(F.lit(t.base) for t in templates))
    label = F.array(*(F.lit(t.label) for t in templates))
    found, base = F.col("_scan.found"), F.col("_base")
    joined = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda x: F.get(label, x["t"])))), ",")
    start = F.transform(base, lambda x: x["s"].cast("long"))
    return rows.withColumn("_base", F.filter(found, lambda x: F.get(is_base, x["t"]))).select(
        *(c for c in rows.columns if c != "_scan"),
        F.col("_scan.n_words").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(start).alias("first_word"),
        F.array_max(start).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(found).alias("labels"),
        F.coalesce(F.array_max(F.transform(found, lambda x: x["score"])), F.lit(0.0)).alias("score"),
    )

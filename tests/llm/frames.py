"""Small documents with the awkward cases every operator must stand."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def words(text, pattern=SPACED):
    return pattern.findall(lowered(text))


def sentence(seed, count, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(count))


def awkward():
    """Null, empty and blank texts, null columns, ties, copies, repeated rows, a very long text."""
    base = sentence(1, 60)
    texts = [
        None,
        "",
        " \n\t ",
        "one",
        "Two words",
        base,
        base,
        base.upper(),
        base + " tail",
        sentence(2, 60),
        "été  naïve\n\nétÉ 中文 Kelvin\n" + sentence(3, 30),
        "same line here\n" * 40,
        sentence(4, 30_000, 100_000),
        "x" * 20_000,
    ]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(5, base, "en", "s2", 5), (5, base, "en", "s2", 5), (None, base, None, None, None), (None, None, None, None, None)]
    return rows


def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def clashing(df):
    """The same rows with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ["n", "node", "id", "label", "size", "shard", "slot", "kept", "labels", "score", "n_words", "host", "items", "item", "cell", "tokens"]
    return df.withColumns({name: F.lit("clash") for name in names})


def rows(df, *columns):
    key = lambda r: [(v is not None, str(v)) for v in r]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)

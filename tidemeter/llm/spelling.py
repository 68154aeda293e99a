"""Spelling variant grouping by a relational trie frontier.

The vocabulary is a trie in a table: an edge leads from a node (a prefix, by hash) by one code point to the next, and an edge of no
code point ends a word. A frontier of states (word, position, node, edits) is joined with the edges of one level after
the other. A state without edits follows its own word and branches off by a replaced or an inserted code point; a state
with its one edit follows the rest of its word exactly. A state that ends with its word and its edit has found a neighbour.
Deletions are the insertions seen from the other word.

*From both ends.* A pair one edit apart agrees in a first half or in a last half of the shorter word. So states start in the
middle of their word, in the trie of the words and in that of the reversed words, and no state fans out at the root.

*Looking ahead.* An edge says how many words are below it. If it is one, the hash of that word's rest decides at once; if it is more,
a mask of 64 bits over the hashes of the rests tells most states that they would end nowhere. Hashes only find neighbours; an
edit distance confirms each.

*Long words.* The levels of a trie are as many as its longest word has code points. A pair one edit apart agrees outside of one
aligned block of ``BLOCK`` code points (the block of one of them being one longer or shorter), so a long word is cut into such
pieces, and the trie of a piece hangs below a root of its own, the hash of all that stands before and after it.
The frontier thus takes at most ``BLOCK`` + 3 turns, whatever the words; words shorter than a block share one root.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.llm.shared import prepared, stored

#: The runs that are words, and the share of them whose spelling is varied (fixed values).
RUN = "[A-Za-zÀ-ÿ]"
VARIED = 31

BLOCK = 64

# Distinct words that a task gathers before it hands their counts on.
GATHERED = 100_000


def varied(doc_id: object, run: str) -> str:
    """The run, or the run without one code point, as its hash and the document's decide."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % VARIED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(
    docs: DataFrame, least_length: int = 7, least_count: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Distinct words of whole texts with their number: word, n. Tasks add up before the shuffle."""
    runs = re.compile(f"{RUN}{{{least_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["id"].to_pylist(), batch["text"]):
                if not text.is_valid:
                    continue
                own = Counter(runs.findall(text.as_py().encode().lower().decode()))
                for run, n in own.items():
                    word = varied(doc_id, run)
                    if len(word) >= least_length:
                        found[word] += n
                if len(found) >= GATHERED:
                    yield rows(found)
                    found.clear()
        yield rows(found)

    def rows(found: Counter[str]) -> pa.RecordBatch:
        columns = [pa.array(list(found.keys()), pa.string()), pa.array(list(found.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counted = texts.mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def code_points(text: Column, start: Column | int, length: Column | int) -> Column:
    """``length`` code points from ``start`` (from 0)."""
    begin = F.lit(start) + 1 if isinstance(start, int) else start + 1
    return F.substring(text, begin.cast("int"), F.lit(length).cast("int") if isinstance(length, int) else length.cast("int"))


def pieces(words: DataFrame) -> DataFrame:
    """The strings that make the tries: id (of the word), way (0: forwards, 1: reversed), seed (of the root), s."""
    word = F.col("word")

    def piece(block: Column, longer: int) -> Column:
        start, size = block * BLOCK, F.lit(BLOCK + longer)
        around = F.xxhash64(block, code_points(word, 0, start), F.substring(word, (start + size + 1).cast("int"), F.char_length(word)))
        return F.struct(around.alias("root"), code_points(word, start, size).alias("s"))

    blocks = F.sequence(F.lit(0), F.expr(f"char_length(word) div {BLOCK}").cast("int"))
    cut = F.array_distinct(F.flatten(F.transform(blocks, lambda b: F.array(*(piece(b, x) for x in (-1, 0, 1))))))
    whole = F.array(F.struct(F.xxhash64(F.lit(0), F.lit(""), F.lit("")).alias("root"), word.alias("s")))
    both = F.explode(F.when(F.char_length(word) < BLOCK - 1, whole).otherwise(cut)).alias("piece")
    ways = F.array(F.struct(F.lit(0).alias("way"), F.col("piece.s").alias("s")), F.struct(F.lit(1).alias("way"), F.reverse("piece.s").alias("s")))
    forms = words.select("id", both).select("id", "piece", F.explode(ways).alias("form"))
    return forms.select("id", "form.way", F.xxhash64("piece.root", "form.way").alias("seed"), "form.s")


def trie(strings: DataFrame) -> DataFrame:
    """The edge table: depth, node, by (code point, or '' at a word's end), child, and of the words below: words (their number), mask
    and rest (of the hashes of their rests: all, and the least), below (the least id).

    Nodes above the middle of all their words are not visited and not made. A node has no more edges than there are letters.
    """
    s, depth = F.col("s"), F.col("depth")
    first = F.greatest(F.lit(0), F.floor((F.char_length(s) - 1) / 2).cast("int"))
    levels = strings.withColumn("depth", F.explode(F.sequence(first, F.char_length(s))))
    ends = levels.select(
        "depth",
        F.xxhash64("seed", code_points(s, 0, depth)).alias("node"),
        code_points(s, depth, 1).alias("by"),
        F.xxhash64("seed", code_points(s, 0, depth + 1)).alias("child"),
        F.xxhash64(F.substring(s, depth + 2, F.char_length(s))).alias("rest"),
        "id",
    )
    return ends.groupBy("depth", "node", "by").agg(
        F.min("child").alias("child"),
        F.count(F.lit(1)).alias("words"),
        F.bit_or(mask(F.col("rest"))).alias("mask"),
        F.min("rest").alias("rest"),
        F.min("id").alias("below"),
    )


def mask(hashed: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), hashed.bitwiseAND(63).cast("int"))


def neighbours(words: DataFrame) -> DataFrame:
    """All pairs of words that differ by one inserted, deleted or replaced code point, both ways round: word, n, other, other_n."""
    known = words.withColumn("id", F.xxhash64("word"))
    strings = stored(pieces(known), "pieces")
    edges = stored(trie(strings).hint("rebalance", "depth"), "trie", "depth")
    s, depth = F.col("s"), F.col("depth")
    middle = F.expr("char_length(s) div 2")
    starts = strings.withColumn("depth", F.when(F.col("way") == 0, middle).otherwise(F.char_length(s) - middle).cast("int"))
    at_start = F.xxhash64("seed", code_points(s, 0, depth)).alias("node")
    entering = starts.select("id", "s", depth.alias("position"), at_start, F.lit(0).alias("edit"), "depth")
    entering = stored(entering.hint("rebalance", "depth"), "starts", "depth")
    low, high = entering.agg(F.min("depth"), F.max(F.char_length(s))).first()
    waiting, ended = entering.drop("depth").limit(0), entering.select("id", F.col("id").alias("other")).limit(0)
    for level in range(low, high + 2) if low is not None else ():
        states = waiting.unionByName(entering.where(depth == level).drop("depth"))
        turn = stored(_followed(states, edges.where(depth == level).drop("depth")), f"level-{level}")
        waiting = turn.where("other IS NULL").drop("other")
        ended = ended.union(turn.where("other IS NOT NULL").select("id", "other"))
    first = known.select("id", "word", "n")
    second = known.select(F.col("id").alias("other"), F.col("word").alias("other_word"), F.col("n").alias("other_n"))
    named = ended.distinct().join(second, "other").join(first, "id")
    exact = named.where(F.levenshtein("word", "other_word", 1) == 1).select("word", "n", F.col("other_word").alias("other"), "other_n")
    exact = stored(exact, "pairs")
    return exact.union(exact.select("other", "other_n", "word", "n"))


def _followed(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States of the next level: id, s, position, node, edit (0 none yet, 1 replaced, 2 inserted); with ``other``, neighbours.

    ``position`` is the node's depth; after an insertion the word itself is one code point behind it.
    """
    s, by, edit, own, position = (F.col(c) for c in ("s", "by", "edit", "own", "position"))
    held = states.select(
        "*",
        code_points(s, position, 1).alias("own"),
        code_points(s, F.greatest(position - 1, F.lit(0)), 1).alias("before"),
        # What must follow in the other word after a replaced and after an inserted code point.
        F.xxhash64(F.substring(s, position + 2, F.char_length(s))).alias("after"),
        F.xxhash64(F.substring(s, position + 1, F.char_length(s))).alias("here"),
    )

    def may_end(want: str) -> Column:
        several = mask(F.col(want)).bitwiseAND(F.col("mask")) != 0
        return F.when(F.col("words") == 1, F.col(want) == F.col("rest")).otherwise(several)

    along = (edit == 0) & (by == own) & (by != "") & (F.col("words") > 1)
    replaced = (((edit == 0) & (own != "") & (by > own)) | ((edit == 1) & (by == own))) & may_end("after")
    inserted = (((edit == 0) & (by != own) & (by != "")) | ((edit == 2) & (by == F.col("before")))) & may_end("here")
    met = held.join(edges, "node").select(
        "id", "s", "position", "child", "words", "below", along.alias("along"), replaced.alias("replaced"), inserted.alias("inserted")
    )
    kinds = F.array_compact(F.array(F.when(F.col("along"), 0), F.when(F.col("replaced"), 1), F.when(F.col("inserted"), 2)))
    onward = met.where("along OR replaced OR inserted").withColumn("edit", F.explode(kinds))
    last = (edit > 0) & (F.col("words") == 1)
    return onward.select(
        "id",
        F.when(~last, s).alias("s"),
        (position + 1).alias("position"),
        F.when(~last, F.col("child")).alias("node"),
        "edit",
        F.when(last, F.col("below")).alias("other"),
    )


@dataclass(frozen=True)
class SpellingGroups:
    """``words``: word, form, root, n, n_near, form_n. ``pairs``: word, n, other, other_n for all words one edit apart, both ways."""

    words: DataFrame
    pairs: DataFrame


def spelling_groups(
    docs: DataFrame,
    least_length: int = 7,
    least_count: int = 2,
    times: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> SpellingGroups:
    """The words of whole texts, each with its form: the most frequent word one edit away, if it is ``times`` as frequent.

    Words are maximal runs of letters up to U+00FF, A-Z lower-cased, some varied by document and run, of ``least_length`` code
    points and ``least_count`` occurrences at least. Of equally frequent forms the smallest in code point order is taken.
    ``root`` is where forms end; a form is ``times`` as frequent as its word, so chains are short.
    Null and empty texts and texts without words add nothing; a null id counts as an empty one; rows that repeat count
    again; a text is read whole, whatever its length; other columns are not touched; an empty input gives no words.
    """
    prepared(docs.sparkSession)
    words = stored(word_counts(docs, least_length, least_count, id_col, text_col), "words")
    pairs = neighbours(words)
    best = F.min(F.when(F.col("other_n") >= times * F.col("n"), F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))))
    near = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    near = stored(near.select("word", "n_near", F.col("best.word").alias("form"), (-F.col("best.n")).alias("form_n")), "forms")
    roots = _roots(near.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    joined = words.join(near, "word", "left").join(roots, "word", "left")
    grouped = joined.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
    return SpellingGroups(grouped, pairs)


def _roots(steps: DataFrame) -> DataFrame:
    """Follow forms to their ends; each turn doubles the steps taken."""
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("end"))
        steps = stored(steps.join(further, "root", "left").select("word", F.coalesce("end", "root").alias("root"), "end"), "roots")
        if steps.where("end IS NOT NULL").isEmpty():
            return steps.drop("end")
        steps = steps.drop("end")

"""N-gram Jaccard join in the metric space of shingle sets.

Two documents link when the Jaccard distance of their sets of word shingles is at most ``r = 1 - num/den``. The
join works as metric joins do: pivots make regions, triangle-inequality windows say who may meet whom, and
regions are joined again and again with new pivots until nothing is open. Every distance that decides is exact.

*Regions.* Almost all distances in a corpus are exactly 1, so windows of 2r around sampled pivots would replicate
every document to every region. Regions are therefore spanned by content: a linked pair shares at least
``ceil(t * size)`` shingles, so in any fixed order of all shingles the first ``size - ceil(t * size) + 1`` of each have
one in common, its cell. The order is by rising frequency, from a sketch of fixed size that counts all shingles
of all documents, then by hash; frequent shingles, as of passages that many documents share, come last and seldom make
cells. Short shingles are shared by chance too often for that. Their cells are segments: sizes are cut into rings that
double, a document within the window of the next ring's border (sets that link differ by at most
``R = (size + other size) * (1-t) / (1+t)`` members, which is the triangle inequality around the empty set) is replicated to
that ring, and a ring cuts the universe into ``k > R`` segments by hash. At most R of a linked pair's segments differ,
so among the first R+1 non-empty ones of each in hash order they share one of equal content; a document with no more than
R non-empty segments gives its empty ones too. Each cell's smallest member is its pivot, and the region of a pivot is all
that shares a cell with it.

*Recursion.* Distances to the pivot are computed. Members within r link to it, and need not be compared with each
other: they are in one class. A cell whose members are not yet of one class is joined again, with sixteen times as
many pivots each time: those nearest to the pivot before, which are the most central. The first of them is compared with
all members and so gives the next windows; another pivot p and a member x of another class are compared only if their
distances to the last first pivot differ by at most r. Then the pivots leave the cell.
No pair's sets are compared unless its parities allow a link. A parity is 256 bits, each the number of members that hash to
it, modulo 2: two parities differ in no more bits than the sets differ in members. Sets of many hundred members may differ by more
than such a parity shows, so the pairs it lets through are met by one of two to four bits a member before their sets are built. A member whose parity is
too far from the pivot's has no distance, and so no window in the next turn.
So a dense group of n near copies costs about n comparisons; members of one cell that stay unlinked are still met pair by pair, but
only those whose parities are close have their sets compared.

Equal sets collapse to one node first. A pair is compared only if, were the cell's shingle the first they share, enough
would follow it on both sides; a linked pair passes this in the cell of its first shared shingle. Only the sets of such
pairs are built.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemeter.llm.components import components
from tidemeter.llm.shared import by_ids, by_pairs, discard, few_tasks, map_arrow, prepared, scratch, stored
from tidemeter.llm.words import SPACED, U64, mix, ragged, runs, word_hashes


# Distances are doubles; windows are wider by this.
EPSILON = 1e-9

# Counters of the frequency sketch. They only order shingles; any order gives the same result.
SKETCH_BITS = 17
SKETCH_PARTS = 16

# Words of 64 bits of a set's parity.
PARITY = ("parity_0", "parity_1", "parity_2", "parity_3")

# Most members of a set for each word of its fine parity, which only pairs are met by that the short one lets through.
FINE_MEMBERS = 32

# A pair carries two sets, so a task takes fewer of them than of narrow rows.
SET_ROWS = 16


@dataclass(frozen=True)
class Threshold:
    """Similarity at least ``num / den``."""

    num: int
    den: int

    def apart(self, total: int | np.ndarray) -> int | np.ndarray:
        """Most members by which two linked sets differ, from the sum of their sizes."""
        return total * (self.den - self.num) // (self.den + self.num)

    def shared(self, size: int | np.ndarray) -> int | np.ndarray:
        """Fewest members that a set of this size shares with a linked one."""
        return -(-size * self.num // self.den)

    def may_link(self, first: str, second: str) -> Column:
        """Whether two sets can link whose first shared member stands at these places: what follows must be enough.
        A place is the size (high 32 bits) and the position. It covers the window of sizes as well."""
        size, other = F.shiftright(first, 32), F.shiftright(second, 32)
        left = F.least(size - F.col(first).bitwiseAND(2**32 - 1), other - F.col(second).bitwiseAND(2**32 - 1))
        return left * (self.num + self.den) >= (size + other) * self.num

    def sizes_near(self, smaller: str, larger: str) -> Column:
        """Whether sets of the sizes at these places can link, the first one not larger; false where a place is null."""
        found = F.shiftright(smaller, 32) * self.den >= F.shiftright(larger, 32) * self.num
        return F.coalesce(found, F.lit(False))

    def near(self) -> Column:
        """Whether the parities of a row and a pivot differ in no more bits than linked sets differ in members."""
        differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"p_{c}"))) for c in PARITY), F.lit(0)).cast("long")
        return self.few_differ(differ, F.shiftright("place", 32) + F.shiftright("p_place", 32))

    def few_differ(self, differ: Column, total: Column) -> Column:
        """Whether sets that differ in at least so many members can link, from the sum of their sizes."""
        return differ * (self.num + self.den) <= total * (self.den - self.num)

    def finely_near(self) -> Column:
        """The same as ``near`` by the fine parities of a row and a pivot, the longer one folded to the length of the other.
        True where one is more than twice as long."""
        few, many = F.least(F.size("fine"), F.size("p_fine")), F.greatest(F.size("fine"), F.size("p_fine"))

        def fold(words: Column) -> Column:
            halves = F.slice(words, F.lit(1), few), F.slice(words, few + 1, few)
            return F.when(F.size(words) > few, F.zip_with(*halves, lambda a, b: a.bitwiseXOR(b))).otherwise(words)

        differ = F.zip_with(fold(F.col("fine")), fold(F.col("p_fine")), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
        total = F.aggregate(differ, F.lit(0).cast("long"), lambda x, y: x + y)
        return F.when(many > 2 * few, True).otherwise(self.few_differ(total, F.col("n") + F.col("p_n")))

    def largest(self, size: np.ndarray) -> np.ndarray:
        return size * self.den // self.num


@dataclass(frozen=True)
class JaccardJoin:
    """``classes``: id, n_shingles, component_id, one row per input row. ``links``: verified links between
    different sets (node, other, shared, either: sizes of intersection and union), enough to connect each class."""

    classes: DataFrame
    links: DataFrame


def shingle_sets(texts: pa.Array, size: int):
    """Slices: (first text, set sizes, all sets one after the other, each sorted)."""
    for first, at, words in word_hashes(texts, SPACED):
        grams = runs(words, size)
        sets = []
        for start, end in zip(at[:-1], at[1:]):
            if end - start >= size:
                sets.append(np.unique(grams[start : end - size + 1]))
            else:  # shorter than a shingle: the whole sequence is one; its length is part of the hash
                count = int(end - start)
                sets.append(runs(words[start:end], count, 1000 + count) if count else words[:0])
        yield first, np.array([len(s) for s in sets], dtype=np.int64), np.concatenate(sets)


def digests(sizes: np.ndarray, members: np.ndarray) -> np.ndarray:
    """64-bit digest of each set."""
    sums = np.concatenate([np.zeros(1, dtype=U64), np.cumsum(mix(members, 3), dtype=U64)])
    ends = np.cumsum(sizes)
    with np.errstate(over="ignore"):
        return mix(sums[ends] - sums[ends - sizes] + sizes.astype(U64), 4).view(np.int64)


def parities(sizes: np.ndarray, members: np.ndarray) -> list[np.ndarray]:
    """The parity of each set, word by word: the difference (xor) of running parities at its ends."""
    ends = np.cumsum(sizes)
    bit = mix(members, 14)
    word, one = bit >> U64(62), U64(1) << (bit & U64(63))
    found = []
    for number in range(len(PARITY)):
        running = np.concatenate([np.zeros(1, dtype=U64), np.bitwise_xor.accumulate(np.where(word == U64(number), one, U64(0)))])
        found.append((running[ends] ^ running[ends - sizes]).view(np.int64))
    return found


def fine_parities(sizes: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The fine parity of each set: (numbers of words, all words). The numbers are powers of two, so that a parity is folded to half
    its length by the xor of its halves."""
    words = 1 << np.ceil(np.log2(np.maximum(sizes / FINE_MEMBERS, 1))).astype(np.int64)
    starts = np.cumsum(words) - words
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bit = (mix(members, 15) % (64 * words[owner]).astype(U64)).astype(np.int64)
    odd = np.bincount(64 * starts[owner] + bit, minlength=64 * words.sum()) & 1
    return words, np.packbits(odd.astype(np.uint8)).view(np.int64)


Cells = tuple[np.ndarray, np.ndarray, np.ndarray]


def cells(sizes: np.ndarray, members: np.ndarray, limit: Threshold, counts: np.ndarray) -> Cells:
    """Cells of each set: (index of the set, shingle, its place in the order). Sets that only link to equal ones have none."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((members, counts[bucket(members)], owner))
    rank = np.arange(len(members)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    prefix = sizes - limit.shared(sizes) + 1
    prefix[limit.apart(sizes + limit.largest(sizes)) == 0] = 0
    kept = rank < prefix[owner]
    return owner[kept], members[order[kept]].view(np.int64), rank[kept]


def segment_cells(sizes: np.ndarray, members: np.ndarray, limit: Threshold) -> Cells:
    """Cells of several shingles: (index of the set, 64-bit cell, 0 as its place)."""
    starts = np.cumsum(sizes) - sizes
    ring = np.frexp(np.maximum(sizes, 1))[1] - 1
    near = sizes * limit.den >= limit.num * (2 << ring)  # in the window of the next ring
    index = np.concatenate([np.arange(len(sizes)), np.flatnonzero(near)])
    ring = np.concatenate([ring, ring[near] + 1])
    top = (2 << ring) - 1
    size = sizes[index]
    differ = limit.apart(size + np.minimum(limit.largest(size), top))
    index, ring, top, size, differ = (x[(size > 0) & (differ > 0)] for x in (index, ring, top, size, differ))
    if not len(index):
        return index, np.zeros(0, dtype=np.int64), index
    segments = (limit.apart(2 * top) + 1) * 11 // 10 + 3
    base = np.cumsum(segments) - segments
    member = members[ragged(starts[index], size)]
    owner = np.repeat(np.arange(len(index)), size)
    at = base[owner] + (mix(member, 5) % segments[owner].astype(U64)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    at, heads = np.unique(at[order], return_index=True)
    content = np.add.reduceat(mix(member[order], 6), heads)
    owner = owner[order][heads]
    filled = np.bincount(owner, minlength=len(index))
    if (few := np.flatnonzero(filled <= differ)).size:  # the empty segments of these count as well
        empty = np.setdiff1d(ragged(base[few], segments[few]), at, assume_unique=True)
        at = np.concatenate([at, empty])
        content = np.concatenate([content, np.zeros(len(empty), dtype=U64)])
        owner = np.concatenate([owner, np.searchsorted(base, empty, "right") - 1])
    place = ((ring[owner] << 40) + (at - base[owner])).astype(U64)
    cell = mix(content ^ mix(place, 8), 9)
    order = np.lexsort((cell, content == 0, owner))
    owner, cell = owner[order], cell[order]
    rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
    kept = (rank <= differ[owner]) | (filled <= differ)[owner]
    return index[owner[kept]], cell[kept].view(np.int64), np.zeros(kept.sum(), dtype=np.int64)


def bucket(members: np.ndarray) -> np.ndarray:
    return (mix(members, 12) >> U64(64 - SKETCH_BITS)).astype(np.int64)


def packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype(np.uint64).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype=np.uint64)


def jaccard_join(
    docs: DataFrame,
    words: int = 5,
    num: int = 4,
    den: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    segments: bool | None = None,
) -> JaccardJoin:
    """Classes of documents linked at a similarity of ``num/den`` or more over shingles of ``words`` words.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A text of fewer words is one shingle. Null, empty and
    wordless texts have an empty set, link to nothing and are classes of their own. ``component_id`` is the
    smallest id of the class (null ids aside). ``segments`` chooses the kind of cells (by default segments for shingles
    of up to three words); the result is the same. Rows that repeat an id are documents of their own and are all
    returned. Texts are read whole, whatever their length. Other columns are not touched; an empty input gives empty results.
    Both results are stored, and all that was stored on the way is removed.
    """
    with scratch(prepared(docs.sparkSession)) as kept:
        found = _joined(docs, words, Threshold(num, den), words <= 3 if segments is None else segments, id_col, text_col)
        return JaccardJoin(kept(found.classes, "classes"), kept(found.links, "links"))


def _joined(docs: DataFrame, words: int, limit: Threshold, by_segment: bool, id_col: str, text_col: str) -> JaccardJoin:
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document, and at the end one with the task's shingle counts."""
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint64)
        names = ["id", "node", "n", *PARITY, "fine", "counts"]
        for batch in batches:
            found = [[np.zeros(0, np.int64)] * (4 + len(PARITY))]
            for _, sizes, members in shingle_sets(batch["text"], words):
                found.append([digests(sizes, members), sizes, *parities(sizes, members), *fine_parities(sizes, members)])
                counts += np.bincount(bucket(members), minlength=len(counts)).astype(np.uint64)
            *columns, lengths, fine = (np.concatenate(column) for column in zip(*found))
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            rows = [batch["id"], *map(pa.array, columns), pa.ListArray.from_arrays(pa.array(ends), pa.array(fine))]
            yield pa.RecordBatch.from_arrays([*rows, pa.nulls(len(batch), pa.binary())], names)
        none = [pa.nulls(1, arrow_kind), *(pa.nulls(1, pa.int64()) for _ in names[1:-2]), pa.nulls(1, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*none, pa.array([packed(counts)], pa.binary())], names)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint64)
        for batch in batches:
            for data in batch["counts"]:
                counts += unpacked(data.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([packed(counts)], pa.binary())], ["counts"])

    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        nodes, counts, sets = [], [], []
        for _, sizes, members in shingle_sets(batch["text"], words):
            nodes.append(digests(sizes, members))
            counts.append(sizes)
            sets.append(members)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), lists], ["node", "members"])

    arrow_kind = to_arrow_type(texts.schema["id"].dataType)
    numbers = ", ".join(f"{name} bigint" for name in ("node", "n", *PARITY))
    passed = stored(texts.mapInArrow(measure, f"id {kind}, {numbers}, fine array<bigint>, counts binary"), "sets")
    measured = passed.where("n IS NOT NULL").drop("counts")
    n_docs = measured.count()
    sketches = passed.where("counts IS NOT NULL").select("counts").repartition(SKETCH_PARTS).mapInArrow(add_up, "counts binary")
    counts = sum((unpacked(row["counts"]) for row in sketches.collect()), np.zeros(1 << SKETCH_BITS, dtype=np.uint64))

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        nodes, found, places = [], [], []
        for _, sizes, members in shingle_sets(batch["text"], words):
            index, cell, place = segment_cells(sizes, members, limit) if by_segment else cells(sizes, members, limit, counts)
            nodes.append(digests(sizes, members)[index])
            found.append(cell)
            places.append((sizes[index] << 32) | place)
        columns = [pa.array(np.concatenate(x)) for x in (found, nodes, places)]
        return pa.RecordBatch.from_arrays(columns, ["cell", "node", "place"])

    some = measured.where("n > 0")
    firsts = some.groupBy("node").agg(F.min("id").alias("id"), *(F.min(c).alias(c) for c in ("n", *PARITY)))
    first = stored(few_tasks(firsts, n_docs), "first")
    copies = some.join(first.select("node", F.col("id").alias("kept")), "node").where(F.col("id") != F.col("kept"))
    skipped = stored(few_tasks(copies.select("id").distinct().join(first, "id", "left_anti"), n_docs), "copies")
    spread_rows = map_arrow(by_ids(texts, skipped, "id", "left_anti"), spread, "cell bigint, node bigint, place bigint")
    cell = Window.partitionBy("cell")
    # Dealt out by cell first, so that what the window sums is made behind the shuffle and not sent through it.
    dealt = spread_rows.repartition("cell")
    if not by_segment:  # rings keep the sizes of a segment's cell near each other
        # In the order of sizes a member that can link neither to the one before nor to the one after can link to none. Shingles shared
        # by chance grow faster than the documents, and most of their cells end here.
        ordered = cell.orderBy("place", "node")
        beside = dealt.withColumns({"before": F.lag("place").over(ordered), "after": F.lead("place").over(ordered)})
        dealt = beside.where(limit.sizes_near("before", "place") | limit.sizes_near("place", "after")).drop("before", "after")
    ends = {f: getattr(F, f)(F.struct("node", "place")).over(cell) for f in ("min", "max")}
    met = (
        dealt.withColumns(
            {"first": ends["min"], "last": ends["max"], "members": F.count(F.lit(1)).over(cell)}
            | {f"sum_{i}": F.sum(part).over(cell) for i, part in enumerate(_parts("node"))}
        )
        .where(F.col("first.node") != F.col("last.node"))
        # Two members are one pair, which is met here or not at all.
        .where((F.col("members") > 2) | limit.may_link("first.place", "last.place"))
        .select(
            # Cells of the same members ask the same question. They become one cell, named by the set of its members.
            F.xxhash64("members", *(f"sum_{i}" for i in range(4))).alias("cell"),
            F.xxhash64(*(f"sum_{i}" for i in range(4)), "members", F.lit(1)).alias("check"),
            "node",
            "place",
            F.col("first.node").alias("pivot"),
            F.col("first.place").alias("p_place"),
        )
    )
    # A pair passes in one of them, the cell of its first shared member, and so with the smallest places of both.
    once = met.groupBy("cell", "check", "node").agg(*(F.min(c).alias(c) for c in ("place", "pivot", "p_place")))
    shared = stored(once.withColumn("cell", F.xxhash64("cell", "check")).drop("check"), "cells")
    open_rows = shared.where(F.col("node") != F.col("pivot"))
    may = limit.may_link("place", "p_place")
    n_open = shared.count()
    nodes = stored(few_tasks(shared.select("node").distinct().join(first, "node"), n_docs), "nodes")
    to_pivot = open_rows.where(may).groupBy("node", "pivot").agg(F.min("place").alias("place"), F.min("p_place").alias("p_place"))
    pivot = nodes.select(F.col("node").alias("pivot"), *(F.col(c).alias(f"p_{c}") for c in PARITY))
    close_pairs = to_pivot.join(nodes.select("node", *PARITY), "node").join(pivot, "pivot").where(limit.near())
    pairs = stored(few_tasks(close_pairs.select("node", F.col("pivot").alias("other")), n_open), "pairs")

    def compared(found: DataFrame) -> DataFrame:
        """Exact distances of the pairs whose fine parities allow a link; only their sets are built, and they are removed again."""
        with scratch(docs.sparkSession) as kept:
            close = stored(few_tasks(finely_near(found), count := found.count()), "close")
            return kept(few_tasks(distances(close), count * SET_ROWS), "distances")

    def finely_near(found: DataFrame) -> DataFrame:
        ends = few_tasks(found.select("node").union(found.select("other")).distinct(), 2 * found.count())
        fine = by_ids(measured.select("node", "n", "fine"), stored(ends, "ends"), "node", "left_semi").dropDuplicates(["node"])
        other = fine.select(F.col("node").alias("other"), F.col("n").alias("p_n"), F.col("fine").alias("p_fine"))
        return found.join(fine, "node").join(other, "other").where(limit.finely_near()).select("node", "other")

    def distances(found: DataFrame) -> DataFrame:
        ends = found.select("node").union(found.select("other")).distinct().join(nodes, "node")
        ids = stored(few_tasks(ends.where("id IS NOT NULL").select("id").distinct(), 2 * found.count()), "ids")
        known = by_ids(texts, ids, "id", "left_semi").union(texts.where("id IS NULL"))
        sets = stored(map_arrow(known, build, "node bigint, members array<bigint>"), "members")
        if sets.count() != ids.count():  # ids that repeat, or null ids
            sets = sets.dropDuplicates(["node"])
        return _distances(found, sets, limit)

    seen = compared(pairs)
    links = seen.where("linked")
    n_nodes = nodes.count()
    labels = _merged(nodes.select("node", *PARITY, F.col("node").alias("label")), links, n_nodes)
    radius = 1 - limit.num / limit.den + EPSILON
    # A member that cannot link to its pivot may have no distance, and then has no window.
    far = seen.select("node", F.col("other").alias("pivot"), "far")
    active = open_rows.join(far, ["node", "pivot"], "left").select("cell", "node", "place", "far")
    turn, before = 0, None
    while True:
        turn += 1
        labelled = active.join(labels, "node")
        undecided = (
            labelled.withColumn("least", F.min("label").over(cell))
            .withColumn("most", F.max("label").over(cell))
            .where(F.col("least") != F.col("most"))
            .withColumn("rank", F.row_number().over(cell.orderBy(F.asc_nulls_last("far"), "node")))
        )
        undecided = undecided.select("cell", "node", "place", "far", "label", "rank", *PARITY)
        rows = stored(few_tasks(undecided, n_open), "open")
        if before is not None:
            discard(before)
        n_open = rows.count()
        if not n_open:
            break
        before = rows
        pivots = rows.where(F.col("rank") <= 16**turn).select(
            "cell", *(F.col(c).alias(f"p_{c}") for c in ("node", "place", "far", "label", "rank", *PARITY))
        )
        close = F.coalesce(F.abs(F.col("far") - F.col("p_far")) <= radius, F.lit(True))
        meeting = (
            rows.join(pivots, "cell")
            .where((F.col("rank") > F.col("p_rank")) & may & limit.near())
            .where((F.col("p_rank") == 1) | (F.col("label") != F.col("p_label")) & close)
        )
        pairs = stored(few_tasks(meeting.select("node", F.col("p_node").alias("other")).distinct(), n_open), "pairs")
        seen = compared(pairs)
        more = seen.where("linked")
        links = links.union(more)
        labels = _merged(labels, more, n_nodes)
        first_pivot = pivots.where("p_rank = 1").select("cell", F.col("p_node").alias("other"))
        active = (
            rows.where(F.col("rank") > 16**turn)
            .select("cell", "node", "place")
            .join(first_pivot, "cell")
            .join(seen, ["node", "other"], "left")
            .select("cell", "node", "place", "far")
        )

    named = measured.join(labels, "node", "left").select(
        "id", "n", F.when(F.col("n") > 0, F.coalesce("label", "node")).alias("label")
    )
    smallest = named.groupBy("label").agg(F.min("id").alias("least"))
    classes = named.join(smallest, "label", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"),
    )
    return JaccardJoin(few_tasks(classes, n_docs), few_tasks(links, n_docs))


def _parts(node: str) -> list[Column]:
    """Four hashes of 32 bits; their sums over the members of a cell tell its set."""
    hashes = F.xxhash64(node), F.xxhash64(node, F.lit(1))
    return [part for h in hashes for part in (h.bitwiseAND(2**32 - 1), F.call_function("shiftrightunsigned", h, F.lit(32)))]


def _merged(labels: DataFrame, links: DataFrame, n_nodes: int) -> DataFrame:
    """Labels after further links; only ends in different classes matter."""
    left = links.join(labels, "node").select("other", F.col("label").alias("a"))
    edges = left.join(labels, left["other"] == labels["node"]).select("a", F.col("label").alias("b"))
    edges = stored(few_tasks(edges.where("a <> b").distinct(), links.count()), "merges")
    if edges.isEmpty():
        return labels
    moved = components(edges).select(F.col("node").alias("old"), F.col("label").alias("new"))
    renamed = labels.join(moved, F.col("label") == F.col("old"), "left")
    return stored(few_tasks(renamed.select("node", *PARITY, F.coalesce("new", "label").alias("label")), n_nodes), "classes")


def _distances(pairs: DataFrame, sets: DataFrame, limit: Threshold) -> DataFrame:
    """Exact sizes of intersection and union of each pair, and whether it links.

    The set of each pair's ``node`` goes to its ``other``, whose own set goes there once, however many pairs it is in.
    """
    with_node = by_pairs(sets, pairs, "node")
    heads = by_ids(sets, stored(pairs.select(F.col("other").alias("node")).distinct(), "heads"), "node", "left_semi")
    other = heads.select(F.col("node").alias("other"), F.col("members").alias("others"))
    both = F.size(F.array_intersect("members", "others")).cast("long")
    found = with_node.join(other, "other").select(
        "node", "other", both.alias("shared"), (F.size("members") + F.size("others") - both).alias("either")
    )
    return found.withColumns(
        {
            "linked": F.col("shared") * limit.den >= F.col("either") * limit.num,
            "far": 1 - F.col("shared") / F.col("either"),
        }
    )

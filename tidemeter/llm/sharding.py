"""Sharding by a k-d tree over document metadata.

Nodes are split at weighted medians along their widest dimension until each leaf is one shard. Medians are found by
histograms: each round sums the bytes of 256 ranges of every node and looks into the range that holds the median.
What is split are units: all copies of a text, so that they stay together, except where the copies weigh more than the
tolerated share of a shard; those are split by id into small units, as no cut near them could leave sizes near equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.llm.shared import numbered, prepared, stored

# Units of a split group weigh about this part of a shard, down to single documents.
FINENESS = 256
RANGES = 256
# Order of a node's units: 30 bits of the coordinate, then 32 bits of a hash.
TOP = 62
SLOT_ROWS = 20_000


def kd_shards(
    docs: DataFrame,
    shards: int = 8,
    dimensions: Sequence[Column] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_bytes: int | None = None,
    keep_text: bool = True,
    tolerance: float = 1 / 8,
) -> DataFrame:
    """Input rows (without the text if not ``keep_text``), and size, text_crc32, law, shard, slot, grown_shard (null: the law is ``bytes``).

    ``size``: bytes of the text (null: none) plus 1. ``target_bytes`` sets the number of shards from the total. The
    dimensions are integers, by default size, language and source; null counts as 0. Rows that repeat an id or a text
    are all kept, with slots of their own. Copies of a text share a shard unless they weigh more than ``tolerance`` (an
    eighth) of a shard together; sizes may differ by about as much. A single text, however long, is never cut. Slots
    number each shard's rows in the order of hashed ids. With fewer units than shards some shards are empty. Input columns with the names of the results are replaced. Places are found
    without the texts, which are shuffled once, to their places.
    """
    spark = prepared(docs.sparkSession)
    names = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    if dimensions is None:
        numbers = [F.crc32(F.col(c).cast("string").cast("binary")) for c in ("lang", "source") if c in docs.columns]
        dimensions = [F.octet_length(text), *numbers]
    axes = [f"_d{i}" for i in range(len(dimensions))]
    measured = docs.withColumns(
        {
            "_size": (F.octet_length(text) + 1).cast("long"),
            "_crc": F.crc32(text),
            "_content": F.xxhash64(text, F.md5(text)),
            "_blank": F.col(text_col).isNull(),
        }
        | {a: F.coalesce(d.cast("long"), F.lit(0)) for a, d in zip(axes, dimensions)}
    ).drop(text_col, *names)
    rows = stored(measured.withColumn("_id", F.col(id_col)), "rows")
    total = rows.agg(F.sum("_size")).first()[0] or 0
    if target_bytes:
        shards = max(1, -(-total // target_bytes))
    grain = max(1, total // (shards * FINENESS))
    groups = rows.groupBy("_content").agg(F.sum("_size").alias("_weight"))
    # At most shards / tolerance contents can be heavier than that.
    heaviest = F.lit(total / shards * tolerance)
    heavy = groups.where(F.col("_weight") > heaviest).select("_content", F.ceil(F.col("_weight") / grain).alias("_cuts"))
    split = rows.join(F.broadcast(heavy), "_content", "left")
    piece = F.coalesce(F.pmod(F.xxhash64("_id"), F.col("_cuts")), F.lit(0))
    rows = split.withColumn("_unit", F.xxhash64("_content", piece)).drop("_cuts")
    units = rows.groupBy("_unit").agg(F.sum("_size").alias("weight"), *(F.min(a).alias(a) for a in axes))
    units = stored(units.withColumn("node", F.lit(0)), "units")

    nodes = {0: (0, shards)}  # node: first shard, number of shards; never more nodes than shards
    bounds = units.agg(*(f(a) for a in axes for f in (F.min, F.max))).first()
    spans = [max(1, (high or 0) - (low or 0)) for low, high in zip(bounds[::2], bounds[1::2])]
    number = 0
    while open_nodes := {n: s for n, s in nodes.items() if s[1] > 1}:
        keyed = _ordered(units, axes, spans, sorted(open_nodes))
        cuts = _medians(keyed, {n: (s[1] // 2) / s[1] for n, s in open_nodes.items()}, grain)
        moves = []
        for node, (first, count) in open_nodes.items():
            left, right, number = number + 1, number + 2, number + 2
            nodes[left], nodes[right] = (first, count // 2), (first + count // 2, count - count // 2)
            moves.append((node, cuts.get(node, 0), left, right))
            del nodes[node]
        table = F.broadcast(spark.createDataFrame(moves, "node int, cut long, left int, right int"))
        side = F.when(F.col("key") < F.col("cut"), F.col("left")).otherwise(F.col("right"))
        moved = keyed.join(table, "node", "left").withColumn("node", F.coalesce(side, "node"))
        units = stored(moved.select(*units.columns), "units")

    leaves = F.broadcast(spark.createDataFrame([(n, s[0]) for n, s in nodes.items()], "node int, shard int"))
    placed = rows.join(units.join(leaves, "node").select("_unit", "shard"), "_unit")
    buckets = 1 + rows.count() // (SLOT_ROWS * shards)
    hashed = F.xxhash64("_id", "_crc")
    slotted = numbered(placed, "shard", [hashed, F.col("_id"), F.col("_crc"), F.col("_size")], "slot", hashed, buckets)
    if keep_text:
        # Rows that agree in id and content hold the same text, whichever of them it is taken from.
        own = F.col(id_col).alias("_i"), F.xxhash64(text, F.md5(text)).alias("_c"), F.col(text_col).isNull().alias("_b")
        texts = docs.select(*own, F.col(text_col).alias("_text")).dropDuplicates(["_i", "_c", "_b"])
        same = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_content") == F.col("_c")) & (F.col("_blank") == F.col("_b"))
        slotted = slotted.join(texts, same).withColumn(text_col, F.col("_text"))
    kept = [c for c in docs.columns if c not in names and (keep_text or c != text_col)]
    return slotted.select(
        *kept,
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _ordered(units: DataFrame, axes: list[str], spans: list[int], open_nodes: list[int]) -> DataFrame:
    """Units with ``key``: their place along their node's widest dimension, relative to the whole."""
    edges = units.where(F.col("node").isin(open_nodes)).groupBy("node").agg(
        *(f(a).alias(f"{n}{a}") for a in axes for n, f in (("low", F.min), ("high", F.max)))
    )
    widths = [(F.col(f"high{a}") - F.col(f"low{a}")) / F.lit(float(s)) for a, s in zip(axes, spans)]
    widest = F.array_position(F.array(*widths), F.array_max(F.array(*widths)))
    edges = edges.select(F.col("node").alias("_n"), widest.cast("int").alias("_axis"), *(F.col(f"low{a}") for a in axes))
    joined = units.join(F.broadcast(edges), F.col("node") == F.col("_n"), "left")
    value = F.element_at(F.array(*(F.col(a) - F.col(f"low{a}") for a in axes)), F.coalesce("_axis", F.lit(1)))
    span = F.element_at(F.array(*(F.lit(s) for s in spans)), F.coalesce("_axis", F.lit(1)))
    high = F.floor(value / span * (2**30 - 1)).cast("long")
    key = F.shiftleft(high, 32).bitwiseOR(F.pmod(F.xxhash64("_unit"), F.lit(2**32)))
    return stored(joined.withColumn("key", F.coalesce(key, F.lit(0))).select(*units.columns, "key"), "ordered")


def _medians(keyed: DataFrame, parts: dict[int, float], grain: int) -> dict[int, int]:
    """For each node the key that leaves the wanted part of its bytes below."""
    spark = keyed.sparkSession
    found: dict[int, int] = {}
    ranges = {n: (0, 1 << TOP, 0, None) for n in parts}  # low, width, bytes below, wanted bytes
    while ranges:
        table = F.broadcast(spark.createDataFrame([(n, r[0], r[1]) for n, r in ranges.items()], "node int, low long, width long"))
        inside = keyed.join(table, "node").where((F.col("key") >= F.col("low")) & (F.col("key") - F.col("low") < F.col("width")))
        at = F.expr("(key - low) div greatest(1, width div %d)" % RANGES).alias("at")
        sums = inside.groupBy("node", at).agg(F.sum("weight").alias("weight")).orderBy("node", "at").collect()
        by_node: dict[int, list] = {n: [] for n in ranges}
        for row in sums:
            by_node[row["node"]].append((row["at"], row["weight"]))
        following = {}
        for node, (low, width, below, wanted) in ranges.items():
            if wanted is None:
                wanted = sum(w for _, w in by_node[node]) * parts[node]
            step = max(1, width // RANGES)
            for at_range, weight in by_node[node]:
                if below + weight >= wanted:
                    start = low + at_range * step
                    if step == 1 or weight <= grain // 2:
                        found[node] = start + step if below + weight - wanted < wanted - below else start
                    else:
                        following[node] = (start, step, below, wanted)
                    break
                below += weight
        ranges = following
    return found

"""Merkle manifest of a data set by concatenated-level strings.

The rows of a source, in the order of their ids, are the leaves of a tree: every ``FAN`` nodes are hashed to one, until one is
left; the sources' nodes make a further tree, whose top is the root. The leaves are cut into aligned blocks of ``FAN`` x ``FAN``. A
block keeps each of its two levels as one string of hex digests: a parent is the hash of a fixed-width substring, and
the siblings of a node are the substrings that flank it in its run. The tops of the blocks are the leaves of the next
round, so a tree takes one shuffle for each two levels, and no source is gathered anywhere.

Proofs go down again: a block's path to the root (pairs of flanks) is that of its parent's place, and each row folds its own leaf along
it. What one row or block carries is bounded by the height of the trees.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.llm.ranked import ranked
from tidemeter.llm.shared import prepared, stored

FAN = 16
HEX = 64
RUN = FAN * HEX
BLOCK = FAN * FAN
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(values: list[Column]) -> Column:
    """Hash of the values: ``-`` for null, else the number of bytes, a colon and the value as text."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*(part(v) for v in values)), 256)


def _slice(level: Column, start: Column, width: Column) -> Column:
    """Fixed-width part of a level (bytes of hex digests, from 0)."""
    return F.substring(level, (start + 1).cast("int"), width.cast("int"))


def _parents(level: Column) -> Column:
    """The level above: the hashes of all runs, the last one shorter, as one string."""
    runs = F.sequence(F.lit(0), F.ceil(F.octet_length(level) / RUN).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: F.sha2(_slice(level, i * RUN, F.lit(RUN)), 256)), "").cast("binary")


def _flanks(level: Column, at: Column) -> Column:
    """What stands before and after the node ``at`` in its run."""
    run = F.floor(at / FAN) * RUN
    node = at * HEX
    before, after = _slice(level, run, node - run), _slice(level, node + HEX, run + RUN - node - HEX)
    return F.struct(before.alias("before"), after.alias("after"))


def _blocks(nodes: DataFrame, *carried: str) -> DataFrame:
    """Rows tree, pos, of (nodes of the tree), digest -> blocks: tree, block, of (blocks of the tree), entries, low, high, height, top."""
    entry = F.struct("pos", "digest", *carried)
    blocks = nodes.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(entry)).alias("entries"), F.first("of").alias("nodes")
    )
    low = F.array_join(F.transform("entries", lambda e: e["digest"]), "").cast("binary")
    # A tree of one block ends as soon as one node is left; blocks of a larger tree have both levels.
    height = F.when(F.col("nodes") > FAN, 2).when(F.col("nodes") > 1, 1).otherwise(0)
    leveled = blocks.withColumn("low", low).withColumn("height", height)
    leveled = leveled.withColumn("high", F.when(F.col("height") > 0, _parents(F.col("low"))))
    top = F.when(F.col("height") == 2, F.sha2("high", 256)).otherwise(F.coalesce("high", "low").cast("string"))
    return leveled.select("tree", "block", F.ceil(F.col("nodes") / BLOCK).alias("of"), "entries", "low", "high", "height", top.alias("top"))


def _rounds(blocks: DataFrame) -> list[DataFrame]:
    """Blocks of blocks, until every tree is one block. Each round is stored."""
    rounds = [stored(blocks, "blocks")]
    while not (more := rounds[-1].where(F.col("of") > 1)).isEmpty():
        nodes = more.select("tree", F.col("block").alias("pos"), "of", F.col("top").alias("digest"))
        rounds.append(stored(_blocks(nodes), "blocks"))
    return rounds


def _tops(rounds: list[DataFrame]) -> DataFrame:
    """The one node that is left of each tree: tree, top."""
    tops = [r.where(F.col("of") == 1).select("tree", "top") for r in rounds]
    for more in tops[1:]:
        tops[0] = tops[0].union(more)
    return tops[0]


def _placed(blocks: DataFrame) -> DataFrame:
    """Blocks with ``upper`` (their path upwards) -> a row for each entry with ``path``, its own path."""
    rows = blocks.withColumn("entry", F.explode("entries"))
    at = F.col("entry.pos") % BLOCK
    low, high = _flanks(F.col("low"), at), _flanks(F.col("high"), F.floor(at / FAN))
    own = F.when(F.col("height") == 2, F.array(low, high)).when(F.col("height") == 1, F.array(low)).otherwise(F.array_repeat(low, 0))
    return rows.withColumn("path", F.concat(own, "upper"))


def _same_tree(left: DataFrame, right: DataFrame) -> Column:
    return left["tree"].eqNullSafe(right["tree"])


def _down(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Blocks of the first round with their path upwards; ``above``: tree, path of the tree's top. Blocks of one tree meet its path
    only if they are its top block; the others take theirs from the block above them."""
    tops = above.select("tree", F.col("path").alias("upper"))
    lower = None
    for number, blocks in reversed(list(enumerate(rounds))):
        top = blocks.where(F.col("of") == 1)
        known = top.join(tops, _same_tree(top, tops)).drop(tops["tree"])
        if lower is not None:
            rest = blocks.where(F.col("of") > 1)
            known = known.unionByName(
                rest.join(lower, _same_tree(rest, lower) & (rest["block"] == lower["pos"])).drop(lower["tree"]).drop("pos")
            )
        if number:
            lower = stored(_placed(known).select("tree", "entry.pos", F.col("path").alias("upper")), "paths")
    return known


@dataclass(frozen=True)
class MerkleManifest:
    """``rows``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. ``sources``: source, subroot, rows. ``root``: one row."""

    rows: DataFrame
    sources: DataFrame
    root: DataFrame


def merkle_manifest(docs: DataFrame, tampered: Column | None = None, fields: tuple[str, ...] = FIELDS) -> MerkleManifest:
    """Manifest of all rows, and the check of each row, as it is found later, against the root by its proof.

    ``fields`` are the id, the source and what else makes a leaf, the text last. ``tampered`` says which rows are found with their text
    in lower case (A-Z): of such a row the root is folded from what is found. ``proof_sha256`` hashes the siblings, level by level
    from the leaf over the source's node to the root; without siblings that is the hash of nothing.
    Null ids come first in a source, rows of equal ids in the order of their leaves; rows that repeat are leaves of their own.
    A null source is a source of its own and the first. A row whose ``tampered`` is null is found as it was. Texts are hashed whole and not moved,
    whatever their length. Other columns are not touched; an empty input has no rows and no root.
    """
    prepared(docs.sparkSession)
    id_col, source, text = fields[0], fields[1], F.col(fields[-1])
    values = [F.col(f) for f in fields]
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.coalesce(tampered if tampered is not None else F.lit(False), F.lit(False))
    leaf = leaf_hash(values)
    leaves = docs.select(
        F.col(source).alias("tree"), F.col(id_col).alias("id"), leaf.alias("digest"), F.when(changed, leaf_hash([*values[:-1], lowered])).alias("found")
    )
    leaves = stored(leaves, "leaves")
    numbered = ranked(leaves, "tree", [F.col("id").asc_nulls_first(), F.col("digest")], "pos").withColumnRenamed("pos_of", "of")
    rounds = _rounds(_blocks(numbered, "id", "found"))
    tops = stored(_tops(rounds), "subroots")
    listed = tops.select(F.lit(0).alias("tree"), F.col("tree").alias("source"), F.col("top").alias("digest"))
    listed = ranked(listed, "tree", [F.col("source").asc_nulls_first()], "pos").withColumnRenamed("pos_of", "of")
    upper = _rounds(_blocks(listed, "source"))
    root = stored(_tops(upper).select("tree", F.col("top").alias("root")), "root")

    no_path = "array<struct<before:binary,after:binary>>"
    ends = root.select("tree", F.expr(f"cast(array() as {no_path})").alias("path"))
    above = _placed(_down(upper, ends)).select(F.col("entry.source").alias("tree"), "path", F.col("entry.digest").alias("subroot"))
    top = root.first()  # one digest
    above = stored(above.withColumn("root", F.lit(top["root"] if top else None).cast("string")), "sources")
    blocks = stored(_down(rounds, above.select("tree", "path")), "proven")
    named = above.select("tree", "subroot", "root")
    blocks = blocks.join(named, _same_tree(blocks, named)).drop(named["tree"])
    path = F.col("path")
    siblings = F.aggregate(path, F.lit("").cast("binary"), lambda all_, s: F.concat(all_, s["before"], s["after"]))
    start = F.coalesce("entry.found", "entry.digest")
    folded = F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["before"], node.cast("binary"), s["after"]), 256))
    rows = _placed(blocks).select(
        F.col("entry.id").alias(id_col),
        F.col("entry.digest").alias("leaf"),
        "subroot",
        "root",
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    rows = rows.withColumn("verified", F.col("folded_root") == F.col("root"))
    sizes = leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("rows"))
    sources = sizes.join(named, _same_tree(sizes, named)).select(sizes["tree"].alias(source), "subroot", "rows")
    return MerkleManifest(rows, sources, root.select("root"))

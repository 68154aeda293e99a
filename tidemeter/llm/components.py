"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemeter.llm.shared import few_tasks, scratch, stored


def components(edges: DataFrame) -> DataFrame:
    """Label of every node of ``edges`` (``a``, ``b``): rows ``node``, ``label``; equal labels, one component.

    Each round, every node moves to the neighbour (or itself) with the smallest hash, new in each round, and on
    to where that one moves; the edges follow their ends and what becomes a loop or repeats goes. A round removes a fixed share of the nodes on
    average, whatever the shape, so the rounds are logarithmic. No component is gathered anywhere: the smallest
    neighbour is an aggregate, and a hot node is split by the skew join.
    """
    with scratch(edges.sparkSession) as kept:
        return kept(_labels(edges), "labels")


def _labels(edges: DataFrame) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    edges = stored(few_tasks(_undirected(edges), edges.count()), "edges")
    count = n_ends = edges.count()
    ends = edges.select(a.alias("node")).union(edges.select(b.alias("node"))).distinct()
    labels, turn = ends.withColumn("label", F.col("node")), 0
    while count:
        turn += 1
        both = edges.union(edges.select(b, a))
        rank = F.struct(F.xxhash64("b", F.lit(turn)).alias("h"), b)
        own = F.struct(F.xxhash64("a", F.lit(turn)).alias("h"), a.alias("b"))
        step = both.groupBy("a").agg(F.min(rank).alias("to")).select(a.alias("old"), F.least("to", own)["b"].alias("new"))
        further = step.select(F.col("old").alias("mid"), F.col("new").alias("end"))
        moved = step.join(further, F.col("new") == F.col("mid")).select("old", F.col("end").alias("new"))
        moves = stored(few_tasks(moved, 2 * count), "moves")
        left = edges.join(moves, a == F.col("old")).select(F.col("new").alias("a"), "b")
        followed = _undirected(left.join(moves, b == F.col("old")).select("a", F.col("new").alias("b")))
        edges = stored(few_tasks(followed, count), "edges")
        count = edges.count()
        renamed = labels.join(moves, F.col("label") == F.col("old"), "left")
        labels = renamed.select("node", F.coalesce("new", "label").alias("label"))
    return few_tasks(labels, 2 * n_ends)


def _undirected(edges: DataFrame) -> DataFrame:
    """Each edge once, without loops."""
    ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    return edges.where(F.col("a") != F.col("b")).select(*ends).distinct()

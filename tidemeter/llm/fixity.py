"""Merkle fixity audit of WARC archives.

The records of an archive, in the order of their offsets, are the leaves of a tree of hashes; a node covers the offset range
of up to ``FAN`` nodes below. Two replicas are compared at their roots, and only below nodes that differ.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemeter.llm.shared import prepared, stored

FAN = 16
ARCHIVE_RECORDS = 1000


def warc_record(record_id: Column, url: Column, html: Column) -> Column:
    """A WARC resource record as text; null parts are empty."""
    empty = F.lit("")
    body = F.coalesce(html, empty)
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(record_id.cast("string"), empty),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, empty),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Records in archives of 1000 consecutive ids: archive, seq, at, length, digest, id.

    Null ids share archive -1. Equal ids stand in the order of their digests; records that are equal throughout
    are records of their own. Offsets are sums over one archive, whose size the ids bound unless they repeat.
    """
    record = warc_record(F.col(id_col), F.col(url_col), F.col(html_col))
    number = F.coalesce(F.floor(F.col(id_col) / ARCHIVE_RECORDS), F.lit(-1)).cast("long")
    hashed = pages.select(
        number.alias("archive"), F.col(id_col).alias("id"), F.octet_length(record).cast("long").alias("length"), F.sha2(record, 256).alias("digest")
    )
    own = Window.partitionBy("archive").orderBy("id", "digest")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    return hashed.withColumns(
        {
            "seq": (F.row_number().over(own) - 1).cast("long"),
            "at": F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"),
        }
    )


def merkle_tree(records: DataFrame) -> DataFrame:
    """All nodes: archive, level (0: records), seq, from, to (offsets), digest. Stored, by level.

    Nodes hash the digests and offset ranges below them, so moved or missing records change them too. All trees have
    the height of the tallest.
    """
    spark = prepared(records.sparkSession)
    level = records.select("archive", F.lit(0).alias("level"), "seq", F.col("at").alias("from"), (F.col("at") + F.col("length")).alias("to"), "digest")
    level = stored(level, "leaves")
    levels, top = [level], level.agg(F.max("seq")).first()[0]
    while top:
        below = F.array_sort(F.collect_list(F.struct("seq", "from", "to", "digest")))  # FAN entries at most
        entry = F.transform(below, lambda n: F.concat_ws(":", n["from"], n["to"], n["digest"]))
        level = level.groupBy("archive", F.floor(F.col("seq") / FAN).alias("parent")).agg(
            F.min("from").alias("from"), F.max("to").alias("to"), F.sha2(F.array_join(entry, ","), 256).alias("digest")
        )
        level = stored(level.select("archive", F.lit(len(levels)).alias("level"), F.col("parent").alias("seq"), "from", "to", "digest"), "nodes")
        levels.append(level)
        top //= FAN
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    return stored(nodes, "tree", "level") if levels else spark.createDataFrame([], nodes.schema)


def differing(first: DataFrame, second: DataFrame) -> DataFrame:
    """Records that differ or are missing on one side: archive, seq, from, to, first_digest, second_digest.

    Roots are compared for all archives; each level below is read only for children of nodes that differ, which are
    kept in the store from level to level. Trees of different height differ as a whole.
    """
    heights = [t.agg(F.max("level")).first()[0] for t in (first, second)]
    top = max((h for h in heights if h is not None), default=0)
    open_nodes = None
    for level in range(top, -1, -1):
        sides = []
        for tree, name in ((first, "first"), (second, "second")):
            nodes = tree.where(F.col("level") == level)
            if open_nodes is not None:
                parents = open_nodes.select("archive", F.col("seq").alias("parent"))
                child = nodes.withColumn("parent", F.floor(F.col("seq") / FAN))
                nodes = child.join(parents, ["archive", "parent"], "left_semi")
            sides.append(nodes.select("archive", "seq", *(F.col(c).alias(f"{name}_{c}") for c in ("from", "to", "digest"))))
        both = sides[0].join(sides[1], ["archive", "seq"], "full")
        same = F.col("first_digest").eqNullSafe(F.col("second_digest")) & F.col("first_from").eqNullSafe(F.col("second_from"))
        open_nodes = stored(both.where(~same), "differing")
    return open_nodes.select(
        "archive",
        "seq",
        F.coalesce("first_from", "second_from").alias("from"),
        F.coalesce("first_to", "second_to").alias("to"),
        "first_digest",
        "second_digest",
    )


@dataclass(frozen=True)
class ReplicaAudit:
    """``records``: every record of the first replica (as of ``archived``) with ``intact``: whether the second holds it unchanged
    at its place. ``surplus``: the records of the second replica at places that the first does not have, with the same
    columns; none of them is intact. Together they are the full join of the replicas by place."""

    records: DataFrame
    surplus: DataFrame


def audit_replicas(first: DataFrame, second: DataFrame) -> ReplicaAudit:
    """Against an empty second replica nothing is intact; against an empty first one all of the second is surplus."""
    first, second = stored(first, "replica"), stored(second, "replica")
    found = differing(merkle_tree(first), merkle_tree(second))
    places = found.select("archive", "seq", F.lit(False).alias("same"))
    joined = first.join(places, ["archive", "seq"], "left")
    records = joined.withColumn("intact", F.coalesce("same", F.lit(True))).drop("same")
    alone = found.where("first_digest IS NULL").select("archive", "seq")
    surplus = second.join(alone, ["archive", "seq"], "left_semi").withColumn("intact", F.lit(False))
    return ReplicaAudit(records, surplus.select(*records.columns))


def fixity_audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """The records of the first replica, as of ``audit_replicas``, which also has those of the second alone."""
    return audit_replicas(first, second).records

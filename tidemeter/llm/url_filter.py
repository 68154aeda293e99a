"""URL filter: rules on hosts first, then a tree of path templates by host with labelled purity."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemeter.llm.shared import map_arrow, prepared, stored

# Steps of the rates by which branches are summed before they are compared.
RATES = 4096

# A path part of digits, of hexadecimal digits or with a long number is variable whatever its neighbours are.
VARIABLE = r"^([0-9]+|[0-9a-fA-F]{8,}|[^/]*[0-9]{3,}[^/]*)(\.[A-Za-z0-9]+)?$"


@dataclass(frozen=True)
class TemplateLimits:
    """``fan_out``: more children of a node with fewer than ``support`` pages each are a wildcard. ``same_rate``: a branch whose labelled rate differs
    from that of a group by fewer standard errors joins it. ``support``: branches of fewer labels form no groups
    that others are compared with, unless there is none to join. ``prior``: pseudo-counts that pull a template's rate
    to that of its host, and a host's to that of all. ``max_bad``: a template over this rate is blocked."""

    fan_out: int = 20
    same_rate: float = 1.96
    prior: float = 10.0
    max_bad: float = 0.5
    support: int = 10


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end, A-Z lower-cased. Path: then up to ?, # or the end."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lowered, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule ``host/path`` that fits, else null. The list is a parameter, so small."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _parts(path: Column) -> Column:
    """Path parts, clearly variable ones as *."""
    return F.transform(
        F.filter(F.split(path, "/"), lambda p: p != ""), lambda p: F.when(p.rlike(VARIABLE), F.lit("*")).otherwise(p)
    )


def _distance(one: Sequence[float], other: Sequence[float]) -> float:
    """Standard errors between the rates of two (labelled, bad), each with one more good and one more bad label."""
    rates = [(bad + 1) / (labelled + 2) for labelled, bad in (one, other)]
    errors = [rate * (1 - rate) / (labelled + 2) for rate, (labelled, _) in zip(rates, (one, other))]
    return abs(rates[0] - rates[1]) / math.sqrt(sum(errors))


def branch_names(entries: list[dict], limits: TemplateLimits) -> list[str | None]:
    """The name of each entry's children in the templates of one node: a wildcard, a merged branch, or null for their own.

    An entry holds ``count`` children of like rate and support. More than ``fan_out`` children of few pages (``small``) are
    a wildcard, but for those whose labels differ from the rest of the small ones. All others form groups in the order of their rates: a branch of at least ``support`` labels joins the group before
    if it differs from the pooled rate by fewer than ``same_rate`` standard errors, widened by the number of
    branches that are compared; then those of fewer labels join the nearest group, or are groups of their own; last, those without
    labels join the group nearest to the rate of all. Groups never merge, so none is a bridge between others.
    """
    names: list[str | None] = [None] * len(entries)
    small = [e for e in entries if e["small"]]
    if sum(e["count"] for e in small) > limits.fan_out:
        labelled, bad = sum(e["labelled"] for e in small), sum(e["bad"] for e in small)
        widest = _widest(sum(e["count"] for e in small if e["labelled"]), limits)
        for i, e in enumerate(entries):
            own = e["labelled"] / e["count"], e["bad"] / e["count"]
            if e["small"] and _distance(own, (labelled - own[0], bad - own[1])) < widest:
                names[i] = "*"
    constant = [i for i in range(len(entries)) if names[i] is None]
    known = [i for i in constant if entries[i]["labelled"]]
    compared = sum(entries[i]["count"] for i in known)
    widest = _widest(compared, limits)
    groups: list[list[float]] = []  # labelled, bad
    members: list[list[int]] = []

    def distance(i: int, group: Sequence[float]) -> float:
        e = entries[i]
        return _distance((e["labelled"] / e["count"], e["bad"] / e["count"]), group)

    def join(i: int, at: int | None) -> None:
        if at is None:
            at = len(groups)
            groups.append([0, 0])
            members.append([])
        groups[at][0] += entries[i]["labelled"]
        groups[at][1] += entries[i]["bad"]
        members[at].append(i)

    supported = lambda i: entries[i]["labelled"] >= limits.support * entries[i]["count"]
    rate_order = lambda i: (entries[i]["bad"] / entries[i]["labelled"], -entries[i]["labelled"], entries[i]["first"])
    for i in sorted(filter(supported, known), key=rate_order):
        near = bool(groups) and distance(i, groups[-1]) < widest
        join(i, len(groups) - 1 if near else None)
    for i in sorted((i for i in known if not supported(i)), key=rate_order):
        gaps = [distance(i, g) for g in groups]
        join(i, gaps.index(min(gaps)) if gaps and min(gaps) < widest else None)
    without = [i for i in constant if not entries[i]["labelled"]]
    if without and groups:
        overall = sum(g[1] for g in groups) / sum(g[0] for g in groups)
        gaps = [(abs(g[1] / g[0] - overall), g[1] / g[0]) for g in groups]
        members[gaps.index(min(gaps))] += without
    elif without:
        members.append(without)
    for group in members:
        if sum(entries[i]["count"] for i in group) > 1:
            name = "{" + min(entries[i]["first"] for i in group) + ",..}"
            for i in group:
                names[i] = name
    return names


def _widest(compared: int, limits: TemplateLimits) -> float:
    """Standard errors that the farthest of so many equal branches stays within, and ``same_rate`` for one."""
    return math.sqrt(limits.same_rate**2 + 2 * math.log(max(1, compared)))


def path_templates(paths: DataFrame, limits: TemplateLimits) -> DataFrame:
    """``paths``: host, parts, n, labelled, bad. Adds ``template``: wildcards level by level, then merged branches.

    Each level counts the children of every node, until no node has children of more than one path. Children of a node
    are summed by rate (in steps of 1/RATES) and by power of two of their labels, so that what is decided at once for a node
    is bounded whatever the number of its children.
    """
    key = ["host", "prefix", "small", "steps", "power"]

    def decide(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for row in batch.to_pylist():
            for e, name in zip(row["entries"], branch_names(row["entries"], limits)):
                made.append((row["host"], row["prefix"], e["small"], e["steps"], e["power"], name))
        kinds = [pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], k) for i, k in enumerate(kinds)], [*key, "name"])

    tree = paths.withColumn("prefix", F.lit(""))
    closed = tree.where(F.size("parts") == 0)
    tree, level = tree.where(F.size("parts") > 0), 0
    while not tree.isEmpty():
        part = F.get("parts", F.lit(level))
        children = (
            tree.where(part != "*")
            .groupBy("host", "prefix", part.alias("part"))
            .agg(*(F.sum(c).alias(c) for c in ("n", "labelled", "bad")), F.count(F.lit(1)).alias("paths"))
        )
        some = F.col("labelled") > 0
        steps = F.when(some, F.floor(F.col("bad") / F.col("labelled") * RATES)).otherwise(F.lit(-1)).cast("long")
        power = F.when(some, F.floor(F.log2("labelled"))).otherwise(F.lit(-1)).cast("long")
        binned = children.withColumns({"small": F.col("n") < limits.support, "steps": steps, "power": power})
        sums = binned.groupBy(*key).agg(
            F.count(F.lit(1)).alias("count"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"), F.min("part").alias("first")
        )
        entry = F.struct("small", "steps", "power", "count", "labelled", "bad", "first")
        nodes = sums.groupBy("host", "prefix").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        decided = map_arrow(nodes, decide, "host string, prefix string, small boolean, steps bigint, power bigint, name string")
        # A path alone below a name of its own meets no others: the rest of it is its template.
        alone = F.col("name").isNull() & (F.col("paths") == 1)
        names = binned.join(decided, key).select(
            F.col("host").alias("_h"), F.col("prefix").alias("_p"), F.col("part").alias("_part"),
            F.coalesce("name", "part").alias("_name"), alone.alias("_alone"),
        )
        joined = tree.join(names, (tree["host"] == F.col("_h")) & (tree["prefix"] == F.col("_p")) & (part == F.col("_part")), "left")
        alone = F.coalesce("_alone", F.lit(False))
        rest = F.concat(F.lit("/"), F.array_join(F.slice("parts", level + 1, F.greatest(F.size("parts"), F.lit(1))), "/"))
        longer = F.when(alone, F.concat("prefix", rest)).otherwise(F.concat_ws("/", "prefix", F.coalesce("_name", F.lit("*"))))
        ends = alone | (F.size("parts") == level + 1)
        moved = joined.withColumns({"prefix": longer, "ends": ends}).select(*tree.columns, "ends")
        below = stored(moved, "tree", "ends")
        closed = closed.unionByName(below.where("ends").drop("ends"))
        tree, level = below.where("NOT ends").drop("ends"), level + 1
    tree = closed
    return tree.withColumn("template", F.when(F.col("prefix") == "", F.lit("/")).otherwise(F.col("prefix"))).drop("prefix")


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]],
    limits: TemplateLimits = TemplateLimits(),
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Columns: id, host, path, rule, verdict, template, bad_rate; one row per input row.

    ``labels``: ``id``, ``bad`` (0/1), of some pages; of repeated labels of an id the worst counts, null labels are
    left out. A url without ``://`` or null has empty host and path, which are judged like any other. Without any
    labels the rate is zero and everything without a rule is allowed. An empty input gives an empty result.
    """
    prepared(pages.sparkSession)
    host, path = url_parts(F.col(url_col))
    found = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    known = labels.where("id IS NOT NULL AND bad IS NOT NULL").groupBy("id").agg(F.max("bad").cast("long").alias("bad"))
    parts = _parts(F.col("path"))
    rows = stored(found.withColumn("parts", parts).join(known, "id", "left"), "urls")
    paths = rows.groupBy("host", "parts").agg(
        F.count(F.lit(1)).alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    tree = stored(path_templates(stored(paths, "paths"), limits), "templates")
    sums = F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")
    everything = tree.agg(*sums).first()  # two numbers
    all_rate = F.lit((everything["bad"] or 0) / max(1, everything["labelled"] or 0))
    smooth = lambda rate: (F.col("bad") + rate * limits.prior) / (F.col("labelled") + limits.prior)
    hosts = tree.groupBy("host").agg(*sums).select(F.col("host").alias("_h"), smooth(all_rate).alias("host_rate"))
    by_template = tree.groupBy("host", "template").agg(*sums).join(hosts, F.col("host") == F.col("_h"))
    rates = by_template.select(F.col("host").alias("_rh"), F.col("template").alias("_rt"), smooth(F.col("host_rate")).alias("bad_rate"))
    judged = tree.select("host", "parts", "template").join(
        rates, (F.col("host") == F.col("_rh")) & (F.col("template") == F.col("_rt"))
    ).select("host", "parts", "template", "bad_rate")
    joined = rows.select("id", "host", "path", "parts").join(judged, ["host", "parts"])
    ruled = joined.withColumn("_rule", longest_rule(F.col("host"), F.col("path"), rules))
    method = F.when(F.col("bad_rate") > limits.max_bad, F.lit("block")).otherwise(F.lit("allow"))
    return ruled.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", method).alias("verdict"),
        "template",
        "bad_rate",
    )

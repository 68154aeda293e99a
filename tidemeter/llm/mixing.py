"""Mixing of sources: token shares are raised to an exponent, and the weights realised as permuted blocks.

An exponent of 1 keeps the shares, 0 makes all sources equal, one over 1 favours large sources. The exponent is found by bisection, several points at a
time, each an aggregate over the sources. A source gets ``weight * budget`` tokens: whole passes over its documents, then
a part of one more. Each pass permutes the documents by a hash of its own: into blocks, and within blocks. A part
of a pass is the first blocks and the head of one more, so all that a document has to know of its source are the number
of whole passes, the number of the cut block and the hash at which it is cut. Texts are never shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemeter.llm.shared import prepared, stored

POINTS = 32
ROUNDS = 6
# The largest exponent tried for an entropy is a power of two: sources whose tokens differ by one differ enough at it.
DOUBLINGS = 64

# Blocks whose sums one task adds up.
RUN_BLOCKS = 4_096


@dataclass(frozen=True)
class MixTarget:
    """One of: the most passes over any source, or the entropy (in nats) of the weights. ``budget`` in tokens; null: as many
    as there are. ``block_tokens``: mean size of a block."""

    max_passes: float | None = 2.0
    entropy: float | None = None
    budget: int | None = None
    block_tokens: int = 1 << 16
    seed: int = 1


def word_tokens(text: Column) -> Column:
    """Words between white space, the default measure of tokens."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def find_exponent(totals: DataFrame, target: MixTarget) -> tuple[float, float, int, int, int]:
    """(exponent, sum of powers, all tokens, budget, unit). ``totals``: source, tokens; only positive ones count.

    With a limit of passes the smallest exponent in [0, 1] that keeps it (1 if none does: over 1 the passes of the largest
    source only rise); with an entropy the exponent from 0 whose weights have it, and a ValueError where none has. Powers are of
    tokens by ``unit``: all tokens, or for an entropy those of the largest source, so that none vanishes with all others.
    """
    row = totals.agg(
        F.sum("tokens").alias("all"), F.min("tokens").alias("least"), F.max("tokens").alias("most"), F.count(F.lit(1)).alias("sources")
    ).first()
    if row["all"] is None:
        return 1.0, 1.0, 0, target.budget or 0, 1
    everything, least = row["all"], row["least"] / row["all"]
    budget = target.budget or everything
    unit = everything if target.entropy is None else row["most"]
    share = F.col("tokens") / F.lit(float(unit))

    def enough(exponent: float, power: float, entropy: float) -> bool:
        """Whether the exponent is large enough."""
        if target.entropy is not None:
            return entropy <= target.entropy
        return budget / everything * least ** (exponent - 1) / power <= target.max_passes

    def measured(points: list[float]) -> tuple[list[float], list[bool]]:
        """Sums of powers at the points, and whether each is enough."""
        sums = [F.sum(F.pow(share, F.lit(a))) for a in points]
        logs = [F.sum(F.pow(share, F.lit(a)) * F.log(share)) for a in points]
        found = totals.agg(*sums, *logs).first()
        powers, weighted = found[: len(points)], found[len(points) :]
        return powers, [enough(a, z, math.log(z) - a * s / z) for a, z, s in zip(points, powers, weighted)]

    low, high = 0.0, 1.0
    if target.entropy is not None:
        if target.entropy > math.log(row["sources"]) + 1e-9:
            raise ValueError(f"entropy {target.entropy}: {row['sources']} sources reach {math.log(row['sources'])} at most")
        # The upper end doubles until its entropy is at most the target, which falls to that of the largest sources alone.
        doubled = [2.0**i for i in range(DOUBLINGS)]
        reached = [a for a, ok in zip(doubled, measured(doubled)[1]) if ok]
        if not reached:
            raise ValueError(f"entropy {target.entropy}: no exponent reaches it, since the largest sources are equal")
        high = reached[0]
        low = high / 2 if high > 1 else 0.0
    for turn in range(ROUNDS):
        points = [low + (high - low) * i / POINTS for i in range(0 if turn == 0 else 1, POINTS + 1)]
        powers, held = measured(points)
        first = next((i for i, ok in enumerate(held) if ok), len(points) - 1)
        high, power = points[first], powers[first]
        if first == 0 and turn == 0:
            break
        low = points[first - 1] if first else low
    return high, power, everything, budget, unit


def _tokens_before(sums: DataFrame) -> DataFrame:
    """Blocks with ``gone``, the tokens of their source's earlier blocks. No task holds all blocks of a source: they are
    summed up by runs of ``RUN_BLOCKS`` first, and only the sums of runs are added up source by source."""
    runs = sums.withColumn("_run", F.expr(f"block div {RUN_BLOCKS}"))
    totals = runs.groupBy(F.col("_source").alias("_s"), F.col("_run").alias("_r")).agg(F.sum("tokens").alias("_sum"))
    earlier = Window.unboundedPreceding, -1
    of_runs = Window.partitionBy("_s").orderBy("_r").rowsBetween(*earlier)
    shifts = totals.select("_s", "_r", F.coalesce(F.sum("_sum").over(of_runs), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_source", "_run").orderBy("block").rowsBetween(*earlier)
    within = runs.withColumn("_own", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    joined = within.join(shifts, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_run") == F.col("_r")))
    return joined.withColumn("gone", F.col("_shift") + F.col("_own")).select(*sums.columns, "gone")


def mix_sources(
    docs: DataFrame, target: MixTarget = MixTarget(), tokens: Column | None = None, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Input rows, repeated or left out, and mix_weight, mix_pass, mix_block, mix_tokens.

    A null source is one of its own. Documents without tokens have no share; they are kept once. Rows that are equal in
    id and text share their hash and so are cut together, by which the budget may be overrun. A very long text is one row of many tokens, in or out as a whole. Input
    columns with the names of the results are replaced. An empty input gives an empty result.
    """
    prepared(docs.sparkSession)
    plain = docs.drop("mix_weight", "mix_pass", "mix_block", "mix_tokens")
    measured = plain.withColumn("mix_tokens", word_tokens(F.col(text_col)) if tokens is None else tokens)
    key = F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    keyed = measured.withColumn("_key", F.xxhash64(F.lit(target.seed), F.col(id_col), key))
    light = stored(keyed.select(F.col(source_col).alias("source"), F.col("mix_tokens").alias("tokens"), F.col("_key").alias("key")), "weights")
    totals = light.where("tokens > 0").groupBy("source").agg(F.sum("tokens").alias("tokens"))
    totals = stored(totals, "totals")
    exponent, power, _, budget, unit = find_exponent(totals, target)
    weight = F.pow(F.col("tokens") / F.lit(float(unit)), F.lit(exponent)) / F.lit(power)
    quota = F.floor(weight * budget).cast("long")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("tokens") / target.block_tokens)).cast("long")
    plan = totals.select(
        F.col("source").alias("_source"), weight.alias("mix_weight"), blocks.alias("_blocks"),
        F.floor(quota / F.col("tokens")).cast("long").alias("_passes"), (quota % F.col("tokens")).alias("_rest"),
    )

    def order(key: Column, number: Column) -> Column:
        return F.xxhash64(key, number, F.lit("order"))

    def block(key: Column, number: Column) -> Column:
        return F.pmod(F.xxhash64(key, number, F.lit("block")), F.col("_blocks"))

    part = light.where("tokens > 0").join(plan, F.col("source").eqNullSafe(F.col("_source")))
    part = part.select("_source", "_rest", "tokens", block(F.col("key"), F.col("_passes")).alias("block"), order(F.col("key"), F.col("_passes")).alias("at"))
    sums = part.groupBy("_source", "_rest", "block").agg(F.sum("tokens").alias("tokens"))
    passed = _tokens_before(sums)
    cut = passed.where((F.col("gone") <= F.col("_rest")) & (F.col("gone") + F.col("tokens") > F.col("_rest")))
    cut = stored(cut.select(F.col("_source").alias("_s"), F.col("block").alias("_cut"), (F.col("_rest") - F.col("gone")).alias("_left")), "cuts")
    # The cut block of each source alone is ordered; its mean size is block_tokens.
    inner = part.join(cut, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_cut")))
    inside = Window.partitionBy("_source").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    fits = inner.withColumn("sum", F.sum("tokens").over(inside)).where("sum <= _left")
    heads = fits.groupBy("_source").agg(F.max("at").alias("_at")).withColumnRenamed("_source", "_h")
    known = plan.join(cut, F.col("_source").eqNullSafe(F.col("_s")), "left").join(heads, F.col("_source").eqNullSafe(F.col("_h")), "left")
    known = stored(known.select("_source", "mix_weight", "_blocks", "_passes", "_cut", "_at"), "plan")

    joined = keyed.join(known, F.col(source_col).eqNullSafe(F.col("_source")), "left")
    last = F.col("_passes")
    own = block(F.col("_key"), last)
    more = (own < F.col("_cut")) | (own == F.col("_cut")) & (order(F.col("_key"), last) <= F.col("_at"))
    times = F.when(F.col("mix_tokens") > 0, last + F.coalesce(more, F.lit(False)).cast("long")).otherwise(F.lit(1))
    numbers = F.filter(F.sequence(F.lit(0).cast("long"), times), lambda i: i < times)
    spread = joined.withColumn("mix_pass", F.explode(numbers))
    return spread.withColumn("mix_block", block(F.col("_key"), F.col("mix_pass"))).select(
        *plain.columns, F.coalesce("mix_weight", F.lit(0.0)).alias("mix_weight"), "mix_pass", "mix_block", "mix_tokens"
    )

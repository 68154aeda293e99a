"""Quality rules with host verdicts, in DataFrame functions only.

Each document is measured on its own; then the failures are counted by host, each host's failure rate is shrunk
towards the corpus with a beta prior fitted to all hosts, and hosts whose shrunk rate is too high lose the
documents that fail a softer second set of rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.llm.shared import prepared, stored

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
RUN = 8


@dataclass(frozen=True)
class QualityLimits:
    """The first two are rules on documents; the rest decide on hosts.

    A host is bad if its shrunk failure rate is over ``host_rate``. In a bad host, documents with a share of
    symbols or repeated lines over the ``suspect`` limits go too; clean ones stay.
    """

    min_words: int = 20
    max_repeat_percent: int = 30
    host_rate: float = 0.5
    suspect_symbol_percent: int = 5
    suspect_lines_percent: int = 20


def _with(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: a lambda's argument is not inlined."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeated(words: Column) -> Column:
    """Words that lie in a run of eight words which occurs twice or more in the text."""

    def runs(hashes: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(hashes) - RUN)
        return F.transform(at, lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(RUN))))

    def covered(places: Column) -> Column:
        """Words in the union of [place, place + 8), places ascending."""
        after = F.transform(places, lambda p, i: F.coalesce(F.get(places, i + 1), p + RUN) - p)
        return F.aggregate(after, F.lit(0), lambda total, gap: total + F.least(gap, F.lit(RUN)))

    def of_runs(found: Column) -> Column:
        pairs = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeats(order: Column) -> Column:
            hash_at = lambda i: F.get(order, i)["h"]
            twice = F.filter(
                order, lambda x, i: F.coalesce(hash_at(i - 1) == x["h"], F.lit(False)) | F.coalesce(hash_at(i + 1) == x["h"], F.lit(False))
            )
            return _with(F.array_sort(F.transform(twice, lambda x: x["i"])), covered)

        distinct = F.size(F.array_distinct(found)) == F.size(found)
        return F.when(distinct, F.lit(0)).otherwise(_with(pairs, repeats))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    long_enough = F.size(words) > RUN
    return F.when(long_enough, _with(hashes, lambda h: _with(runs(h), of_runs))).otherwise(F.lit(0))


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) to every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.regexp_replace(text, f"{SPACE}+", "")

    def lines(found: Column) -> Column:
        return F.size(found) - F.size(F.array_distinct(found))

    duplicates = _with(F.filter(F.split(text, "\n"), lambda line: line.rlike(f"{SPACE[:1]}^{SPACE[1:]}")), lines)

    def counted(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"), _repeated(words).cast("long").alias("n_repeat_words"))

    words = F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")
    found = docs.withColumn("_counted", _with(words, counted))
    return found.withColumns(
        {
            "n_words": F.col("_counted.n_words"),
            "word_chars": F.length(bare).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": duplicates.cast("long"),
            "n_repeat_words": F.col("_counted.n_repeat_words"),
        }
    ).drop("_counted")


def host_rates(judged: DataFrame, host: Column) -> DataFrame:
    """Rows: host, n, failed, rate. The rate is the mean of a beta posterior whose prior has the corpus rate as mean
    and the strength that the spread between hosts gives (method of moments)."""
    hosts = judged.groupBy(host.alias("host")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")
    )
    share = F.col("failed") / F.col("n")
    totals = hosts.agg(
        F.sum("failed").alias("f"), F.sum("n").alias("m"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * share * share).alias("square"), F.sum(F.col("n") * F.col("n")).alias("nn"),
    )
    mean = F.col("f") / F.col("m")
    # Between-host variance: what the squared deviations show beyond sampling noise.
    spread = F.col("square") - F.col("m") * mean * mean
    noise = (F.col("k") - 1) * mean * (1 - mean)
    effective = F.col("m") - F.col("nn") / F.col("m")
    between = F.when(effective > 0, F.greatest((spread - noise) / effective, F.lit(0.0)))
    strength = F.least(F.coalesce(F.try_divide(mean * (1 - mean), between), F.lit(1e6)) - 1, F.lit(1e6))
    row = totals.select(mean.alias("mean"), F.greatest(strength, F.lit(1.0)).alias("strength")).first()
    mean, strength = (F.lit(float(x or 0)) for x in row)  # two numbers, whatever the number of hosts
    rate = (F.col("failed") + mean * strength) / (F.col("n") + strength)
    return hosts.select("host", "n", "failed", rate.alias("rate"))


def quality_rules(
    docs: DataFrame,
    host: Column | None = None,
    limits: QualityLimits = QualityLimits(),
    text_col: str = "text",
    keep_text: bool = True,
) -> DataFrame:
    """Input rows with measures, base_failed, host_rate, kept; without the text if ``keep_text`` is false, in which
    case texts are read once, else twice.

    A document fails by itself with too few words or too many repeated ones. Null and empty texts have no words and
    fail. Rows that repeat an id are judged one by one; hosts that are null form one group. Input columns with the
    names of the results are replaced; an empty input gives an empty result. ``host`` defaults to ``source``.
    """
    prepared(docs.sparkSession)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    marked = docs.withColumn("_host", F.col("source") if host is None else host)
    measured = measures(marked.drop(*(set(names) - {text_col}), "base_failed", "host_rate", "kept"), text_col)
    n, repeats = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < limits.min_words) | (100 * repeats > limits.max_repeat_percent * n)
    judged = measured.withColumn("base_failed", failed)
    judged = judged.withColumn("_lines", F.size(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")))
    if not keep_text:
        judged = stored(judged.drop(text_col), "measures")
    light = stored(judged.select("_host", "base_failed"), "failures") if keep_text else judged
    bad = host_rates(light, F.col("_host")).select(F.col("host").alias("_bad"), F.col("rate").alias("host_rate"))
    joined = judged.join(bad, F.col("_host").eqNullSafe(F.col("_bad")), "left")
    suspect = (100 * F.col("n_symbols") > limits.suspect_symbol_percent * F.col("word_chars")) | (
        100 * F.col("n_dup_lines") > limits.suspect_lines_percent * F.col("_lines")
    )
    rejected = F.col("base_failed") | (F.col("host_rate") > limits.host_rate) & suspect
    return joined.withColumn("kept", ~rejected).drop("_host", "_bad", "_lines")

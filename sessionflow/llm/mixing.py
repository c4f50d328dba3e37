"""Mix sources to target weights: nested budget thresholds from hash-bucket histograms.

Every document has a fixed 60-bit hash of its id, and a source takes the documents whose hash lies below
a threshold. The threshold is found from sums of sizes by source and hash bucket: the buckets that fit
in the budget are taken whole, and only the bucket at the boundary is split again, so that nothing is
ever sorted. A larger budget takes all that a smaller one takes.

Defined results: a null text has size 0 and takes part; a null source is a source of its own, the last
one; documents of equal id (repeated rows) share a hash and are taken together or not at all; an empty
table gives an empty result; other columns pass through, but one with the name of an added column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionflow.workdir import write_table

_ADDED = ["mix_size", "mix_source_size", "mix_target", "mix_copies"]
HASH_BITS, LEVEL_BITS = 60, 15
#: A table of so many rows at most is sent to all tasks; beyond that it is joined by a shuffle.
SMALL_ROWS = 10_000


def words_in(text: str) -> Column:
    """Number of words, which only ASCII white space separates; 0 for a null text."""
    found = F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(found, F.lit(0)).cast("bigint")


def id_hash(id_col: str) -> Column:
    """The first 60 bits of the MD5 of an id as text."""
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...], share: float, max_repeats: int
) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    Sources in code-point order, null last, get the weights in turn. Their targets share ``share`` times
    all sizes by weight; a target stops at ``max_repeats`` times its source's size and the excess goes to
    the others by weight, until none is above. That is one common level per unit of weight, found from
    running sums over the sources in the order in which they reach their stop.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighted = totals.withColumn("weight", cycle[turn])
    stop = F.lit(max_repeats) * F.col("source_size")
    by_stop = Window.orderBy(F.expr(f"{max_repeats} * source_size / weight"), F.col("source").asc_nulls_last())
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = (
        weighted.withColumn("stopped", F.coalesce(F.sum(stop).over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("level", (F.col("budget") - F.col("stopped")) / F.col("open"))
        .withColumn("fits", F.col("level") * F.col("weight") <= stop)
    )
    # the first source that does not reach its stop fixes the level of all that follow
    level = F.min(F.when(F.col("fits"), F.struct("stopped", "level"))).over(everything)["level"]
    target = F.coalesce(F.least(stop.cast("double"), level * F.col("weight")), stop.cast("double"))
    return levels.select("source", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame, max_repeats: int, hint=lambda df: df) -> DataFrame:
    """``source, source_size, target, whole, below`` for rows of ``source, size, hash``.

    A source takes all its documents ``whole`` times, and those with a hash less than ``below`` once more.
    ``hint`` marks the table of sources for the joins.
    """
    whole = F.when(
        F.col("source_size") > 0, F.least(F.lit(max_repeats), F.floor(F.col("target") / F.col("source_size")))
    ).otherwise(0)
    goals = targets.withColumn("whole", whole.cast("int"))
    boundary = goals.select(
        F.col("source").alias("s"),
        (F.floor("target") - F.col("whole") * F.col("source_size")).alias("left"),
        F.lit(0).cast("bigint").alias("at"),
    )
    for level in range(HASH_BITS // LEVEL_BITS):
        boundary = _split_boundary(sizes, hint(boundary), level)
    found = boundary.select("s", F.col("at").alias("below"))
    joined = goals.join(hint(found), goals["source"].eqNullSafe(F.col("s")), "left")
    # without a boundary bucket all documents fit
    return joined.select("source", "source_size", "target", "whole", F.coalesce("below", F.lit(1 << HASH_BITS)).alias("below"))


def _split_boundary(sizes: DataFrame, boundary: DataFrame, level: int) -> DataFrame:
    """Within the boundary bucket of each source, the bucket of ``LEVEL_BITS`` more bits at the boundary."""
    rest = HASH_BITS - LEVEL_BITS * (level + 1)
    inside = sizes.join(
        boundary,
        sizes["source"].eqNullSafe(F.col("s")) & (F.shiftright("hash", rest + LEVEL_BITS) == F.col("at")),
    )
    sums = inside.groupBy("s", "left", F.shiftright("hash", rest).alias("part")).agg(F.sum("size").alias("size"))
    until = F.sum("size").over(Window.partitionBy("s").orderBy("part"))
    over = sums.withColumn("until", until).where(F.col("until") > F.col("left"))
    first = F.min(F.struct("part", (F.col("left") - F.col("until") + F.col("size")).alias("left")))
    return over.groupBy("s").agg(first.alias("b")).select("s", F.col("b.left").alias("left"), F.col("b.part").alias("at"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    max_repeats: int = 2,
) -> DataFrame:
    """The documents with what the mix takes of them.

    Added columns: ``mix_size`` (words), ``mix_source_size``, ``mix_target``, ``mix_copies`` (how often
    the document is taken, 0 to ``max_repeats``).
    """
    docs = docs.drop(*_ADDED)
    sized = docs.select(F.col(source_col).alias("source"), words_in(text_col).alias("size"), id_hash(id_col).alias("hash"))
    sizes = write_table(sized, "mix-sizes")
    targets = write_table(source_targets(sizes, weights, share, max_repeats), "mix-targets")
    few = targets.count() <= SMALL_ROWS
    hint = F.broadcast if few else (lambda df: df)
    cuts = write_table(thresholds(sizes, targets, max_repeats, hint), "mix-thresholds")
    # one name beside those of the documents
    cut = F.struct("source", "source_size", "target", "whole", "below").alias("mix_target")
    joined = docs.join(hint(cuts.select(cut)), docs[source_col].eqNullSafe(F.col("mix_target.source")), "left")
    again = (id_hash(id_col) < F.col("mix_target.below")) & (F.col("mix_target.whole") < max_repeats)
    return joined.select(
        *[f"`{c}`" for c in docs.columns],
        words_in(text_col).alias("mix_size"),
        F.col("mix_target.source_size").alias("mix_source_size"),
        F.col("mix_target.target").alias("mix_target"),
        (F.col("mix_target.whole") + again.cast("int")).alias("mix_copies"),
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """One row for each copy that the mix takes, with the columns of the documents."""
    copies = F.explode(F.array_repeat(F.lit(1), F.col("mix_copies")))
    return mixed.where("mix_copies > 0").withColumn("mix_copies", copies).drop(*_ADDED)

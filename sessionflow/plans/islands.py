"""Islands of activity: the batch core of trips, trip status and station outages.

An island is a maximal run of rows of one key in which no two neighbours lie more than
``gap_ms`` apart. The textbook plan (lag, flag, running sum, all partitioned by the key) puts
every row of a key into one task. One vehicle that sends a third of all rows would then decide
how long the job runs. Three reductions avoid that; none of them ever holds more than a bounded
number of rows for one group:

1. *Cells.* Rows of a key within ``gap_ms + 1`` ms are certainly in one island. A plain
   aggregate on (key, cell) with map-side partials shrinks them to one row.
2. *Blocks.* Windows over (key, block of ``CELLS_PER_BLOCK`` cells) join neighbouring cells to
   local islands: at most ``CELLS_PER_BLOCK`` rows in a group.
3. *Stitching.* Only the first and the last local island of a block can continue elsewhere.
   Those edges meet in one group per key (two rows per block); every other island keeps its
   block in the partitioning, so it stays spread out, and passes through the same windows
   unchanged. One linear plan, nothing is computed twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import Window

from sessionflow.functions.timeconv import floor_div

CELLS_PER_BLOCK = 1024


def key_list(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def islands(
    df: DataFrame,
    key: str | Sequence[str],
    t_ms: Column,
    gap_ms: int,
    measure: str | None = None,
    tiebreak: str | None = None,
) -> DataFrame:
    """One row per island.

    Columns: the keys, ``start_ms``, ``end_ms``, ``n`` (rows), ``prev_end_ms`` (end of the island
    before, null for the first of a key), ``is_last`` and, with ``measure``, its ``first_value``
    and ``last_value`` in (time, ``tiebreak``) order. Without ``tiebreak`` rows at the very same
    time are ordered by their measure. Rows without time or measure are left out.
    """
    keys = key_list(key)
    wide = measure is not None
    rows = df.select(
        *keys,
        t_ms.cast("bigint").alias("_t"),
        *([F.col(measure).alias("_m"), F.col(tiebreak or measure).alias("_o")] if wide else []),
    ).where(F.col("_t").isNotNull())
    if wide:
        rows = rows.where(F.col("_m").isNotNull())

    # 1. cells
    order = _ordered(rows) if wide else None
    rows = rows.withColumn("_cell", floor_div(F.col("_t"), gap_ms + 1)).withColumn(
        "_block", floor_div(F.col("_cell"), CELLS_PER_BLOCK)
    )
    cells = rows.groupBy(*keys, "_block", "_cell").agg(
        F.min("_t").alias("_s"),
        F.max("_t").alias("_e"),
        F.count(F.lit(1)).alias("_n"),
        *([F.min_by("_m", order).alias("_m0"), F.max_by("_m", order).alias("_m1")] if wide else []),
    )

    # 2. local islands of a block
    local = _chained(cells, [*keys, "_block"], "_cell", gap_ms, F.lit(None).cast("bigint"), wide)
    spread = F.when(~(F.col("_first") | F.col("_last")), F.col("_block"))
    local = local.withColumn("_spread", spread).withColumnRenamed("_prev", "_known")

    # 3. stitched islands of a key
    whole = _chained(local, [*keys, "_spread"], "_s", gap_ms, F.col("_known"), wide)
    return whole.select(
        *keys,
        F.col("_s").alias("start_ms"),
        F.col("_e").alias("end_ms"),
        F.col("_n").alias("n"),
        F.col("_prev").alias("prev_end_ms"),
        (F.col("_spread").isNull() & F.col("_last")).alias("is_last"),
        *([F.col("_m0").alias("first_value"), F.col("_m1").alias("last_value")] if wide else []),
    )


def _ordered(rows: DataFrame) -> Column:
    """Time and tiebreak as one value, so that first and last values need no sort.

    Aggregates over a struct sort all rows; over a number of fixed width they hash. Two integers fit
    into one decimal; a tiebreak of another type stays in a struct.
    """
    if not isinstance(rows.schema["_o"].dataType, IntegralType):
        return F.struct("_t", "_o")
    high = F.col("_t").cast("decimal(19,0)") * F.lit(Decimal(1 << 64))
    # a missing tiebreak stands before all others, as it does in a struct
    low = F.coalesce(F.col("_o").cast("decimal(20,0)"), F.lit(Decimal(-1 << 63) - 1))
    return (high.cast("decimal(38,0)") + low).cast("decimal(38,0)")


def _chained(
    parts: DataFrame, group: list[str], by: str, gap_ms: int, known: Column, wide: bool
) -> DataFrame:
    """Join parts of a group whose distance is at most ``gap_ms``.

    ``known`` is the end of the part before, for parts whose predecessor is settled: they open a
    run of their own, whatever stands before them in this group. ``_first`` and ``_last`` tell
    whether a run has the first or the last part of its group.
    """
    w = Window.partitionBy(*group).orderBy(by)
    before = F.coalesce(known, F.col("_seen"))
    opens = before.isNull() | known.isNotNull() | (F.col("_s") - before > gap_ms)
    flagged = (
        parts.withColumns({"_seen": F.lag("_e").over(w), "_next": F.lead("_s").over(w)})
        .withColumn("_before", before)
        .withColumn("_run", F.sum(opens.cast("bigint")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    )
    return flagged.groupBy(*group, "_run").agg(
        F.min("_s").alias("_s"),
        F.max("_e").alias("_e"),
        F.sum("_n").alias("_n"),
        F.min_by("_before", "_s").alias("_prev"),
        F.bool_or(F.col("_seen").isNull()).alias("_first"),
        F.bool_or(F.col("_next").isNull()).alias("_last"),
        *([F.min_by("_m0", "_s").alias("_m0"), F.max_by("_m1", "_e").alias("_m1")] if wide else []),
    )

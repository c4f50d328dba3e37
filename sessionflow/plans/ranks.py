"""Values by their rank, without sorting or gathering a column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits by which a pass narrows the values, and so the power of two of the counts that reach the driver.
BITS = 12


def lower_median(df: DataFrame, column: str) -> int | None:
    """The middle value of a column of integers, of two the lower one; nulls do not count.

    Each pass counts the values that are left by ranges of equal width and goes on with the range that has the middle, so
    that tasks and driver hold some thousand counts, whatever the number of rows. ``F.median`` keeps every distinct value in one task.
    """
    left = df.select(F.col(column).cast("bigint").alias("v")).where("v is not null")
    n, low, high = left.agg(F.count("v"), F.min("v"), F.max("v")).first()
    rank = (n - 1) // 2
    while n and low < high:
        shift = max((high - low).bit_length() - BITS, 0)
        counts = left.where(F.col("v").between(low, high)).groupBy(F.shiftright("v", shift).alias("range")).count()
        for place, count in sorted(counts.collect()):
            if rank < count:
                break
            rank -= count
        low, high = max(low, place << shift), min(high, ((place + 1) << shift) - 1)
    return low

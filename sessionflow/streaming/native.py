"""Streaming forms that need no Python state: Spark's own session windows and aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.defaults import TRIP_GAP_MS, WATERMARK
from sessionflow.functions.timeconv import from_epoch_ms, time_ms
from sessionflow.operators.trips import trip_columns
from sessionflow.plans.islands import key_list


def trips(
    df: DataFrame,
    key: str | Sequence[str] = "vin",
    ts: str = "createTime",
    measure: str = "mileage",
    tiebreak: str | None = None,
    gap_ms: int = TRIP_GAP_MS,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Trips by ``session_window``, for append (a trip comes once, when the watermark has passed
    it) or complete mode.

    Unlike the keyed-state form the result does not depend on micro-batches, and late rows within
    the watermark can still extend or join trips. Started by ``runner.start``, each task joins its
    windows before the shuffle.
    """
    keys = key_list(key)
    # Gaps are compared in milliseconds, so the window gets times without a finer part.
    rows = df.select(
        *keys,
        from_epoch_ms(time_ms(df, ts)).alias("_at"),
        F.col(measure).alias("_m"),
        F.col(tiebreak or measure).alias("_o"),
    ).where(F.col("_at").isNotNull() & F.col("_m").isNotNull())
    order = F.struct("_at", "_o")
    found = (
        rows.withWatermark("_at", watermark)
        .groupBy(*keys, F.session_window("_at", f"{gap_ms} milliseconds"))
        .agg(
            F.unix_millis(F.min("_at")).alias("start_ms"),
            F.unix_millis(F.max("_at")).alias("end_ms"),
            F.min_by("_m", order).alias("first_value"),
            F.max_by("_m", order).alias("last_value"),
        )
    )
    return found.select(*keys, *trip_columns(F.lit(True)))


def pv_counts(df: DataFrame, keys: Sequence[str] = ("userId", "eventType")) -> DataFrame:
    """Running count per key that never expires; for update or complete mode."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("eventCount"))

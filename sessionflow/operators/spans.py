"""Activity span of each user over a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.defaults import SPAN_TIMEOUT_MS, SPAN_WATERMARK_MS
from sessionflow.functions.timeconv import time_ms


def activity_span(df: DataFrame, key: str = "user_id", ts: str = "event_time") -> DataFrame:
    """First and last time of each key, whatever the pauses between."""
    spans = (
        df.select(key, time_ms(df, ts).alias("_t"))
        .where(F.col("_t").isNotNull())
        .groupBy(key)
        .agg(F.min("_t").alias("startTimestampMs"), F.max("_t").alias("endTimestampMs"))
    )
    return spans.select(
        key,
        "startTimestampMs",
        "endTimestampMs",
        (F.col("endTimestampMs") - F.col("startTimestampMs")).alias("durationMs"),
        F.lit(False).alias("expired"),
    )


def activity_span_expiring(
    df: DataFrame,
    key: str = "user_id",
    ts: str = "event_time",
    timeout_ms: int = SPAN_TIMEOUT_MS,
    delay_ms: int = SPAN_WATERMARK_MS,
) -> DataFrame:
    """The spans, and once more with ``expired`` those that a stream would have closed by now.

    A span expires when the latest time of all, less the allowed delay, has passed its end by
    more than the timeout.
    """
    spans = activity_span(df, key, ts)
    newest = spans.agg(F.max("endTimestampMs")).scalar()
    over = F.col("endTimestampMs") + timeout_ms < newest - delay_ms
    states = F.when(over, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return spans.withColumn("expired", F.explode(states))

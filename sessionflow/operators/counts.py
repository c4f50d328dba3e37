"""Event counts per user and event type over a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pv_counts(df: DataFrame, keys: Sequence[str] = ("userId", "eventType")) -> DataFrame:
    """Rows per key. Rows without a readable time count too."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("eventCount"))

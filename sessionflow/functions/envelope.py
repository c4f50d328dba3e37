"""Rows as keyed JSON messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def envelope(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``key`` and, as ``value``, a JSON object of ``columns`` (all by default)."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*(columns or df.columns))).alias("value"),
    )

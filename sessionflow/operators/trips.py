"""Trips of vehicles over a table: completed trips, and the status of the running one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionflow.defaults import TRIP_GAP_MS
from sessionflow.functions.timeconv import time_ms
from sessionflow.plans.islands import islands, key_list


def trips(
    df: DataFrame,
    key: str | Sequence[str] = "vin",
    ts: str = "createTime",
    measure: str = "mileage",
    tiebreak: str | None = None,
    gap_ms: int = TRIP_GAP_MS,
) -> DataFrame:
    """Every trip of every key. A table has an end, so the last trip counts as ended."""
    found = islands(df, key, time_ms(df, ts), gap_ms, measure, tiebreak)
    return found.select(*key_list(key), *trip_columns(F.lit(True)))


def trip_status(
    df: DataFrame,
    key: str | Sequence[str] = "vin",
    ts: str = "createTime",
    measure: str = "mileage",
    tiebreak: str | None = None,
    gap_ms: int = TRIP_GAP_MS,
) -> DataFrame:
    """Trips ended by a later one, and the still running trip of each key.

    A key whose very last row opened a new trip has no progress to report on it yet.
    """
    found = islands(df, key, time_ms(df, ts), gap_ms, measure, tiebreak)
    return found.where(~just_opened()).select(*key_list(key), *trip_columns(~F.col("is_last")))


def just_opened() -> Column:
    return F.col("is_last") & F.col("prev_end_ms").isNotNull() & (F.col("n") == 1)


def trip_columns(ended: Column) -> list[Column]:
    length = F.col("end_ms") - F.col("start_ms")
    return [
        F.col("start_ms").alias("tripStartTime"),
        F.col("end_ms").alias("tripEndTime"),
        F.col("first_value").alias("startMileage"),
        F.col("last_value").alias("endMileage"),
        F.call_function("div", length, F.lit(1000).cast("bigint")).alias("tripDuration"),
        (F.col("last_value") - F.col("first_value")).alias("tripDistance"),
        ended.alias("isTripEnded"),
    ]

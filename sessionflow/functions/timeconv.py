"""Time conversions. Everything downstream of these works on epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionflow.defaults import WALL_CLOCK_FORMAT, WALL_CLOCK_ZONE

# Timestamps are 64-bit microseconds.
MAX_EPOCH_MS = (2**63 - 1) // 1000


def epoch_ms(ts: Column | str) -> Column:
    """Timestamp to epoch milliseconds, rounding down."""
    return F.unix_millis(F.col(ts) if isinstance(ts, str) else ts)


def time_ms(df: DataFrame, ts: str) -> Column:
    """Column ``ts`` of ``df`` as epoch milliseconds, whichever time type it has.

    A timestamp without zone is read in the zone of the session; integers are milliseconds already.
    """
    kind = df.schema[ts].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(ts).cast("bigint")
    return F.unix_millis(F.col(ts).cast("timestamp"))


def from_epoch_ms(ms: Column | str) -> Column:
    """Epoch milliseconds to timestamp; null beyond what a timestamp can hold."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.timestamp_millis(F.when(ms.between(-MAX_EPOCH_MS, MAX_EPOCH_MS), ms))


def from_wall_clock(
    text: Column | str, fmt: str = WALL_CLOCK_FORMAT, zone: str = WALL_CLOCK_ZONE
) -> Column:
    """Local date and time written in ``zone`` to an instant; null for null or bad text.

    The text is first read as if it were UTC, with an explicit offset, so the result does
    not depend on the zone of the session.
    """
    text = F.col(text) if isinstance(text, str) else text
    as_utc = F.try_to_timestamp(F.concat(text, F.lit("+0000")), F.lit(fmt + "xx"))
    return F.to_utc_timestamp(as_utc, zone)


def from_iso(text: Column | str) -> Column:
    """ISO text in the zone of the session to timestamp; null for bad text."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def floor_div(value: Column, width: int) -> Column:
    """Exact integer division rounding down, for negative values too."""
    w = F.lit(width).cast("bigint")
    return F.call_function("div", value - F.pmod(value, w), w)

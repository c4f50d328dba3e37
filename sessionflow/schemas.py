"""Declared column types of every record the package reads or writes.

Nothing is inferred: sources are parsed against these structs, and the stateful
operators announce their output and state with them.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


_S, _L, _B, _I, _TS = (
    T.StringType(),
    T.LongType(),
    T.BooleanType(),
    T.IntegerType(),
    T.TimestampType(),
)

LINES = _struct(value=_S)

# Typed inputs, as the parsers of `functions.parsing` return them.
VEHICLE = _struct(vin=_S, createTime=_TS, mileage=_L)
USER_EVENT = _struct(eventTime=_TS, eventType=_S, userId=_S)
STATION = _struct(stationId=_S, dataTime=_TS)
SESSION_EVENT = _struct(id=_I, greet=_S, isLast=_B)
LOGIN = _struct(event_time=_TS, user_id=_S)

# Operator outputs without their key columns, which the caller names.
TRIP = _struct(
    tripStartTime=_L,
    tripEndTime=_L,
    startMileage=_L,
    endMileage=_L,
    tripDuration=_L,
    tripDistance=_L,
    isTripEnded=_B,
)
STATION_EVENT = _struct(startTime=_L, endTime=_L, status=_B)
EVENT_COUNT = _struct(eventCount=_L)
SPAN = _struct(startTimestampMs=_L, endTimestampMs=_L, durationMs=_L, expired=_B)
ENVELOPE = _struct(key=_S, value=_S)

# Keyed state of the streaming operators.
TRIP_STATE = _struct(start_ms=_L, end_ms=_L, start_mileage=_L, end_mileage=_L)
SPAN_STATE = _struct(start_ms=_L, end_ms=_L)
COUNT_STATE = _struct(n=_L)


def with_keys(df_schema: T.StructType, keys: list[str], rest: T.StructType) -> T.StructType:
    """``rest`` preceded by the key columns, typed as the input types them."""
    return T.StructType([df_schema[k] for k in keys] + list(rest.fields))

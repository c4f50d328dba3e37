"""Lines of JSON to typed columns.

Every adapter reads its fields as text with ``from_json`` and casts afterwards with ``try_cast``,
so a quoted number is as good as a bare one and one bad field does not empty the whole record.
Single-quoted JSON is accepted, as the feeds write it. Each adapter returns *all* lines, valid or
not, with the typed columns, the original ``value`` and a boolean ``is_valid``; ``valid`` and
``quarantine`` split the result. All of it runs inside the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionflow import schemas
from sessionflow.defaults import WALL_CLOCK_FORMAT, WALL_CLOCK_ZONE
from sessionflow.functions.timeconv import from_epoch_ms, from_iso, from_wall_clock


def read_json(lines: DataFrame, schema: T.StructType | str, value: str = "value") -> DataFrame:
    """Parse a text column against a declared schema and expand the fields to columns."""
    return lines.select(F.from_json(F.col(value), schema).alias("json")).select("json.*")


def non_empty(column: str) -> Column:
    """True for present, non-empty text; never null."""
    return F.coalesce(F.length(F.col(column)) > 0, F.lit(False))


def _adapt(
    lines: DataFrame,
    fields: list[str],
    typed: T.StructType,
    columns: Callable[[Callable[[str], Column]], list[Column]],
    is_valid: Column,
) -> DataFrame:
    text = ", ".join(f"`{f}` STRING" for f in fields)
    # The generator parses a line once. As a plain column the parse would be copied into every
    # condition that is pushed down to the scan.
    raw = lines.select("value", F.inline(F.array(F.from_json("value", text))))
    shaped = raw.select("value", *columns(F.col))
    return shaped.select(
        "value",
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in typed],
        is_valid.alias("is_valid"),
    )


def parse_vehicle(lines: DataFrame) -> DataFrame:
    """Vehicle signals: ``vin``, ``createTime`` (epoch ms in the line), ``mileage``."""
    return _adapt(
        lines,
        ["vin", "createTime", "mileage"],
        schemas.VEHICLE,
        lambda f: [
            f("vin").alias("vin"),
            from_epoch_ms(f("createTime").try_cast("bigint")).alias("createTime"),
            f("mileage").try_cast("bigint").alias("mileage"),
        ],
        non_empty("vin") & F.col("createTime").isNotNull() & F.col("mileage").isNotNull(),
    )


def parse_user_event(
    lines: DataFrame, fmt: str = WALL_CLOCK_FORMAT, zone: str = WALL_CLOCK_ZONE
) -> DataFrame:
    """User events: ``eventTime`` (wall clock), ``eventType``, ``userId``.

    A bad or missing time leaves the time null and the row valid: counts include it.
    """
    return _adapt(
        lines,
        ["eventTime", "eventType", "userId"],
        schemas.USER_EVENT,
        lambda f: [
            from_wall_clock(f("eventTime"), fmt, zone).alias("eventTime"),
            f("eventType").alias("eventType"),
            f("userId").alias("userId"),
        ],
        non_empty("userId"),
    )


def parse_station(
    lines: DataFrame, fmt: str = WALL_CLOCK_FORMAT, zone: str = WALL_CLOCK_ZONE
) -> DataFrame:
    """Station signals: ``station_id`` and ``data_time`` (wall clock)."""
    return _adapt(
        lines,
        ["station_id", "data_time"],
        schemas.STATION,
        lambda f: [
            f("station_id").alias("stationId"),
            from_wall_clock(f("data_time"), fmt, zone).alias("dataTime"),
        ],
        non_empty("stationId") & F.col("dataTime").isNotNull(),
    )


def parse_session_event(lines: DataFrame, order: str | None = None) -> DataFrame:
    """Session events: ``id`` (0 where the line has none), ``greet``, ``isLast``.

    With ``order``, the integer of that name in the line is kept as ``seq``, for the table form of
    the session operator, which needs to know the order of events.
    """
    typed = T.StructType(schemas.SESSION_EVENT.fields + [T.StructField("seq", T.LongType())])
    extra = [order] if order else []
    parsed = _adapt(
        lines,
        ["id", "greet", "isLast", *extra],
        typed if order else schemas.SESSION_EVENT,
        lambda f: [
            F.when(f("id").isNull(), F.lit(0)).otherwise(f("id").try_cast("int")).alias("id"),
            f("greet").alias("greet"),
            f("isLast").try_cast("boolean").alias("isLast"),
            *[f(o).try_cast("bigint").alias("seq") for o in extra],
        ],
        F.col("id").isNotNull() & F.col("isLast").isNotNull(),
    )
    return parsed


def parse_login(lines: DataFrame) -> DataFrame:
    """Logins: ``event_time`` (ISO text in the zone of the session), ``user_id``."""
    return _adapt(
        lines,
        ["event_time", "user_id"],
        schemas.LOGIN,
        lambda f: [from_iso(f("event_time")).alias("event_time"), f("user_id").alias("user_id")],
        non_empty("user_id") & F.col("event_time").isNotNull(),
    )


def valid(parsed: DataFrame) -> DataFrame:
    """The typed columns of the good lines."""
    return parsed.where("is_valid").drop("value", "is_valid")


def quarantine(parsed: DataFrame) -> DataFrame:
    """The bad lines as they came."""
    return parsed.where(~F.col("is_valid")).select("value")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bind a DataFrame to a declared schema: its columns, in its order, with its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])

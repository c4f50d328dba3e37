"""Sessions that end with a closing event, over a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionflow.functions.timeconv import floor_div
from sessionflow.plans.islands import key_list

ORDERS_PER_BLOCK = 1_000_000


def closed_session_events(
    df: DataFrame,
    key: str | Sequence[str],
    order: str,
    is_last: Column | str,
    orders_per_block: int = ORDERS_PER_BLOCK,
) -> DataFrame:
    """The events of closed sessions, with ``sessionNo`` counting the sessions of a key from 0.

    A session reaches up to and including its closing event; events after the last closing event
    of a key belong to no closed session. ``order`` is an integer, unique within a key: the order
    of events is defined by it, and it bounds the work. A key is cut into blocks of
    ``orders_per_block`` values, hence at most that many rows. Closings are first counted per
    block, with map-side partials, and summed over the blocks of a key; then each block numbers
    its own rows. No task ever holds all rows of a key, and open ends leave before any list is
    made. Rows without an order are refused; a null key is a key of its own.
    """
    keys = key_list(key)
    closes = F.coalesce(F.col(is_last) if isinstance(is_last, str) else is_last, F.lit(False))
    number = F.coalesce(F.col(order).cast("bigint"), F.raise_error(F.lit(f"an event has no {order}")).cast("bigint"))
    rows = df.withColumn("_closes", closes.cast("bigint")).withColumn(
        "_block", floor_div(number, orders_per_block)
    )

    per_key = Window.partitionBy(*keys)
    closings = (
        rows.groupBy(*keys, "_block")
        .agg(F.sum("_closes").alias("_here"))
        .withColumn("_upto", F.sum("_here").over(per_key.orderBy("_block")))
        .withColumn("_all", F.sum("_here").over(per_key))
        .where("_all > 0")
        .select(
            *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
            F.col("_block").alias("_of"),
            (F.col("_upto") - F.col("_here")).alias("_before"),
            "_all",
        )
    )
    same = F.col("_block") == F.col("_of")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))

    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    earlier = F.coalesce(F.sum("_closes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        rows.withColumn("_earlier", earlier)
        .join(closings, same)
        .withColumn("sessionNo", F.col("_before") + F.col("_earlier"))
        .where(F.col("sessionNo") < F.col("_all"))
        .select(*df.columns, "sessionNo")
    )


def complete_sessions(
    df: DataFrame,
    key: str | Sequence[str] = "id",
    order: str = "seq",
    is_last: Column | str = "isLast",
    event: Sequence[str] = ("id", "greet", "isLast"),
    orders_per_block: int = ORDERS_PER_BLOCK,
) -> DataFrame:
    """One row per closed session, its events as an ordered array of structs.

    The array is the result, so a single session has to fit into a row. Where it may not, use
    ``closed_session_events``, which holds the same sessions one event per row.
    """
    keys = key_list(key)
    events = closed_session_events(df, keys, order, is_last, orders_per_block)
    listed = events.select(
        *keys,
        "sessionNo",
        F.struct(F.col(order).alias("_order"), F.struct(*event).alias("event")).alias("_item"),
    )
    return listed.groupBy(*keys, "sessionNo").agg(
        F.transform(F.array_sort(F.collect_list("_item")), lambda x: x["event"]).alias("userEvents")
    )

"""Sessions that end with a closing event, on streams.

Open events stand in a list state that grows by appending: a micro-batch writes its own events only, whatever the
session holds already. Rows of a key pass through one after the other, and a closed session leaves event by event, so that
no step holds all events of a key, unless one array per session is asked for.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sessionflow import schemas
from sessionflow.defaults import COLLECT_TIMEOUT_MS
from sessionflow.plans.islands import key_list

#: Events that are appended at once; a micro-batch with fewer events of a key that closes leaves the state untouched.
APPENDED = 1024


class Sessions(StatefulProcessor):
    """Appends the events of a micro-batch to the stored ones; hands all over once one of them closes.

    A stored event is ``part`` (the number of its micro-batch within the session), ``order`` and the event itself.
    """

    def __init__(self, stored: T.StructType, columns: list[str], timeout_ms: int, emit_on_timeout: bool, listed: bool):
        self._stored = stored
        self._row = Row(*columns)
        self._timeout_ms = timeout_ms
        self._emit_on_timeout = emit_on_timeout
        self._listed = listed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._events = handle.getListState("events", self._stored)
        self._open = handle.getValueState("open", "part long, deadline long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        found = self._open.get() if self._open.exists() else None
        part = found[0] + 1 if found else 0
        closes, waiting, appended = False, [], False
        for row in rows:
            closes = closes or row["_closes"]
            waiting.append((part, row["_order"], row["_item"]))
            if len(waiting) == APPENDED:
                self._events.appendList(waiting)
                waiting, appended = [], True
        if closes:
            yield from self._session(key, self._all(bool(found) or appended, waiting))
            if found or appended:
                self._clear(found)
        else:
            if waiting:
                self._events.appendList(waiting)
            if found:
                self._handle.deleteTimer(found[1])
            deadline = timerValues.getCurrentProcessingTimeInMs() + self._timeout_ms
            self._handle.registerTimer(deadline)
            self._open.update((part, deadline))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self._emit_on_timeout:
            yield from self._session(key, self._all(True, []))
        self._events.clear()
        self._open.clear()

    def close(self) -> None:
        pass

    def _clear(self, found: tuple | None) -> None:
        if found:
            self._handle.deleteTimer(found[1])
            self._open.clear()
        self._events.clear()

    def _all(self, stored: bool, waiting: list[tuple]) -> Iterator[tuple]:
        if stored:
            yield from self._events.get()
        yield from waiting

    def _session(self, key: tuple, events: Iterator[tuple]) -> Iterator[Row]:
        if not self._listed:
            for part, order, item in events:
                yield self._row(*key, part, order, item)
            return
        in_order = sorted(events, key=lambda e: (e[0], e[1] is None, 0 if e[1] is None else e[1]))
        yield self._row(*key, [item for _, _, item in in_order])


def _processed(
    df: DataFrame,
    keys: list[str],
    order: str | None,
    is_last: Column | str,
    event: Sequence[str],
    timeout_ms: int,
    emit_on_timeout: bool,
    listed: bool,
) -> DataFrame:
    closes = F.coalesce(F.col(is_last) if isinstance(is_last, str) else is_last, F.lit(False))
    number = F.col(order) if order else F.lit(None).cast("bigint")
    rows = df.select(*keys, F.struct(*event).alias("_item"), closes.alias("_closes"), number.alias("_order"))
    item = T.StructType([df.schema[c] for c in event])
    place = [T.StructField("part", T.LongType()), T.StructField("order", rows.schema["_order"].dataType)]
    rest = [T.StructField("userEvents", T.ArrayType(item))] if listed else [*place, T.StructField("event", item)]
    out = schemas.with_keys(df.schema, keys, T.StructType(rest))
    stored = T.StructType([*place, T.StructField("event", item)])
    processor = Sessions(stored, out.names, timeout_ms, emit_on_timeout, listed)
    return rows.groupBy(*keys).transformWithState(processor, out, "update", "processingTime")


def closed_session_events(
    df: DataFrame,
    key: str | Sequence[str] = "id",
    order: str | None = None,
    is_last: Column | str = "isLast",
    event: Sequence[str] = ("id", "greet", "isLast"),
    timeout_ms: int = COLLECT_TIMEOUT_MS,
    emit_on_timeout: bool = False,
) -> DataFrame:
    """One row per event of a session, once a closing event has come: the keys, ``part``, ``order``, ``event``.

    A session closes with a whole micro-batch: all events of the key that came with the closing one
    belong to it, those after it too, and several closing events make one session. A key therefore has one session in
    a micro-batch of the output at most, and ``part`` and ``order`` (null without one) sort its events. A key without
    new events for ``timeout_ms`` of the clock loses its open session, which is reported only with ``emit_on_timeout``.
    """
    return _processed(df, key_list(key), order, is_last, event, timeout_ms, emit_on_timeout, listed=False)


def complete_sessions(
    df: DataFrame,
    key: str | Sequence[str] = "id",
    order: str | None = None,
    is_last: Column | str = "isLast",
    event: Sequence[str] = ("id", "greet", "isLast"),
    timeout_ms: int = COLLECT_TIMEOUT_MS,
    emit_on_timeout: bool = False,
) -> DataFrame:
    """The sessions of ``closed_session_events`` as one row each, their events as an array.

    The array is the result, so a single session has to fit into a row. With ``order`` events of a micro-batch are
    put into that order, null last.
    """
    return _processed(df, key_list(key), order, is_last, event, timeout_ms, emit_on_timeout, listed=True)


def listed_sessions(events: DataFrame, key: str | Sequence[str] = "id") -> DataFrame:
    """One row per session from the written output of ``closed_session_events``, with its ``batch_id``."""
    keys = key_list(key)
    items = F.array_sort(F.collect_list(F.struct("part", F.col("order").isNull().alias("last"), "order", "event")))
    return events.groupBy(*keys, "batch_id").agg(F.transform(items, lambda e: e["event"]).alias("userEvents"))

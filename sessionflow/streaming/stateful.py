"""Keyed-state operators on streams.

With ``pre_aggregate=True`` rows are first reduced to time cells (``streaming.cells``), in the tasks that
read them; by default each row is a cell, and lateness is exact to the row. Cells of a key reach its state processor
one after the other, after late ones have been dropped by the watermark. They are folded some thousands at a time into a small state
per key, which is a row of values with the timer that will end it; the rows
of a key are never put together. Micro-batches should be bounded by the rate limits of the sources.

What these operators emit depends on how rows fall into micro-batches; the operators on tables
define the same sessions independent of that, and so does ``streaming.ordered``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sessionflow import schemas
from sessionflow.defaults import (
    SPAN_TIMEOUT_MS,
    SPAN_WATERMARK,
    STATE_TIMEOUT_MS,
    TRANSFER_GAP_MS,
    TRIP_GAP_MS,
    WATERMARK,
)
from sessionflow.plans.islands import key_list
from sessionflow.streaming.cells import as_cells, lots, merged
from sessionflow.streaming.folds import Open, Step, advance

# Width of the cells of operators that know no gap.
CELL_MS = 30_000
# Fields they need.
COUNTED = ("n",)
SPANNED = ("t0", "t1")


class Keyed(StatefulProcessor):
    """A state of some values per key, and the event time at which it ends.

    A key without rows in a micro-batch ends once the watermark is later than that time. Subclasses say what rows do to the state, and
    what its end reports.
    """

    def __init__(self, columns: list[str], state: T.StructType, timeout_ms: int):
        self._row = Row(*columns)
        self._schema = T.StructType([*state.fields, T.StructField("deadline", T.LongType())])
        self._timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("state", self._schema)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stored = self._state.get()
        now = max(timerValues.getCurrentWatermarkInMs(), 0)
        state, deadline, found = self.fold(key, stored[:-1] if stored else None, (r["cell"] for r in rows), now)
        if stored and stored[-1] != deadline:
            self._handle.deleteTimer(stored[-1])
        if state is None:
            if stored:
                self._state.clear()
        else:
            if not stored or stored[-1] != deadline:
                self._handle.registerTimer(deadline)
            self._state.update((*state, deadline))
        yield from found

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        stored = self._state.get()
        self._state.clear()
        yield from self.ended(key, stored[:-1], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def fold(self, key: tuple, stored: tuple | None, cells: Iterator, now: int) -> tuple[tuple | None, int | None, Iterator[Row]]:
        """The new state and its end, or neither, and the rows to report."""
        raise NotImplementedError

    def ended(self, key: tuple, stored: tuple, now: int) -> Iterator[Row]:
        raise NotImplementedError

    def _later(self, now: int) -> int:
        return max(now + self._timeout_ms, now + 1)

    def _rows(self, key: tuple, *columns) -> Iterator[Row]:
        for values in zip(*(np.asarray(c).tolist() for c in columns)):
            yield self._row(*key, *values)


def _keyed(cells: DataFrame, keys: list[str], kind: type[Keyed], rest: T.StructType, state: T.StructType, timeout_ms: int, *options) -> DataFrame:
    """Event-time state per key over cells."""
    out = schemas.with_keys(cells.schema, keys, rest)
    return cells.groupBy(*keys).transformWithState(kind(out.names, state, timeout_ms, *options), out, "update", "eventTime")


# --- trips ---------------------------------------------------------------------------------------


class Trips(Keyed):
    def __init__(self, columns: list[str], state: T.StructType, timeout_ms: int, gap_ms: int, recede: bool, progress: bool):
        super().__init__(columns, state, timeout_ms)
        self._gap_ms, self._recede, self._progress = gap_ms, recede, progress

    def fold(self, key, stored, cells, now):
        step = advance(Open(*stored) if stored else None, merged(lots(cells), self._gap_ms + 1), self._gap_ms, self._recede)
        left = step.open
        shown = _shown(step, self._progress)
        ended = np.arange(len(step.start_ms)) < len(step.start_ms) - 1
        columns = (step.start_ms, step.end_ms, step.start_value, step.end_value, ended)
        state = (left.start_ms, left.end_ms, left.start_value, left.end_value)
        return state, self._later(now), self._trips(key, *[c[:shown] for c in columns])

    def ended(self, key, stored, now):
        return self._trips(key, *np.array(stored)[:, None], np.array([True]))

    def _trips(self, key, start, end, start_value, end_value, ended) -> Iterator[Row]:
        # cut towards zero: an end that receded below the start gives a negative length
        duration = np.trunc((end - start) / 1000).astype(np.int64)
        return self._rows(key, start, end, start_value, end_value, duration, end_value - start_value, ended)


def _shown(step: Step, progress: bool) -> int:
    """How many of the sessions of a step to report: the closed ones, and the open one on progress."""
    closed = len(step.start_ms) - 1
    return closed + 1 if progress and not step.tail_is_new else closed


def trips(
    df: DataFrame,
    key: str | Sequence[str] = "vin",
    ts: str = "createTime",
    measure: str = "mileage",
    tiebreak: str | None = None,
    gap_ms: int = TRIP_GAP_MS,
    timeout_ms: int = STATE_TIMEOUT_MS,
    watermark: str = WATERMARK,
    end_may_recede: bool = False,
    pre_aggregate: bool = False,
) -> DataFrame:
    """Trips as they complete.

    A trip is reported in the micro-batch in which the next one starts. The last one of a key is
    reported once a micro-batch without rows of that key has a watermark later than the one of its
    last rows plus ``timeout_ms``; a trip can therefore be cut by the timeout alone. Measure and
    tiebreak are integers; rows without time or measure are left out.
    """
    return _trip_stream(df, key, ts, measure, tiebreak, gap_ms, timeout_ms, watermark, pre_aggregate, end_may_recede, False)


def trip_status(
    df: DataFrame,
    key: str | Sequence[str] = "vin",
    ts: str = "createTime",
    measure: str = "mileage",
    tiebreak: str | None = None,
    gap_ms: int = TRIP_GAP_MS,
    timeout_ms: int = STATE_TIMEOUT_MS,
    watermark: str = WATERMARK,
    end_may_recede: bool = False,
    pre_aggregate: bool = False,
) -> DataFrame:
    """``trips``, and in each micro-batch a row for the trip that goes on.

    There is no progress row when the last row of the micro-batch itself opened a trip.
    """
    return _trip_stream(df, key, ts, measure, tiebreak, gap_ms, timeout_ms, watermark, pre_aggregate, end_may_recede, True)


def _trip_stream(df, key, ts, measure, tiebreak, gap_ms, timeout_ms, watermark, pre_aggregate, recede, progress) -> DataFrame:
    keys = key_list(key)
    signals = df.where(F.col(ts).isNotNull() & F.col(measure).isNotNull())
    cells = as_cells(signals, keys, ts, gap_ms + 1, watermark, measure, tiebreak, pre_aggregate)
    return _keyed(cells, keys, Trips, schemas.TRIP, schemas.TRIP_STATE, timeout_ms, gap_ms, recede, progress)


# --- stations ------------------------------------------------------------------------------------


class Outages(Keyed):
    def __init__(self, columns: list[str], state: T.StructType, timeout_ms: int, gap_ms: int, recede: bool):
        super().__init__(columns, state, timeout_ms)
        self._gap_ms, self._recede = gap_ms, recede

    def fold(self, key, stored, cells, now):
        step = advance(Open(*stored) if stored else None, merged(lots(cells), self._gap_ms + 1), self._gap_ms, self._recede)
        # An outage lies between two transfers; the open transfer is progress.
        start, end = step.start_ms[1:], step.end_ms[:-1]
        if not step.tail_is_new:
            start, end = np.r_[start, step.open.start_ms], np.r_[end, step.open.end_ms]
        status = np.arange(len(start)) < len(step.start_ms) - 1
        return (step.open.start_ms, step.open.end_ms), self._later(now), self._rows(key, start, end, status)

    def ended(self, key, stored, now):
        return self._rows(key, [now], [stored[1]], [True])


def station_outages(
    df: DataFrame,
    key: str | Sequence[str] = "stationId",
    ts: str = "dataTime",
    gap_ms: int = TRANSFER_GAP_MS,
    timeout_ms: int = STATE_TIMEOUT_MS,
    watermark: str = WATERMARK,
    end_may_recede: bool = False,
    pre_aggregate: bool = False,
) -> DataFrame:
    """Outages of stations (``status`` true) and running transfers (``status`` false).

    An outage starts when the station sends again and ends with the last row before. When a
    station stays silent, its timeout reports an outage that starts at the watermark of that
    moment, which lags behind the newest rows and may precede the end.
    """
    keys = key_list(key)
    timed = df.where(F.col(ts).isNotNull())
    cells = as_cells(timed, keys, ts, gap_ms + 1, watermark, pre_aggregate=pre_aggregate)
    return _keyed(cells, keys, Outages, schemas.STATION_EVENT, schemas.SPAN_STATE, timeout_ms, gap_ms, end_may_recede)


# --- counts --------------------------------------------------------------------------------------


class Counts(Keyed):
    def fold(self, key, stored, cells, now):
        n = (stored[0] if stored else 0) + sum(n for [n] in cells)
        return (n,), self._later(now), self._rows(key, [n])

    def ended(self, key, stored, now):
        return iter(())


def pv_counts_expiring(
    df: DataFrame,
    keys: Sequence[str] = ("userId", "eventType"),
    ts: str = "eventTime",
    timeout_ms: int = STATE_TIMEOUT_MS,
    watermark: str = WATERMARK,
    pre_aggregate: bool = False,
) -> DataFrame:
    """Running count of each key with new rows. A silent key expires without a row and restarts.

    Rows without a readable time count too.
    """
    keys = key_list(keys)
    cells = as_cells(
        df, keys, ts, CELL_MS, watermark, pre_aggregate=pre_aggregate, fields=COUNTED
    )
    return _keyed(cells, keys, Counts, schemas.EVENT_COUNT, schemas.COUNT_STATE, timeout_ms)


# --- spans ---------------------------------------------------------------------------------------


class Spans(Keyed):
    def fold(self, key, stored, cells, now):
        start, end = stored if stored else (None, None)
        for first, last in cells:
            start = first if start is None else min(start, first)
            end = last if end is None else max(end, last)
        deadline = end + self._timeout_ms
        # the clock may have leapt past the deadline within the micro-batch
        if deadline <= now:
            again = ([start, start], [end, end], [end - start] * 2, [False, True])
            return None, None, self._rows(key, *again)
        return (start, end), deadline, self._span(key, start, end, False)

    def ended(self, key, stored, now):
        return self._span(key, *stored, True)

    def _span(self, key, start, end, expired) -> Iterator[Row]:
        return self._rows(key, [start], [end], [end - start], [expired])


def activity_span(
    df: DataFrame,
    key: str = "user_id",
    ts: str = "event_time",
    timeout_ms: int = SPAN_TIMEOUT_MS,
    watermark: str = SPAN_WATERMARK,
    pre_aggregate: bool = False,
) -> DataFrame:
    """First and last time of each user, whatever the pauses, while the state lives.

    Reported for each micro-batch with rows of the user, and once more with ``expired`` when the
    watermark has passed the end by ``timeout_ms``.
    """
    timed = df.where(F.col(ts).isNotNull())
    cells = as_cells(
        timed, [key], ts, CELL_MS, watermark, pre_aggregate=pre_aggregate, fields=SPANNED
    )
    return _keyed(cells, [key], Spans, schemas.SPAN, schemas.SPAN_STATE, timeout_ms)

"""Trips on streams that do not depend on how rows fall into micro-batches.

The running trips of a key are an interval map in the state: by its start, each interval of rows that no gap divides. Rows may come in
any order; a row widens an interval, joins two or begins one. Rows older than the watermark do not reach the state, so an
interval is final once the watermark has passed its end by more than the gap. Then a timer hands it over, in the order of time,
and takes it out of the map. What is still open can be read from the stored state as a table.

A call to the state costs about as much as a hundred rows, and a micro-batch of a large table touches most keys. So keys share
buckets, and the maps of a bucket are read, joined, written and timed together, as arrays: the calls of a micro-batch follow the
buckets, whatever the number of keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sessionflow.defaults import TRIP_GAP_MS, WATERMARK
from sessionflow.operators.trips import trip_columns
from sessionflow.plans.islands import key_list
from sessionflow.streaming.cells import as_cells

#: Rows of a bucket that are held before they are joined to intervals.
HELD = 8192
#: Groups that the keys are dealt to. As with the partitions of a state, a checkpoint goes on with the number it began with.
BUCKETS = 256
STATE = "intervals"
_BUCKET = "_bucket"

#: Start, its order, first value, end, its order, last value, rows.
Interval = tuple[int, int, int, int, int, int, int]
_FIELDS = ("start_ms", "start_order", "first_value", "end_ms", "end_order", "last_value", "n")


def joined(parts: Iterable[Interval], gap_ms: int) -> list[Interval]:
    """Intervals that are more than a gap apart, in the order of time."""
    cells = np.array(list(parts), np.int64).reshape(-1, len(_FIELDS))
    return [tuple(i) for i in _joined(np.zeros(len(cells), np.int64), cells, gap_ms)[1].tolist()]


def _joined(key: np.ndarray, parts: np.ndarray, gap_ms: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for many keys, which have numbers; ordered by them."""
    if not len(parts):
        return key, parts
    order = np.lexsort((*parts.T[::-1], key))
    key, parts = key[order], parts[order]
    reach = pd.Series(parts[:, 3]).groupby(key).cummax().to_numpy()
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (parts[1:, 0] - reach[:-1] > gap_ms)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(key)) - 1
    by_end = np.lexsort((parts[:, 4], parts[:, 3], np.cumsum(fresh)))
    found = parts[first]
    found[:, 3:6] = parts[by_end[last], 3:6]
    found[:, 6] = np.add.reduceat(parts[:, 6], first)
    return key[first], found


def _numbers(keys: pd.DataFrame) -> np.ndarray:
    """Equal ones for equal keys."""
    found = np.zeros(len(keys), np.int64)
    for name in keys:
        codes, values = pd.factorize(keys[name], use_na_sentinel=False)
        found = pd.factorize(found * len(values) + codes)[0]
    return found


class OrderedTrips(StatefulProcessor):
    """The interval maps of a bucket of keys, one list element per key that has intervals.

    Keys are texts; the names of the stored ones say of which types, in hexadecimal digits.
    """

    def __init__(self, keys: list[str], kinds: list[T.DataType], gap_ms: int):
        self._keys = keys
        self._names = [f"{k}_{kind.simpleString().encode().hex()}" for k, kind in zip(keys, kinds)]
        self._gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        keys = [T.StructField(n, T.StringType()) for n in self._names]
        held = T.StructField("intervals", T.ArrayType(T.LongType()))
        self._maps = handle.getListState(STATE, T.StructType([*keys, held]))
        self._timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        keys, found = self._stored()
        waiting, held = [], 0
        for frame in rows:
            waiting.append((frame[self._keys], frame[list(_FIELDS)].to_numpy(np.int64)))
            held += len(frame)
            if held >= max(HELD, len(found)):
                keys, found = self._join([(keys, found), *waiting])
                waiting, held = [], 0
        self._store(*self._join([(keys, found), *waiting]))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._timer.clear()
        keys, found = self._stored()
        over = found[:, 3] + self._gap_ms < timerValues.getCurrentWatermarkInMs()
        self._store(keys[~over], found[~over])
        ended = found[over]
        columns = {"start_ms": ended[:, 0], "end_ms": ended[:, 3], "first_value": ended[:, 2], "last_value": ended[:, 5]}
        yield keys[over].reset_index(drop=True).assign(**columns)

    def close(self) -> None:
        pass

    def _join(self, parts: list[tuple[pd.DataFrame, np.ndarray]]) -> tuple[pd.DataFrame, np.ndarray]:
        keys = pd.concat([k for k, _ in parts], ignore_index=True)
        number = _numbers(keys)
        found_number, found = _joined(number, np.concatenate([p for _, p in parts]), self._gap_ms)
        one = np.zeros(number.max(initial=-1) + 1, np.int64)
        one[number] = np.arange(len(number))
        return keys.iloc[one[found_number]], found

    def _stored(self) -> tuple[pd.DataFrame, np.ndarray]:
        """Of each interval its key; those of a key stand together, in the order of time."""
        maps = list(self._maps.get())
        n = [len(m[-1]) // len(_FIELDS) for m in maps]
        columns = {k: np.repeat(np.array([m[i] for m in maps], object), n) for i, k in enumerate(self._keys)}
        flat = np.array([x for m in maps for x in m[-1]], np.int64)
        return pd.DataFrame(columns, columns=self._keys, dtype=object), flat.reshape(-1, len(_FIELDS))

    def _store(self, keys: pd.DataFrame, found: np.ndarray) -> None:
        number = _numbers(keys)
        cuts = np.flatnonzero(np.diff(number, prepend=-1, append=-1)) if len(number) else np.zeros(1, np.int64)
        owners = zip(*(keys[k].iloc[cuts[:-1]].tolist() for k in self._keys))
        maps = [(*own, found[a:b].ravel().tolist()) for own, a, b in zip(owners, cuts[:-1], cuts[1:])]
        self._maps.put(maps) if maps else self._maps.clear()
        # one timer, for the interval that ends first
        at = int(found[:, 3].min()) + self._gap_ms + 1 if len(found) else None
        armed = self._timer.get()
        armed = armed[0] if armed else None
        if at == armed:
            return
        if armed is not None:
            self._handle.deleteTimer(armed)
        if at is None:
            self._timer.clear()
        else:
            self._handle.registerTimer(at)
            self._timer.update((at,))


def _as_text(key: Column, kind: T.DataType) -> Column:
    """A key as the state holds it, whatever its type: equal texts for equal keys."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (key + F.lit(0).cast(kind)).cast("string")  # one zero
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(key).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.base64(key)
    return F.to_json(F.struct(key.alias("k"))) if _is_nested(kind) else key.cast("string")


def _from_text(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(text.cast("bigint"))
    if isinstance(kind, T.BinaryType):
        return F.unbase64(text)
    return F.from_json(text, T.StructType([T.StructField("k", kind)]))["k"] if _is_nested(kind) else text.cast(kind)


def _is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ArrayType, T.StructType))


_FOUND = T.StructType([T.StructField(c, T.LongType()) for c in ("start_ms", "end_ms", "first_value", "last_value")])


def trips(
    df: DataFrame,
    key: str | Sequence[str] = "vin",
    ts: str = "createTime",
    measure: str = "mileage",
    tiebreak: str | None = None,
    gap_ms: int = TRIP_GAP_MS,
    watermark: str = WATERMARK,
    pre_aggregate: bool = False,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Trips, each once, when the watermark has passed its end by more than the gap; for append mode.

    The trips are those of the table form for all rows that were not late, whatever the micro-batches. Measure and tiebreak are
    integers; rows without time or measure are left out. The state of a bucket of keys is held in memory while the bucket
    is dealt with; ``buckets`` does not change the result.
    """
    keys = key_list(key)
    signals = df.where(F.col(ts).isNotNull() & F.col(measure).isNotNull())
    cells = as_cells(signals, keys, ts, gap_ms + 1, watermark, measure, tiebreak, pre_aggregate)
    kinds = [cells.schema[k].dataType for k in keys]
    texts = [f"key{n}" for n in range(len(keys))]
    # an order that is missing comes first, as in a table
    parts = [F.coalesce(F.col("cell")[n], F.lit(-(1 << 63))).alias(c) for n, c in enumerate(_FIELDS)]
    named = cells.select(*[_as_text(F.col(k), kind).alias(t) for k, kind, t in zip(keys, kinds, texts)], *parts, "_at")
    dealt = named.withColumn(_BUCKET, F.pmod(F.hash(*texts), F.lit(buckets)))
    out = T.StructType([*(T.StructField(t, T.StringType()) for t in texts), *_FOUND.fields])
    found = dealt.groupBy(_BUCKET).transformWithStateInPandas(OrderedTrips(texts, kinds, gap_ms), out, "append", "eventTime")
    typed = [_from_text(F.col(t), kind).alias(k) for k, kind, t in zip(keys, kinds, texts)]
    return found.select(*typed, *_FOUND.names).select(*keys, *trip_columns(F.lit(True)))


def open_trips(spark: SparkSession, checkpoint: str, key: str | Sequence[str] = "vin", batch_id: int | None = None) -> DataFrame:
    """The running trips of a query of ``trips`` from its checkpoint, after its last micro-batch or an earlier one."""
    reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", STATE)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    held = reader.load().select("list_element.*")
    starts = F.sequence(F.lit(1), F.size("intervals"), F.lit(len(_FIELDS)))
    each = F.explode(F.transform(starts, lambda at: F.slice("intervals", at, F.lit(len(_FIELDS)))))
    kinds = [T.DataType.fromDDL(bytes.fromhex(name.partition("_")[2]).decode()) for name in held.columns[:-1]]
    typed = [_from_text(F.col(f"`{t}`"), kind).alias(k) for k, t, kind in zip(key_list(key), held.columns, kinds)]
    found = held.select(*typed, each.alias("_i"))
    fields = [F.col("_i")[n].alias(c) for n, c in enumerate(_FIELDS)]
    return found.select(*key_list(key), *fields).select(*key_list(key), *trip_columns(F.lit(False)))

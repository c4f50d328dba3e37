"""Time cells: what keyed-state operators receive in place of single rows.

Rows of a key within ``gap_ms + 1`` ms of each other belong together, whatever comes between. So
before the shuffle each task can reduce its rows to one per (key, cell), and a key that sends a third
of all rows then reaches its state function as a few cells. There cells are merged again, chunk by chunk: memory follows the time span of a micro-batch, not its rows.

A cell carries its first and last time with their tiebreak and measure, and its number of rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionflow import schemas
from sessionflow.functions.timeconv import floor_div, from_epoch_ms, time_ms

START = ("t0", "o0", "m0")
END = ("t1", "o1", "m1")
FIELDS = (*START, *END, "n")
ROWS_PER_REDUCTION = 262_144
#: Cells that a state processor turns into one array.
CELLS_PER_LOT = 4096


def as_cells(
    df: DataFrame,
    keys: list[str],
    ts: str,
    width_ms: int,
    watermark: str,
    measure: str | None = None,
    tiebreak: str | None = None,
    pre_aggregate: bool = False,
    fields: Sequence[str] = FIELDS,
) -> DataFrame:
    """Cells of a stream: the keys, ``cell`` with the wanted fields, and the last time of each as
    its watermarked event time ``_at``.

    The fields are packed into one array, because what a state function costs per key is mostly
    the conversion of its columns.

    Every row is a cell of its own by default, and lateness is exact to the row. With ``pre_aggregate``
    a cell stands at its end, for the clock too, which runs ahead by less than a cell. Rows of a cell are
    then late together or not at all, however they are laid out over tasks.
    """
    zero = F.lit(0).cast("bigint")
    rows = df.select(
        *keys,
        time_ms(df, ts).alias("_t"),
        (F.col(measure).cast("bigint") if measure else zero).alias("_m"),
        (F.col(tiebreak or measure).cast("bigint") if measure else zero).alias("_o"),
    )
    if pre_aggregate:
        cells = _reduced(rows.withColumn("_cell", floor_div(F.col("_t"), width_ms)), keys)
        bound = (floor_div(F.col("t1"), width_ms) + 1) * width_ms - 1
    else:
        bound = F.col("t1")
        cells = rows.select(
            *keys,
            *[F.col(c).alias(f) for f, c in zip((*START, *END), ("_t", "_o", "_m") * 2)],
            F.lit(1).cast("bigint").alias("n"),
        )
    packed = cells.select(*keys, F.array(*fields).alias("cell"), from_epoch_ms(bound).alias("_at"))
    return packed.withWatermark("_at", watermark)


def lots(cells: Iterable[Sequence[int]], size: int | None = None) -> Iterator[np.ndarray]:
    """Cells as arrays of one row each, some thousands together."""
    held = []
    for cell in cells:
        held.append(cell)
        if len(held) >= (size or CELLS_PER_LOT):
            yield np.array(held, dtype=np.int64)
            held = []
    if held:
        yield np.array(held, dtype=np.int64)


def _reduced(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per (key, cell) and ``ROWS_PER_REDUCTION`` input rows of a task."""
    longs = T.StructType([T.StructField(f, T.LongType()) for f in FIELDS])
    picks = [(c, end) for end in ("first", "last") for c in ("_t", "_o", "_m")]
    picked = [f"{c}_{end}" for c, end in picks] + ["count_all"]
    rows_held = ROWS_PER_REDUCTION

    def reduce(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        nulls = pc.ScalarAggregateOptions(skip_nulls=False)
        wanted = [(c, end, nulls) for c, end in picks] + [([], "count_all")]
        in_time = pa.Table.from_batches(held).sort_by([("_t", "ascending"), ("_o", "ascending")])
        cells = in_time.group_by([*keys, "_cell"], use_threads=False).aggregate(wanted)
        return cells.select([*keys, *picked]).rename_columns([*keys, *FIELDS]).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= rows_held:
                yield from reduce(held)
                held, size = [], 0
        if size:
            yield from reduce(held)

    return rows.mapInArrow(run, schemas.with_keys(rows.schema, keys, longs))


def merged(chunks: Iterable[np.ndarray], width_ms: int) -> dict[str, np.ndarray]:
    """Cells of all chunks in time order, one array per field, each cell once.

    Chunks wait until they are as many as the cells so far, so that even a key whose rows hardly
    share cells is merged a few times only.
    """
    cells = {f: np.empty(0, dtype=np.int64) for f in FIELDS}
    waiting, size = [], 0
    for chunk in chunks:
        waiting.append(dict(zip(FIELDS, chunk.T)))
        size += len(chunk)
        if size >= max(ROWS_PER_REDUCTION, len(cells["n"])):
            cells = _merge([cells, *waiting], width_ms)
            waiting, size = [], 0
    return _merge([cells, *waiting], width_ms) if size else cells


def _merge(tables: list[dict[str, np.ndarray]], width_ms: int) -> dict[str, np.ndarray]:
    parts = {f: np.concatenate([t[f] for t in tables]) for f in FIELDS}
    by_start = np.lexsort((parts["o0"], parts["t0"]))
    by_end = np.lexsort((parts["o1"], parts["t1"]))
    # Both orders visit the cells in the same sequence, so they share the bounds of the groups.
    cell = parts["t0"][by_start] // width_ms
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    last = np.r_[first[1:], len(cell)] - 1
    out = {f: parts[f][by_start][first] for f in START}
    out |= {f: parts[f][by_end][last] for f in END}
    out["n"] = np.add.reduceat(parts["n"][by_start], first)
    return out

"""Centroid clustering with Ptolemaic pivots: bounds from cached pivot distances spare exact distances.

Vectors become whole numbers, so that sums, means (rounded down) and squared distances are exact and the result
does not depend on the order of the work. For a vector x, a centroid c and two pivots p, q Ptolemy's inequality gives
``d(x, c) * d(p, q) >= |d(x, p) * d(c, q) - d(x, q) * d(c, p)|``. The distances of every vector to the pivots are
computed once and kept with it; those of the centroids once a round. The centroid with the least bound is computed exactly,
and only centroids whose bound, rounded down by more than floating point can err, does not exceed that distance
are computed too. A task hands on sums by centroid and component, never vectors.

Defined results: vectors that are null, of another length, or hold a null or non-finite component (also one that becomes
infinite when scaled) are left out; a null id takes part, but starts a centroid only after all others; repeated rows take
part each; with fewer vectors than centroids there are fewer centroids; equal start vectors and ties of distance go to the smaller
centroid number; an empty table gives an empty result; a distance beyond 64 bits is null, and so are sums over it;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sessionflow.workdir import write_table

#: Pivots, of which every pair gives a bound.
PIVOTS = 6
#: Vectors that are compared at once.
BLOCK_ROWS = 2048
#: Whole numbers travel as digits of so many bits: any sum of them fits into 64 bits.
DIGIT_BITS = 32
#: Relative error that rounding may add to a bound or a distance; far more than it does.
SLACK = 1e-9
_STATS = "cluster int, place int, digit int, value long"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a binary column of doubles."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return np.frombuffer(data.tobytes(), dtype="<f8").reshape(len(column), width)


def _binary(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    offsets = np.arange(rows + 1, dtype=np.int32) * np.int32(8 * width)
    return pa.BinaryArray.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(matrix.astype("<f8").tobytes())])


def _lengths(differences: np.ndarray) -> np.ndarray:
    """Euclidean lengths along the last axis, in double precision."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.sqrt((differences * differences).sum(axis=-1))


class Centroids:
    """Centroids of one round, with their distances to the pivots."""

    def __init__(self, centres: list[list[int]], pivots: np.ndarray):
        self.exact = centres
        self.size = len(pivots[0])
        self.values = np.array(centres, dtype=np.float64)
        # differences of such numbers, squared and summed, are whole numbers that doubles hold exactly
        self.limit = float(int(((1 << 53) / self.size) ** 0.5) // 2)
        self.small = np.abs(self.values).max(axis=1) <= self.limit
        self.to_pivots = _lengths(self.values[:, None, :] - pivots[None, :, :])
        apart = _lengths(pivots[:, None, :] - pivots[None, :, :])
        pairs = [(p, q) for p in range(len(pivots)) for q in range(p)]
        self.pairs = [(p, q, apart[p, q]) for p, q in pairs if 0 < apart[p, q] < np.inf]

    def bounds(self, to_pivots: np.ndarray) -> np.ndarray:
        """A lower bound of the distance of each vector to each centroid."""
        found = np.zeros((len(to_pivots), len(self.values)))
        with np.errstate(over="ignore", invalid="ignore"):
            for p, q, apart in self.pairs:
                one = to_pivots[:, p, None] * self.to_pivots[None, :, q]
                other = to_pivots[:, q, None] * self.to_pivots[None, :, p]
                bound = (np.abs(one - other) - SLACK * (one + other)) / (apart * (1 + SLACK))
                np.fmax(found, bound, out=found)  # what is no number bounds nothing
        found[~np.isfinite(found)] = 0.0
        return found

    def nearest(self, vectors: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, list[int], int]:
        """Of each vector the centroid, the squared distance, and how many distances were computed."""
        clusters = np.zeros(len(vectors), dtype=np.int32)
        squares: list[int] = [0] * len(vectors)
        computed = 0
        plain = np.abs(vectors).max(axis=1) <= self.limit if self.small.any() else np.zeros(len(vectors), dtype=bool)
        wide = list(np.flatnonzero(~plain))
        for start in range(0, len(vectors), BLOCK_ROWS):
            rows = start + np.flatnonzero(plain[start : start + BLOCK_ROWS])
            if not len(rows):
                continue
            lower = self.bounds(to_pivots[rows])
            first = np.where(self.small, lower, np.inf).argmin(axis=1)
            square = ((vectors[rows] - self.values[first]) ** 2).sum(axis=1)
            left = lower <= (np.sqrt(square) * (1 + SLACK))[:, None]
            left[np.arange(len(rows)), first] = False
            beyond = left[:, ~self.small].any(axis=1)
            wide.extend(rows[beyond])
            table = np.full(left.shape, np.inf)
            table[np.arange(len(rows)), first] = square
            row, centre = np.nonzero(left & self.small)
            table[row, centre] = ((vectors[rows[row]] - self.values[centre]) ** 2).sum(axis=1)
            best = table.argmin(axis=1)
            clusters[rows] = best
            for r, s in zip(rows.tolist(), table[np.arange(len(rows)), best].astype(np.int64).tolist()):
                squares[r] = s
            computed += len(rows) + len(row)
        for r in wide:
            vector = [int(x) for x in vectors[r]]
            found = [sum((x - y) ** 2 for x, y in zip(vector, c)) for c in self.exact]
            squares[r] = min(found)
            clusters[r] = found.index(squares[r])
            computed += len(found)
        return clusters, squares, computed


class _Sums:
    """Exact sums of the vectors of each centroid."""

    def __init__(self, centres: int, size: int):
        self.counts = [0] * centres
        self.sums = [[0] * size for _ in range(centres)]

    def add(self, clusters: np.ndarray, vectors: np.ndarray) -> None:
        # blocks of so few and small numbers have sums that doubles hold exactly
        plain = np.abs(vectors).max(axis=1) <= float(1 << 40)
        for start in range(0, len(vectors), BLOCK_ROWS):
            rows = start + np.flatnonzero(plain[start : start + BLOCK_ROWS])
            member = np.zeros((len(rows), len(self.counts)))
            member[np.arange(len(rows)), clusters[rows]] = 1.0
            block = member.T @ vectors[rows]
            for c in np.unique(clusters[rows]).tolist():
                self._add(c, int(member[:, c].sum()), block[c])
        for r in np.flatnonzero(~plain):
            self._add(int(clusters[r]), 1, vectors[r])

    def _add(self, c: int, n: int, values: np.ndarray) -> None:
        self.counts[c] += n
        self.sums[c] = [a + int(b) for a, b in zip(self.sums[c], values)]

    def rows(self) -> Iterator[tuple[int, int, int, int]]:
        """``cluster, place, digit, value``; the count stands at place -1."""
        for c, (n, sums) in enumerate(zip(self.counts, self.sums)):
            if n:
                for place, value in enumerate([n, *sums], -1):
                    sign, value, digit = (-1 if value < 0 else 1), abs(value), 0
                    while value:
                        yield c, place, digit, sign * (value & ((1 << DIGIT_BITS) - 1))
                        value, digit = value >> DIGIT_BITS, digit + 1


def _prepared(kept: DataFrame, size: int, scale: float, pivots: np.ndarray, id_field: StructField) -> DataFrame:
    schema = StructType([id_field, *StructType.fromDDL("vector binary, to_pivots binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                vectors = np.floor(flat.reshape(part.num_rows, size) * scale)
                to_pivots = _lengths(vectors[:, None, :] - pivots[None, :, :])
                yield pa.RecordBatch.from_arrays([part.column(0), _binary(vectors), _binary(to_pivots)], schema.names)

    return kept.mapInArrow(run, schema)


def _stats(cached: DataFrame, centroids: Centroids, n_pivots: int) -> dict[tuple[int, int], int]:
    """Counts and sums of each centroid: as many rows as centroids have components, whatever the table."""
    size, k = centroids.size, len(centroids.exact)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(k, size)
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column(0), size)
                sums.add(centroids.nearest(vectors, _matrix(batch.column(1), n_pivots))[0], vectors)
        columns = list(zip(*sums.rows())) or [[], [], [], []]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["cluster", "place", "digit", "value"])

    partial = cached.select("vector", "to_pivots").mapInArrow(run, _STATS)
    found: dict[tuple[int, int], int] = {}
    for r in partial.groupBy("cluster", "place", "digit").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        at = r["cluster"], r["place"]
        found[at] = found.get(at, 0) + (int(r["value"]) << (DIGIT_BITS * r["digit"]))
    return found


def _moved(centres: list[list[int]], stats: dict[tuple[int, int], int]) -> list[list[int]]:
    """Means of the members, rounded down; a centroid without members stays."""
    return [
        [stats.get((c, i), 0) // stats[c, -1] for i in range(len(centre))] if (c, -1) in stats else centre
        for c, centre in enumerate(centres)
    ]


def _assigned(cached: DataFrame, centroids: Centroids, n_pivots: int, id_field: StructField) -> DataFrame:
    schema = StructType([id_field, *StructType.fromDDL("cluster int, distance long").fields])
    size, most = centroids.size, (1 << 63) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors, to_pivots = _matrix(batch.column(1), size), _matrix(batch.column(2), n_pivots)
                clusters, squares, _ = centroids.nearest(vectors, to_pivots)
                distances = pa.array([s if s <= most else None for s in squares], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(clusters), distances], schema.names)

    return cached.mapInArrow(run, schema)


def _far_apart(vectors: list[list[int]], number: int) -> np.ndarray:
    """Vectors far from each other: each next one is the farthest from those before."""
    values = np.array(vectors, dtype=np.float64)
    chosen, reach = [0], _lengths(values - values[0])
    while len(chosen) < min(number, len(values)):
        chosen.append(int(np.nan_to_num(reach, posinf=0.0).argmax()))
        reach = np.minimum(reach, _lengths(values - values[chosen[-1]]))
    return values[chosen]


def clusters(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    size: int = 64,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    pivots: int = PIVOTS,
) -> DataFrame:
    """``<id>, cluster, distance`` (squared), ``cluster_inertia, inertia`` and ``centroid``, its components joined by commas.

    The first centroids are the ``k`` vectors with the smallest SHA-256 of ``1:<id>``.
    """
    spark = vectors.sparkSession
    id_field = StructField(id_col, vectors.schema[id_col].dataType)
    value = F.col(vector_col).cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < float("inf")))
    kept = vectors.where(F.coalesce((F.size(value) == size) & finite, F.lit(False))).select(id_col, value.alias("vector"))
    digest = F.sha2(F.concat(F.lit("1:"), F.col(id_col).cast("string")), 256)
    first = kept.orderBy(digest.asc_nulls_last(), "vector").limit(4 * k).collect()
    if not first:
        empty = StructType([id_field, *StructType.fromDDL("cluster int, distance long, cluster_inertia long, inertia long, centroid string").fields])
        return spark.createDataFrame([], empty)
    scaled = [[int(x) for x in np.floor(np.array(r["vector"]) * scale)] for r in first]
    centres, anchors = scaled[:k], _far_apart(scaled, pivots)
    cached = write_table(_prepared(kept, size, scale, anchors, id_field), "cluster-vectors")
    for _ in range(rounds):
        centres = _moved(centres, _stats(cached, Centroids(centres, anchors), len(anchors)))
    found = write_table(_assigned(cached, Centroids(centres, anchors), len(anchors), id_field), "clusters")
    return _with_sums(found, centres)


def _with_sums(found: DataFrame, centres: list[list[int]]) -> DataFrame:
    """Inertias, one for each centroid, as constants."""
    known = F.sum(F.col("distance").cast("decimal(38,0)")).alias("distance"), F.count_if(F.col("distance").isNull()).alias("beyond")
    sums = {r["cluster"]: r for r in found.groupBy("cluster").agg(*known).collect()}
    most = (1 << 63) - 1
    parts = [int(sums[c]["distance"]) if c in sums and not sums[c]["beyond"] else None for c in range(len(centres))]
    whole = sum(p for c, p in enumerate(parts) if c in sums) if all(parts[c] is not None for c in sums) else None

    def constant(value: int | None):
        return F.lit(value if value is not None and value <= most else None).cast("bigint")

    at = F.col("cluster") + 1
    return found.select(
        "*",
        F.element_at(F.array(*map(constant, parts)), at).alias("cluster_inertia"),
        constant(whole).alias("inertia"),
        F.element_at(F.array(*[F.lit(",".join(map(str, c))) for c in centres]), at).alias("centroid"),
    )

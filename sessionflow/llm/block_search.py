"""Nearest neighbours by a block matrix join: int8 tiles with error bounds, exact distances for the rest.

Vectors are rounded to int8 with a scale of their own, and the length of what rounding takes away is kept
with each. Queries and candidates are dealt into blocks, and a tile is one block of each. The product of
its int8 matrices gives the distance of every pair up to the two rounding errors: a candidate whose least
possible distance is more than the k-th smallest of the greatest possible ones cannot be among the k
nearest. Only the others are computed from the original vectors, and a heap keeps the best of each tile.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part; a null
id takes no part; repeated ids are separate candidates, but no candidate of a query has its own id;
ties go to the smaller id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOUND = "query_id long, vec_id long, score double"


def usable(vector: str) -> Column:
    """True for vectors with only finite components, not all of them zero."""
    value = F.col(vector)
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(value.isNotNull() & finite & F.exists(value, lambda x: x != 0), F.lit(False))


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, and lengths of the rounding errors."""
    scale = np.abs(vectors).max(axis=1) / 127.0
    scale[scale == 0] = 1.0
    codes = np.rint(vectors / scale[:, None]).astype(np.int8)
    error = np.sqrt(((vectors - codes * scale[:, None]) ** 2).sum(axis=1))
    return codes, scale, error


def distances(query: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, summed from the first component to the last."""
    squares = (candidates - query) ** 2
    return np.sqrt(np.add.accumulate(squares, axis=1)[:, -1])


def _unpack(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def _tile(k: int):
    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        by_size = queries["vector"].map(len)
        for size, part in queries.groupby(by_size, sort=False):
            fitting = rows[rows["vector"].map(len) == size]
            if len(fitting):
                found.extend(_nearest(part, fitting, k))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    return search


def _nearest(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> Iterator[tuple]:
    vectors, ids = _unpack(rows["vector"]), rows["vec_id"].to_numpy()
    asked, asked_ids = _unpack(queries["vector"]), queries["vec_id"].to_numpy()
    codes, scale, error = quantise(vectors)
    q_codes, q_scale, q_error = quantise(asked)
    # whole numbers below 2**24 are exact in float32: up to 1040 components; beyond, double precision
    exact = np.float32 if vectors.shape[1] * 127 * 127 < 1 << 24 else np.float64
    product = q_codes.astype(exact) @ codes.T.astype(exact)
    square = (codes.astype(np.float64) ** 2).sum(axis=1) * scale**2
    q_square = (q_codes.astype(np.float64) ** 2).sum(axis=1) * q_scale**2
    about = q_square[:, None] + square - 2.0 * product * q_scale[:, None] * scale
    about = np.sqrt(np.maximum(about, 0.0))
    slack = (q_error[:, None] + error) * (1 + 1e-9) + 1e-6 * (np.sqrt(q_square)[:, None] + np.sqrt(square))
    for i, query in enumerate(asked_ids):
        other = np.flatnonzero(ids != query)
        if not len(other):
            continue
        upper = about[i, other] + slack[i, other]
        limit = np.partition(upper, k - 1)[k - 1] if len(other) > k else math.inf
        left = other[about[i, other] - slack[i, other] <= limit]
        exactly = distances(asked[i], vectors[left])
        for score, vec in heapq.nsmallest(k, zip(exactly.tolist(), ids[left].tolist())):
            yield query, vec, score


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_block: int = 512,
    row_block: int = 4096,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of each row for which ``queries`` holds."""
    rows = vectors.where(usable(vector_col) & F.col(id_col).isNotNull())
    rows = rows.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), queries.alias("asked")
    )
    counts = rows.agg(F.count("*").alias("n"), F.count_if("asked").alias("q")).first()
    row_blocks, query_blocks = math.ceil(counts["n"] / row_block), math.ceil(counts["q"] / query_block)
    deal = F.xxhash64("vec_id", "vector")
    dealt_rows = rows.select("vec_id", "vector", F.pmod(deal, F.lit(max(row_blocks, 1))).alias("r"))
    dealt_rows = dealt_rows.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(max(query_blocks, 1) - 1))))
    asked = rows.where("asked").select("vec_id", "vector", F.pmod(deal, F.lit(max(query_blocks, 1))).cast("int").alias("q"))
    asked = asked.withColumn("r", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(row_blocks, 1) - 1))))
    tiles = asked.groupBy("q", "r").cogroup(dealt_rows.groupBy("q", "r"))
    found = tiles.applyInPandas(_tile(k), FOUND)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

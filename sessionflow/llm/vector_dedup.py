"""Embedding near-dedup by product quantisation: inverted lists, table-lookup distances, exact cosines.

Unit vectors of one label are compared. Each vector stands in the list of its nearest coarse centroid, as
codes of the parts of its residual and the length of what the codes miss. A query goes to every list that
can hold a partner: two unit vectors of cosine ``c`` are at most ``r = sqrt(2 - 2c)`` apart, and a partner
in the list of another centroid lies beyond the plane halfway between the two centroids, so that plane is
at most ``r`` away from the query. Within a list the distance to the decoded vector is added up from a
table of the query's parts; it differs from the true one by the length that the codes miss at most, so only
vectors within ``r`` plus that length are compared by their exact cosine, in double precision. No bound
drops a pair at the threshold: all links are found.

Equal vectors of a label are one class with a number of members. Lists are worked on in tiles of a block
of queries and a block of entries; a tile returns the number of links of each query and links that join
components, not all pairs.

Centroids and code books are trained per session on a bounded sample; every vector is indexed.

Defined results: vectors that are null, zero, or hold null or non-finite components, and those without a
label, link with nothing and are components of their own; vectors of different length are not compared;
repeated ids are one node; a null id has no component and is kept; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.llm.block_search import usable
from sessionflow.llm.components import components
from sessionflow.workdir import write_table

#: Vectors that the centroids and code books are trained on, at most.
SAMPLE_ROWS = 8_192
PARTS, CODES, ROUNDS = 8, 256, 8
#: Vectors of a label in a coarse list, on average, up to a number of lists.
LIST_VECTORS, MOST_LISTS = 256, 1024
BLOCK = 512


@dataclass
class Index:
    """Coarse centroids, and for each part of the residuals its code book."""

    centroids: np.ndarray
    books: list[np.ndarray]

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        """The list of each vector."""
        return _squares(vectors, self.centroids).argmin(axis=1)

    def probes(self, vectors: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a vector and a list that may hold vectors within reach."""
        square = _squares(vectors, self.centroids)
        near = square.argmin(axis=1)
        apart = np.sqrt(np.maximum(_squares(self.centroids, self.centroids), 0.0))
        # the plane is (square' - square) / (2 * apart) away
        return np.nonzero(square - square.min(axis=1, keepdims=True) <= 2 * reach * apart[near] + 1e-9)

    def encode(self, vectors: np.ndarray, nearest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the lengths they miss."""
        residual = vectors - self.centroids[nearest]
        codes = np.stack([_squares(p, b).argmin(axis=1) for p, b in zip(self._parts(residual), self.books)], axis=1)
        decoded = np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], axis=1)
        return codes.astype(np.uint8), np.sqrt(((residual - decoded) ** 2).sum(axis=1))

    def distances(self, queries: np.ndarray, centroid: int, codes: np.ndarray) -> np.ndarray:
        """From queries to the decoded entries of a list, by a table of squares for each part."""
        total = np.zeros((len(queries), len(codes)))
        for i, (part, book) in enumerate(zip(self._parts(queries - self.centroids[centroid]), self.books)):
            total += _squares(part, book)[:, codes[:, i]]
        return np.sqrt(np.maximum(total, 0.0))

    def _parts(self, vectors: np.ndarray) -> list[np.ndarray]:
        return np.array_split(vectors, len(self.books), axis=1)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a**2).sum(axis=1)[:, None] - 2 * a @ b.T + (b**2).sum(axis=1)


def _means(vectors: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centroids by Lloyd's rounds."""
    rng = np.random.default_rng(seed)
    centroids = vectors[np.sort(rng.permutation(len(vectors))[:k])].copy()
    for _ in range(ROUNDS):
        near = _squares(vectors, centroids).argmin(axis=1)
        sizes = np.bincount(near, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, vectors)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    return centroids


def train(sample: np.ndarray, n_lists: int) -> Index:
    centroids = _means(sample, min(n_lists, len(sample)), 1)
    residual = sample - centroids[_squares(sample, centroids).argmin(axis=1)]
    parts = np.array_split(residual, min(PARTS, sample.shape[1]), axis=1)
    return Index(centroids, [_means(p, min(CODES, len(p)), 2 + i) for i, p in enumerate(parts)])


def _unit(column: pa.Array) -> np.ndarray:
    vectors = np.array(column.to_pylist(), dtype=np.float64)
    # scaled first, so that very long and very short vectors keep a finite length
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row."""
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(label_col).cast("int").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        (usable(vector_col) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).alias("fit"),
    ).withColumn("mark", F.xxhash64(F.col("vector").cast("string")))
    # -0.0 and 0.0 are equal numbers, but not equal here: such vectors are two classes with a link
    classes = rows.where("fit").groupBy("label", "mark", "vector").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("members"))
    classes = write_table(classes, "vector-classes")
    found = _class_links(classes, threshold)
    links = write_table(found, "vector-links")
    others = links.groupBy("rep", "label").agg(F.sum("others").alias("others"))
    pairs = links.select(F.explode("joins").alias("j"), "rep").select(F.col("rep").alias("a"), F.col("j").alias("b"))
    joined = write_table(components(pairs), "vector-components")
    named = (
        classes.join(others, ["rep", "label"], "left")
        .join(joined, F.col("rep") == F.col("id"), "left")
        .select(
            F.col("label").alias("l"), F.col("mark").alias("m"), F.col("vector").alias("v"),
            (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("component"),
        )
    )
    same = (F.col("label") == F.col("l")) & (F.col("mark") == F.col("m")) & (F.col("vector") == F.col("v")) & F.col("fit")
    all_rows = rows.join(named, same, "left")
    component = F.coalesce("component", "vec_id")
    return all_rows.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def _class_links(classes: DataFrame, threshold: float) -> DataFrame:
    """``rep, label, others, joins``: for a tile's queries the members linked to, and representatives to join."""
    schema = "rep long, label int, others long, joins array<long>"
    per_label = (F.count("*") / F.count_distinct("label")).cast("bigint")
    sizes = classes.groupBy(F.size("vector").alias("size")).agg(per_label.alias("n")).collect()
    made = None
    for size, n in sorted((r["size"], r["n"]) for r in sizes):
        part = _size_links(classes.where(F.size("vector") == size), size, n, threshold, schema)
        made = part if made is None else made.unionByName(part)
    return made if made is not None else classes.sparkSession.createDataFrame([], schema)


def _size_links(classes: DataFrame, size: int, n: int, threshold: float, schema: str) -> DataFrame:
    sample = classes.orderBy(F.xxhash64("mark"), "rep").limit(SAMPLE_ROWS).select("vector").toArrow().column("vector")
    index = train(_unit(sample), min(MOST_LISTS, n // LIST_VECTORS + 1))
    # a little more than the threshold needs, for rounding
    reach = math.sqrt(max(2.0 - 2.0 * threshold, 0.0)) + 1e-6
    shared = classes.sparkSession.sparkContext.broadcast(index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = _unit(batch.column("vector"))
                near = shared.value.nearest(vectors)
                codes, missed = shared.value.encode(vectors, near)
                added = [pa.array(near, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(missed)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "list", "codes", "missed"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                query, target = shared.value.probes(_unit(batch.column("vector")), reach)
                taken = batch.take(pa.array(query))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(target, pa.int32())], [*taken.schema.names, "list"])

    plain = classes.select("label", "rep", "members", "vector")
    entries = write_table(plain.mapInArrow(place, "label int, rep long, members long, vector array<double>, list int, codes binary, missed double"), "vector-entries")
    queries = plain.drop("members").mapInArrow(probe, "label int, rep long, vector array<double>, list int")
    # blocks of bounded size for lists of any length
    lists = entries.groupBy("label", "list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    deal = F.pmod(F.xxhash64("rep", "label"), F.col("blocks").cast("bigint")).cast("int")
    right = entries.join(lists, ["label", "list"]).withColumn("right", deal)
    asked = queries.join(lists, ["label", "list"]).withColumn("left", deal).withColumn("right", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = right.withColumn("left", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = ["label", "list", "left", "right"]
    tiles = asked.drop("blocks").groupBy(*keys).cogroup(right.drop("blocks").groupBy(*keys))
    return tiles.applyInPandas(_tile(shared, reach, threshold), schema)


def _tile(shared, reach: float, threshold: float):
    def link(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(entries):
            return pd.DataFrame({"rep": [], "label": [], "others": [], "joins": []})
        label, centroid = int(entries["label"].iloc[0]), int(entries["list"].iloc[0])
        codes = np.frombuffer(b"".join(entries["codes"]), np.uint8).reshape(len(entries), -1)
        limit = reach + entries["missed"].to_numpy() + 1e-7
        reps, members, asking = entries["rep"].to_numpy(), entries["members"].to_numpy(), queries["rep"].to_numpy()
        vectors, asked = _scaled(entries["vector"]), _scaled(queries["vector"])
        norms, lengths = (np.sqrt((v**2).sum(axis=1)) for v in (vectors, asked))
        near = shared.value.distances(asked / lengths[:, None], centroid, codes) <= limit
        near &= asking[:, None] != reps
        query, entry = np.nonzero(near)
        cosine = np.concatenate([_dots(asked[query[i : i + STEP]], vectors[entry[i : i + STEP]]) for i in range(0, len(query) + 1, STEP)])
        linked = cosine >= threshold * lengths[query] * norms[entry]
        query, entry = query[linked], entry[linked]
        others = np.bincount(query, members[entry], len(queries)).astype(np.int64)
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        joins: dict[int, list[int]] = {}
        for q, other in zip(query.tolist(), reps[entry].tolist()):
            a, b = top(int(asking[q])), top(other)
            if a != b:
                root[max(a, b)] = min(a, b)
                joins.setdefault(q, []).append(other)
        rows = [(int(asking[q]), label, int(others[q]), joins.get(q, [])) for q in np.flatnonzero(others).tolist()]
        return pd.DataFrame(rows, columns=["rep", "label", "others", "joins"])

    return link


#: Pairs whose exact cosines are computed at once.
STEP = 1 << 16


def _scaled(column: pd.Series) -> np.ndarray:
    """Vectors divided by their largest component, which leaves cosines as they are."""
    vectors = np.array(column.tolist(), dtype=np.float64)
    return vectors / np.abs(vectors).max(axis=1, keepdims=True)


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b)

"""Near-duplicate documents by banded MinHash and sequential Bayesian verification.

Texts become sets of word shingles. Equal sets are one class from the start. Classes that agree in a band
of their MinHash signature are candidates; they are compared in batches of signature rows, and dropped as
soon as the posterior probability of a similarity at the threshold falls below a chosen miss
probability. What is left is verified on the full sets.

Only components are wanted, so a bucket of ``n`` classes does not give ``n * n`` pairs. Each member is
first compared with the one of its bucket that shares its bands with most others: the original of many near copies is
such a one. Where a bucket still holds several components after
that, the members outside the largest one are compared, in cells of bounded bytes, with all members of other components; a
comparison that could only confirm a known component is left out. No link between components is lost.

Defined results: a null or blank text has no shingles and links with nothing; a text of fewer words than a
shingle has its whole sequence as the only one; a null id takes no part (its component is null, and it is
kept); rows of one id are one document; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionflow.llm.batches import write_large
from sessionflow.llm.components import components
from sessionflow.llm.texts import mixed, shingle_hashes, slices, word_hashes
from sessionflow.workdir import drop_table, write_table

#: A pair of similarity 0.8 shares none of 40 bands of 6 rows once in 200 000 times.
BANDS, BAND_ROWS = 40, 6
BATCH_ROWS = 30
MISS = 1e-7
#: Bytes of signatures and sets that a cell holds of outsiders and of all members of a bucket.
OUTSIDER_BYTES, MEMBER_BYTES = 12 << 20, 24 << 20
_SEEDS = np.random.default_rng(20240501).integers(1, 1 << 32, size=(2, BANDS * BAND_ROWS), dtype=np.uint32)
_SEEDS[0] |= 1


def _signatures(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The MinHash signature of each row that has shingles."""
    short = (values >> np.uint64(32)).astype(np.uint32)
    starts = (np.cumsum(counts) - counts)[counts > 0]
    found = np.empty((len(starts), BANDS * BAND_ROWS), dtype=np.uint32)
    for i, (factor, shift) in enumerate(_SEEDS.T):
        found[:, i] = np.minimum.reduceat(short * factor + shift, starts) if len(starts) else 0
    return found


def _band_keys(signatures: np.ndarray) -> np.ndarray:
    rows = signatures.reshape(len(signatures), BANDS, BAND_ROWS).astype(np.uint64)
    key = np.broadcast_to(mixed(np.arange(BANDS, dtype=np.uint64)), rows.shape[:2]).copy()
    for i in range(BAND_ROWS):
        key = mixed(key ^ rows[:, :, i])
    return key.view(np.int64)


def _text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))


SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, keys array<long>"


def _sketch(rows: DataFrame, width: int) -> DataFrame:
    """Number of shingles, a 128-bit mark of the set, and the band keys of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                values, counts = shingle_hashes(*word_hashes(data, offsets), width)
                keys = _band_keys(_signatures(values, counts)).ravel()
                lengths = np.where(counts > 0, BANDS, 0)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(keys))
                marks = [_row_sums(mixed(values ^ np.uint64(salt)), counts) for salt in (17, 4242)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), *(pa.array(m.view(np.int64)) for m in marks), lists],
                    ["doc_id", "n_shingles", "set_a", "set_b", "keys"],
                )

    return rows.mapInArrow(run, SKETCH)


def _row_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]


def _material(rows: DataFrame, width: int) -> DataFrame:
    """Signature (16 bits of each row) and full set of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                values, counts = shingle_hashes(*word_hashes(data, offsets), width)
                signatures = _signatures(values, counts).astype(np.uint16)
                ends = np.cumsum(counts)
                sets = [values[e - n : e].tobytes() for e, n in zip(ends, counts)]
                texts = iter(signatures)
                signs = [next(texts).tobytes() if n else b"" for n in counts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(signs, pa.binary()), pa.array(sets, pa.binary())], ["doc_id", "signature", "shingles"]
                )

    return rows.mapInArrow(run, "doc_id long, signature binary, shingles binary")


# --- verification --------------------------------------------------------------------------------


def least_matches(threshold: float, miss: float, batch: int = BATCH_ROWS, rows: int = BANDS * BAND_ROWS) -> list[tuple[int, int]]:
    """For each number of compared rows, the fewest matches with which a pair stays.

    With a uniform prior, the posterior probability that the similarity is at least ``t`` after ``m``
    matches in ``n`` rows is that of at most ``m`` successes in ``n + 1`` trials of probability ``t``.
    """
    found = []
    for n in range(batch, rows + 1, batch):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        found.append((n, m))
    return found


def _stay(first: np.ndarray, second: np.ndarray, steps: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of signature rows stay to the end, and their matches."""
    left = np.arange(len(first))
    matches, done = np.zeros(len(first), dtype=np.int64), 0
    for n, least in steps:
        matches[left] += (first[left, done:n] == second[left, done:n]).sum(axis=1)
        left, done = left[matches[left] >= least], n
    return left, matches[left]


def _similar(first: np.ndarray, second: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of ascending distinct values."""
    common = len(np.intersect1d(first, second, assume_unique=True))
    return 100 * common >= percent * (len(first) + len(second) - common)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), BANDS * BAND_ROWS)


def _verify(pairs: DataFrame, material: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar."""
    steps = least_matches(percent / 100, MISS)

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, _ = _stay(_matrix(batch.column("sa")), _matrix(batch.column("sb")), steps)
            yield batch.select(["a", "b"]).take(pa.array(left))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = zip(batch.column("sa"), batch.column("sb"))
            good = [_similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent) for x, y in sets]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    survivors = _with(_with(pairs, material, "signature", "a", "sa"), material, "signature", "b", "sb").mapInArrow(prune, "a long, b long")
    full = _with(_with(survivors, material, "shingles", "a", "sa"), material, "shingles", "b", "sb")
    return full.mapInArrow(confirm, "a long, b long")


def _with(pairs: DataFrame, material: DataFrame, column: str, side: str, name: str) -> DataFrame:
    return pairs.join(material.select(F.col("doc_id").alias(side), F.col(column).alias(name)), side)


def _cell_links(percent: int):
    """Links between members of different components, in a cell of outsiders and others."""
    steps = least_matches(percent / 100, MISS)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        signatures = np.frombuffer(b"".join(frame["signature"]), np.uint16).reshape(len(frame), -1)
        ids, parts = frame["doc_id"].to_numpy(), frame["part"].to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in frame["shingles"]]
        joined: dict[int, int] = {}

        def root(p: int) -> int:
            while joined.get(p, p) != p:
                p = joined[p]
            return p

        links = []
        outsider = frame["outsider"].to_numpy()
        for i in np.flatnonzero(outsider):
            left = np.flatnonzero(~outsider & (parts != parts[i]))
            matches, done = np.zeros(len(left), dtype=np.int64), 0
            for n, least in steps:
                matches += (signatures[left, done:n] == signatures[i, done:n]).sum(axis=1)
                stay = matches >= least
                left, matches, done = left[stay], matches[stay], n
            for j in left[np.argsort(-matches, kind="stable")]:
                if root(parts[i]) != root(parts[j]) and _similar(sets[i], sets[j], percent):
                    joined[root(parts[i])] = root(parts[j])
                    links.append((ids[i], ids[j]))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


# --- the operator --------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row; of a component the smallest id is kept."""
    rows = _text_rows(docs, id_col, text_col)
    sketch = write_table(_sketch(rows, width), "sketch")
    full = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"))
    buckets = write_table(_buckets(full, classes), "buckets")
    needed = buckets.select(F.col("rep").alias("doc_id")).distinct()
    material = write_large(_material(rows.join(needed, "doc_id", "left_semi"), width).dropDuplicates(["doc_id"]), "material")
    pairs = _leader_pairs(buckets)
    links = write_large(_verify(pairs, material, percent), "verified")
    links = links.unionByName(_remaining_links(buckets, components(links), material, percent))
    # classes whose smallest members are one document are one component
    found = write_table(components(links), "components")
    named = classes.join(found, classes["rep"] == found["id"], "left").select(
        F.col("set_a"), F.col("set_b"), F.coalesce("component", "rep").alias("component_id")
    )
    drop_table(material)
    joined = sketch.select("doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    kept = F.coalesce(component == F.col("doc_id"), F.lit(True))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def _buckets(full: DataFrame, classes: DataFrame) -> DataFrame:
    """``key, rep``: the classes that share a band key with another class."""
    exploded = full.select("set_a", "set_b", F.explode("keys").alias("key"))
    bounds = exploded.groupBy("key").agg(F.min("set_a").alias("lo"), F.max("set_a").alias("hi"))
    shared = bounds.where("lo <> hi").select("key")
    hits = exploded.join(shared, "key").distinct()
    return hits.join(classes, ["set_a", "set_b"]).select("key", "rep").distinct()


def _leader_pairs(buckets: DataFrame) -> DataFrame:
    """Every member of a bucket beside the one whose buckets hold most members, the smallest of equal ones."""
    sizes = buckets.groupBy("key").agg(F.count("*").alias("n"))
    reach = buckets.join(sizes, "key").groupBy("rep").agg(F.sum("n").alias("reach"))
    ranked = buckets.join(reach, "rep")
    leaders = ranked.groupBy("key").agg(F.max(F.struct("reach", (-F.col("rep")).alias("rep"))).alias("top"))
    pairs = buckets.join(leaders.select("key", (-F.col("top.rep")).alias("a")), "key").where("a <> rep")
    return pairs.select("a", F.col("rep").alias("b")).distinct()


def _remaining_links(buckets: DataFrame, found: DataFrame, material: DataFrame, percent: int) -> DataFrame:
    """Links between the components that are left in each bucket."""
    part = F.coalesce("component", "rep").alias("part")
    held = material.select(F.col("doc_id").alias("rep"), (F.octet_length("signature") + F.octet_length("shingles")).alias("bytes"))
    members = buckets.join(found, buckets["rep"] == found["id"], "left").select("key", "rep", part).join(held, "rep")
    mark = F.sum(F.xxhash64("rep").cast("decimal(38,0)"))
    sizes = members.groupBy("key", "part").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"), mark.alias("mark"))
    largest = F.max(F.struct("n", "part", "bytes"))
    open_ = sizes.groupBy("key").agg(
        largest.alias("main"), F.count("*").alias("parts"), F.sum("n").alias("size"), F.sum("bytes").alias("bytes"), F.sum("mark").alias("mark")
    ).where("parts > 1 and size > 2")
    # bands with the same members are one bucket
    distinct = open_.groupBy("size", "mark").agg(F.min(F.struct("key", "main", "bytes")).alias("k")).select("k.*")
    rights = F.ceil(F.col("bytes") / MEMBER_BYTES).cast("int")
    lefts = F.greatest(F.lit(1), F.ceil((F.col("bytes") - F.col("main.bytes")) / OUTSIDER_BYTES)).cast("int")
    left_open = distinct.select("key", F.col("main.part").alias("main"), lefts.alias("lefts"), rights.alias("rights"))
    rows = members.join(left_open, "key").withColumn("outsider", F.col("part") != F.col("main"))
    dealt = F.xxhash64("rep")
    left, right = F.pmod(dealt, "lefts").cast("int"), F.pmod(dealt, "rights").cast("int")
    outside = rows.where("outsider").withColumn("left", left).withColumn("right", F.explode(F.sequence(F.lit(0), F.col("rights") - 1)))
    taken = rows.withColumn("left", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1))).withColumn("right", right)
    cells = outside.unionByName(taken.withColumn("outsider", F.lit(False)))
    cells = cells.select("key", "left", "right", "part", "outsider", F.col("rep").alias("doc_id"))
    return cells.join(material, "doc_id").groupBy("key", "left", "right").applyInPandas(_cell_links(percent), "a long, b long")

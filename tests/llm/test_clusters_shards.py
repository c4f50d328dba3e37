"""Clustering and sharding against plain versions, and on odd rows."""

import hashlib
import math
import zlib

import numpy as np
import plain
import pytest

from sessionflow.llm import jump_shards, ptolemy_clusters


def made(seed, n, size=64):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(5, size))
    return (centres[rnd.integers(0, 5, n)] + rnd.normal(scale=0.3, size=(n, size))).astype(np.float32)


def rows_of(seed, n=150, size=64):
    rows = [(i, v.tolist()) for i, v in enumerate(made(seed, n, size))]
    rows += rows[:5] + [(1000, rows[7][1]), (None, rows[3][1])]
    odd = [None, [], [1.0] * (size - 1), [float("nan")] + [1.0] * (size - 1), [float("inf")] * size, [None] + [1.0] * (size - 1), [0.0] * size, [-0.0] * size]
    return rows + [(2000 + i, v) for i, v in enumerate(odd)]


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", "x") for r in rows], "vec_id long, embedding array<float>, cluster string, vector string").repartition(3)
    return ptolemy_clusters.clusters(frame, **options)


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("seed, k, huge", [(1, 16, []), (2, 3, []), (3, 4, [1e30]), (4, 16, [1e30, -3e38, 1e7])])
def test_clusters(spark, seed, k, huge):
    rows = rows_of(seed) + [(3000 + i, [x] * 64) for i, x in enumerate(huge)]
    got = found(spark, rows, k=k).collect()
    floats = [(i, [None if x is None else float(np.float32(x)) for x in v] if v is not None else None) for i, v in rows]
    want = plain.clustered(floats, k, 3, 64, 64.0)
    most = (1 << 63) - 1
    assert ordered((r["vec_id"], r["cluster"], r["distance"], r["centroid"]) for r in got) == ordered((i, c, d if d <= most else None, w) for i, c, d, w in want)
    sums = {}
    for _, c, d, _ in want:
        sums[c] = sums.get(c, 0) + d
    fits = lambda x: x if x <= most else None
    for r in got:
        assert r["cluster_inertia"] == fits(sums[r["cluster"]])
        assert r["inertia"] == fits(sum(sums.values()))


def test_fewer_vectors_than_centroids_and_none(spark):
    got = found(spark, [(1, [0.5] * 64), (2, [0.25] * 64)], k=16).collect()
    assert {(r["cluster"], r["distance"]) for r in got} == {(0, 0), (1, 0)}
    empty = found(spark, [(1, None)], k=16)
    assert empty.collect() == [] and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]


def test_equal_vectors_go_to_the_first_centroid(spark):
    got = found(spark, [(i, [1.0] * 64) for i in range(40)], k=4).collect()
    assert {(r["cluster"], r["distance"], r["inertia"]) for r in got} == {(0, 0, 0)}


def test_bounds_hold_and_spare_distances():
    values = np.floor(made(9, 3000) * 64)
    pivots = ptolemy_clusters._far_apart([[int(x) for x in v] for v in values[:64]], 6)
    centroids = ptolemy_clusters.Centroids([[int(x) for x in v] for v in values[:16]], pivots)
    to_pivots = ptolemy_clusters._lengths(values[:, None, :] - pivots[None])
    exact = np.sqrt(((values[:, None, :] - centroids.values[None]) ** 2).sum(axis=2))
    lower = centroids.bounds(to_pivots)
    assert (lower <= exact).all() and (lower > 0).mean() > 0.9
    clusters, squares, computed = centroids.nearest(values, to_pivots)
    assert (clusters == (exact**2).round().argmin(axis=1)).all()
    assert computed < 0.9 * exact.size


# --- sharding ------------------------------------------------------------------------------------

TEXTS = [None, "", "a", "été 世界", "x" * 100_000]


@pytest.fixture
def docs(spark):
    rows = [(i, TEXTS[i % 5], "x", "x") for i in range(400)] + [(7, "again", "x", "x"), (7, "again", "x", "x"), (None, "no id", "x", "x"), (None, None, "x", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, shard_no string, prefix string").repartition(3)


def check(got, shards):
    slots = {}
    for r in got:
        data = (r["text"] or "").encode()
        digest = hashlib.md5(("" if r["doc_id"] is None else str(r["doc_id"])).encode()).hexdigest()
        key = int(digest[:15], 16)
        assert (r["shard_hash"], r["shard_size"], r["shard_crc32"]) == (key, len(data) + 8, zlib.crc32(data))
        assert (r["shard_no"], r["shard_grown"]) == (plain.jump_hash(key, shards), plain.jump_hash(key, shards + 1))
        assert r["shard_grown"] in (r["shard_no"], shards)
        slots.setdefault(r["shard_no"], []).append(r["shard_slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("shards", [1, 2, 24, 1000])
def test_shards(docs, shards):
    got = jump_shards.shard_rows(docs, shards).collect()
    assert len(got) == docs.count()
    check(got, shards)
    order = sorted(got, key=lambda r: (r["shard_no"], r["shard_slot"]))
    keys = [(r["shard_no"], r["shard_hash"], r["shard_size"], r["shard_crc32"]) for r in order]
    assert keys == sorted(keys)


def test_a_hot_id_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(jump_shards, "CHUNK_ROWS", 8)
    monkeypatch.setattr(jump_shards, "SMALL_ROWS", 10)
    rows = [(i if i % 3 else 5, f"text {i % 7}") for i in range(600)]
    check(jump_shards.shard_rows(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3).collect(), 3)


def test_empty_table_and_files(spark, docs, tmp_path):
    empty = jump_shards.shard_rows(docs.limit(0), 24)
    assert empty.collect() == [] and empty.columns[:3] == ["doc_id", "text", "prefix"]
    sharded = jump_shards.shard_rows(docs, 5)
    manifest = {r["shard_no"]: r for r in jump_shards.write_shards(sharded, f"{tmp_path}/shards").collect()}
    assert sum(r["rows"] for r in manifest.values()) == docs.count()
    for shard, r in manifest.items():
        held = spark.read.parquet(f"{tmp_path}/shards/shard_no={shard}").collect()
        assert (len(held), sum(x["shard_size"] for x in held)) == (r["rows"], r["bytes"])


def test_jumps_spread_and_move_little():
    keys = np.random.default_rng(3).integers(0, 1 << 60, 100_000)
    before, after = jump_shards.jump(keys, 24), jump_shards.jump(keys, 25)
    counts = np.bincount(before, minlength=24)
    assert counts.min() > 0.9 * len(keys) / 24 and counts.max() < 1.1 * len(keys) / 24
    assert set(after[after != before]) == {24} and math.isclose((after != before).mean(), 1 / 25, rel_tol=0.05)

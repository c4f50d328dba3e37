"""Vector operators against brute force, and on odd rows."""

import math

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from sessionflow.llm import block_search, vector_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string, rep string, list string"


def vectors(seed, n=240, size=12):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(6, size))
    made = centres[rnd.integers(0, 6, n)] + rnd.normal(scale=rnd.choice([0.02, 0.2, 1.0], (n, 1)), size=(n, size))
    made[20:40] = made[0]  # copies, which also tie
    return made.astype(np.float32)


@pytest.fixture(scope="module", params=[1, 2])
def rows(request):
    found = [(i, v.tolist(), i % 3 if i % 11 else None) for i, v in enumerate(vectors(request.param))]
    odd = [None, [0.0] * 12, [float("nan")] + [1.0] * 11, [float("inf")] + [1.0] * 11, [None] + [1.0] * 11, [], [1.0] * 5, [2.0] * 5]
    return found + [(1000 + i, v, 0) for i, v in enumerate(odd)] + [(2000, [1e-30] * 12, 0), (2001, [1e30] * 12, 0)]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)


def test_nearest(spark, rows):
    found = {}
    for r in block_search.nearest(frame(spark, rows), F.col("vec_id") % 10 == 0, query_block=7, row_block=50).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    fit = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows if usable(v)}
    wanted = {}
    for q, x in fit.items():
        if q % 10 == 0:
            near = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in fit.items() if i != q and len(y) == len(x))[:10]
            wanted[q] = [(k + 1, i, d) for k, (d, i) in enumerate(near)]
    assert set(found) == {q for q, w in wanted.items() if w}
    for q, w in wanted.items():
        got = sorted(found.get(q, []))
        assert [(k, i) for k, i, _ in got] == [(k, i) for k, i, _ in w]
        assert all(math.isclose(a[2], b[2], rel_tol=1e-12, abs_tol=1e-12) for a, b in zip(got, w))


def test_near_duplicates(spark, rows, monkeypatch):
    monkeypatch.setattr(vector_dedup, "BLOCK", 16)
    found = {r["vec_id"]: r for r in vector_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert len(found) == len(rows)
    fit = [(i, np.array(v, np.float32).astype(float), l) for i, v, l in rows if usable(v) and l is not None]
    links = []
    for n, (i, x, a) in enumerate(fit):
        for j, y, b in fit[:n]:
            if a == b and len(x) == len(y):
                u, v = x / np.abs(x).max(), y / np.abs(y).max()
                if u @ v / math.sqrt(u @ u) / math.sqrt(v @ v) >= 0.98:
                    links.append((j, i))
    component = plain.roots([r[0] for r in rows], links)
    for i in found:
        n = sum(i in p for p in links)
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (n, component[i], component[i] == i)


def test_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert block_search.nearest(empty, F.col("vec_id") % 10 == 0).collect() == []
    assert vector_dedup.near_duplicates(empty).collect() == []
    alone = spark.createDataFrame([(None, [1.0], 1), (100, [1.0], None)], "vec_id long, embedding array<float>, label int")
    assert {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in vector_dedup.near_duplicates(alone).collect()} == {(None, 0, None, True), (100, 0, 100, True)}
    assert block_search.nearest(alone, F.col("vec_id") % 10 == 0).collect() == []


def test_quantised_distances_bound_the_true_ones():
    rnd = np.random.default_rng(4)
    sample = rnd.normal(size=(500, 16))
    index = vector_dedup.train(sample, 10)
    near = index.nearest(sample)
    codes, missed = index.encode(sample, near)
    for centroid in range(3):
        inside = np.flatnonzero(near == centroid)
        about = index.distances(sample[:5], centroid, codes[inside])
        true = np.sqrt(((sample[inside] - sample[:5, None]) ** 2).sum(axis=2))
        assert (np.abs(about - true) <= missed[inside] + 1e-9).all()


def test_probes_reach_all_neighbours():
    rnd = np.random.default_rng(6)
    sample = rnd.normal(size=(800, 6))
    index, reach = vector_dedup.train(sample, 25), 0.8
    near = index.nearest(sample)
    probed = np.zeros((len(sample), 25), bool)
    probed[index.probes(sample, reach)] = True
    assert probed.mean() < 0.8
    close = np.sqrt(((sample[:, None] - sample) ** 2).sum(axis=2)) <= reach
    for i, j in zip(*np.nonzero(close)):
        assert probed[i, near[j]]

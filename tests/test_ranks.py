"""The middle of a column, and the halves of the events that it makes."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sessionflow.plans import ranks


@pytest.mark.parametrize("seed, bits", [(1, 9), (2, 12)])
def test_the_lower_median_against_a_sorted_list(spark, seed, bits, monkeypatch):
    monkeypatch.setattr(ranks, "BITS", bits)
    rnd = random.Random(seed)
    top = (1 << 63) - 1
    for values in (
        [rnd.randint(-400, 400) for _ in range(20)],
        [rnd.choice([-top - 1, -7, 0, 7, top]) for _ in range(9)],
        [rnd.randint(-top, top) for _ in range(10)],
        [5, 5, 5, 6],
        [3],
        [],
    ):
        nulls = [None] * rnd.randint(0, 9)
        rows = [(v,) for v in rnd.sample([*values, *nulls], len(values) + len(nulls))]
        want = sorted(values)[(len(values) - 1) // 2] if values else None
        assert ranks.lower_median(spark.createDataFrame(rows, "v bigint"), "v") == want


@pytest.mark.parametrize("ids", [[4, 9, 1, 7, 2], [1, 2, 2, 2, 8, 9], [3, None, 5, 4, None, 8], [None, None]])
def test_recorded_and_live_halves_without_a_gathered_median(spark, tmp_path, monkeypatch, ids):
    """``F.median`` keeps all values in one task."""
    rows = [(e, i % 2, "a", f"2024-01-01 00:00:{i:02}") for i, e in enumerate(ids)]
    events = spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string, t string")
    events.select("event_id", "user_id", "event_type", F.col("t").cast("timestamp_ntz").alias("ts")).write.parquet(f"{tmp_path}/events.parquet")
    half = events.agg(F.median("event_id")).first()[0]
    late = [e for e in ids if e is None or half is None or e > half]

    def gathered(*_):
        raise AssertionError("all values in one task")

    monkeypatch.setattr(F, "median", gathered)
    monkeypatch.setattr(entry, "shared_dir", lambda _, name: f"{tmp_path}/{name}")
    entry._paced_vehicles(spark, str(tmp_path), "halves", backlog=True)

    def found(part):
        lines = spark.read.schema("value string").text(f"{tmp_path}/halves-lines/{part}")
        return sorted((r[0] for r in lines.select(F.get_json_object("value", "$.mileage").cast("bigint")).collect()), key=str)

    assert found("live") == sorted(late, key=str)
    assert found("recorded") == sorted([e for e in ids if e not in late], key=str)

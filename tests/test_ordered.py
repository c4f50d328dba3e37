"""Trips by an interval map: any cut into micro-batches gives the trips of the table."""

import random

import pytest
from helpers import line_stream, rows, vehicle
from pyspark.sql import functions as F

from sessionflow.functions import parsing
from sessionflow.operators import trips as tables
from sessionflow.streaming import ordered
from sessionflow.streaming.runner import run_available_now


def test_joined_against_a_loop():
    rnd = random.Random(4)
    for _ in range(200):
        gap = rnd.choice([0, 3, 10])
        points = [(rnd.randint(0, 80), rnd.randint(0, 3), rnd.randint(0, 9)) for _ in range(rnd.randint(1, 25))]
        want = []
        for t, o, m in sorted(points):
            if want and t - want[-1][3] <= gap:
                want[-1] = [*want[-1][:3], t, o, m, want[-1][6] + 1]
            else:
                want.append([t, o, m, t, o, m, 1])
        parts = [(t, o, m, t, o, m, 1) for t, o, m in points]
        rnd.shuffle(parts)
        found = []
        while parts:
            n = rnd.randint(1, len(parts))
            found, parts = ordered.joined([*found, *parts[:n]], gap), parts[n:]
        assert [(i[0], i[3], i[6]) for i in found] == [(w[0], w[3], w[6]) for w in want]
        assert [(i[1:2], i[4:5]) for i in found] == [(tuple(w[1:2]), tuple(w[4:5])) for w in want]


@pytest.mark.parametrize("seed, pre_aggregate", [(1, False), (2, True)])
def test_any_cut_equals_the_table(spark, tmp_path, seed, pre_aggregate):
    """Rows up to four minutes out of order, which is within the watermark."""
    rnd = random.Random(seed)
    signals = []
    for key in "ABC":
        now = 0
        for i in range(60):
            now += rnd.choice([1, 5, 20, 30, 31, 60, 200])
            signals.append((now + rnd.randint(-120, 120), key, now, i))
    signals.sort(key=lambda s: s[0])
    lines = [vehicle(key, at, i) for _, key, at, i in signals]
    cuts = sorted(rnd.sample(range(1, len(lines)), 5))
    batches = [lines[a:b] for a, b in zip([0, *cuts], [*cuts, len(lines)])]
    table = parsing.valid(parsing.parse_vehicle(spark.createDataFrame([(x,) for x in lines], "value string")))
    want = rows(tables.trips(table, tiebreak="mileage").drop("isTripEnded"))
    stream = parsing.valid(parsing.parse_vehicle(line_stream(spark, batches)))
    found = ordered.trips(stream, tiebreak="mileage", pre_aggregate=pre_aggregate)
    closed = run_available_now(found, "ordered", "append", str(tmp_path)).drop("batch_id")
    running = ordered.open_trips(spark, f"{tmp_path}/checkpoint")
    assert rows(closed.unionByName(running).drop("isTripEnded")) == want
    assert {r["isTripEnded"] for r in closed.collect()} == {True} and 0 < running.count() < len(want)
    earlier = ordered.open_trips(spark, f"{tmp_path}/checkpoint", batch_id=0)
    assert earlier.count() > 0


def test_calls_to_the_state_follow_buckets_not_keys(spark, tmp_path):
    lines = [vehicle(f"v{i % 90}", i, i) for i in range(180)]
    stream = parsing.valid(parsing.parse_vehicle(line_stream(spark, [lines[:100], lines[100:]])))
    closed = run_available_now(ordered.trips(stream, tiebreak="mileage", buckets=7), "ordered-buckets", "append", str(tmp_path)).drop("batch_id")
    running = ordered.open_trips(spark, f"{tmp_path}/checkpoint")
    table = parsing.valid(parsing.parse_vehicle(spark.createDataFrame([(x,) for x in lines], "value string")))
    want = rows(tables.trips(table, tiebreak="mileage").drop("isTripEnded"))
    assert rows(closed.unionByName(running).drop("isTripEnded")) == want
    timers = spark.read.format("statestore").option("path", f"{tmp_path}/checkpoint").option("stateVarName", "timer").load()
    assert timers.count() <= 7


def test_keys_of_any_type_and_nulls_come_back_as_they_were(spark, tmp_path):
    names = ["1", "2", "x", "9007199254740993"]
    lines = [vehicle(names[i % 4], i * 7, i) for i in range(40)]
    at = F.timestamp_micros(F.col("num") + 1)
    keys = dict(num=F.expr("try_cast(vin as bigint)"), at=at, d=F.col("num") / 3, b=F.col("vin").cast("binary"), a=F.array("vin"))

    def keyed(df):
        return parsing.valid(parsing.parse_vehicle(df)).withColumn("num", keys["num"]).withColumns({k: v for k, v in keys.items() if k != "num"})

    found = ordered.trips(keyed(line_stream(spark, [lines[:15], lines[15:]])), list(keys), tiebreak="mileage")
    closed = run_available_now(found, "ordered-keys", "append", str(tmp_path)).drop("batch_id")
    running = ordered.open_trips(spark, f"{tmp_path}/checkpoint", list(keys))
    want = tables.trips(keyed(spark.createDataFrame([(x,) for x in lines], "value string")), list(keys), tiebreak="mileage")
    assert [f.dataType for f in running.schema] == [f.dataType for f in want.schema]
    assert rows(closed.unionByName(running).drop("isTripEnded")) == rows(want.drop("isTripEnded"))

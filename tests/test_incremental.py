"""Trips added partition by partition against the whole table."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from sessionflow.operators import incremental, trips

SCHEMA = "k string, t long, m long"


def frame(spark, signals):
    return spark.createDataFrame(signals, SCHEMA).withColumn("ts", F.timestamp_millis("t"))


@pytest.mark.parametrize("seed", [1, 2])
def test_partitions_equal_the_table(spark, tmp_path, seed):
    rnd, signals = random.Random(seed), []
    for key in ["a", "b", "c", None]:
        now = rnd.randint(0, 50_000)
        for i in range(rnd.choice([1, 40, 80])):
            signals.append((key, now, i))
            now += rnd.choice([1000, 30_000, 30_001, 400_000])
    cuts = [0, 300_000, 310_000, 2_000_000, 4_000_000, 1 << 60]
    folder = str(tmp_path)
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        part = frame(spark, [s for s in signals if a <= s[1] < b])
        for _ in range(1 + i % 2):  # adding a partition again changes nothing
            incremental.add_partition(part, folder, i, "k", "ts", "m", "m")
        table = frame(spark, [s for s in signals if s[1] < b])
        want = rows(trips.trips(table, "k", "ts", "m", "m"))
        assert rows(incremental.stored_trips(table, folder, i, "k", "m")) == want


def test_a_partition_that_reaches_back_is_refused(spark, tmp_path):
    incremental.add_partition(frame(spark, [("a", 100_000, 1)]), str(tmp_path), 0, "k", "ts", "m", "m")
    with pytest.raises(Exception, match="begins before the stored islands end"):
        incremental.add_partition(frame(spark, [("a", 90_000, 2)]), str(tmp_path), 1, "k", "ts", "m", "m")

"""The table of current values after several micro-batches, repeated ones and crashes."""

import pytest
from helpers import line_stream, rows

from sessionflow.functions import parsing
from sessionflow.streaming import native, upsert
from sessionflow.streaming.runner import start

SCHEMA = "k string, kind string, n long"


def held(spark, table):
    schema = spark.createDataFrame([], SCHEMA).schema
    return rows(upsert.current(spark, table, schema))


def test_newest_rows_count_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "table")
    batches = [
        [("a", "x", 1), ("b", "x", 2), (None, "x", 1)],
        [("a", "x", 3), ("c", "y", 1), ("c", "y", 2)],
        [("b", "x", 5), (None, "x", 4)],
    ]
    want = {}
    assert held(spark, table) == []
    for i, batch in enumerate(batches):
        frame = spark.createDataFrame(batch, SCHEMA)
        for _ in range(2):
            upsert.merge(frame, i, ["k", "kind"], table, buckets=4)
        for k, kind, n in batch:
            want[k, kind] = n
        assert held(spark, table) == sorted(((*k, n) for k, n in want.items()), key=repr)


def test_a_crash_before_the_names_are_replaced(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "table")
    upsert.merge(spark.createDataFrame([("a", "x", 1)], SCHEMA), 0, ["k", "kind"], table)
    replace = upsert._replace

    def crash(*_):
        raise OSError("crash")

    monkeypatch.setattr(upsert, "_replace", crash)
    more = spark.createDataFrame([("a", "x", 2), ("b", "x", 1)], SCHEMA)
    with pytest.raises(OSError, match="crash"):
        upsert.merge(more, 1, ["k", "kind"], table)
    assert held(spark, table) == [("a", "x", 1)]
    monkeypatch.setattr(upsert, "_replace", replace)
    upsert.merge(more, 1, ["k", "kind"], table)
    assert held(spark, table) == [("a", "x", 2), ("b", "x", 1)]


def test_only_touched_folders_are_written_anew(spark, tmp_path):
    table = str(tmp_path / "table")
    upsert.merge(spark.createDataFrame([(str(i), "x", 1) for i in range(40)], SCHEMA), 0, ["k", "kind"], table, buckets=8)
    before = upsert._names(spark, table)["folders"]
    upsert.merge(spark.createDataFrame([("7", "x", 2)], SCHEMA), 1, ["k", "kind"], table, buckets=8)
    after = upsert._names(spark, table)["folders"]
    assert sum(before[b] != after[b] for b in before) == 1
    assert len(held(spark, table)) == 40


def test_counts_of_a_stream(spark, tmp_path):
    def event(user, kind, second):
        return f"{{'userId':'{user}','eventType':'{kind}','eventTime':'2024-01-01 00:00:{second:02d}'}}"

    batches = [[event("a", "click", 1), event("b", "click", 2)], [event("a", "click", 3)], [event("a", "view", 4), event("b", "click", 5)]]
    counts = native.pv_counts(parsing.valid(parsing.parse_user_event(line_stream(spark, batches))))
    table = str(tmp_path / "table")
    writer = upsert.upsert(counts, ["userId", "eventType"], table, str(tmp_path / "checkpoint"), trigger={"availableNow": True})
    start(writer, spark).awaitTermination()
    assert rows(upsert.current(spark, table, counts.schema)) == [("a", "click", 2), ("a", "view", 1), ("b", "click", 2)]
    assert upsert._names(spark, table)["batch_id"] == 2

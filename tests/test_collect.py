"""Sessions in a list state: appended, closed and expired, by calls and on Spark."""

import time

import pytest
from helpers import write_files
from pyspark.sql import Row

from sessionflow.functions import parsing
from sessionflow.sources.lines import text_stream
from sessionflow.streaming import collect, runner, sinks
from sessionflow.streaming.runner import run_available_now

EVENT = "greet string"


class FakeHandle:
    """One key of a state store."""

    def __init__(self):
        self.lists, self.values, self.timers, self.writes = {}, {}, set(), 0

    def getListState(self, name, schema):
        return FakeList(self, name)

    def getValueState(self, name, schema):
        return FakeValue(self, name)

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class FakeList:
    def __init__(self, handle, name):
        self.handle, self.name = handle, name

    def get(self):
        yield from self.handle.lists.get(self.name, [])

    def appendList(self, values):
        self.handle.lists.setdefault(self.name, []).extend(values)
        self.handle.writes += len(values)

    def clear(self):
        self.handle.lists.pop(self.name, None)


class FakeValue:
    def __init__(self, handle, name):
        self.handle, self.name = handle, name

    def exists(self):
        return self.name in self.handle.values

    def get(self):
        return self.handle.values[self.name]

    def update(self, value):
        self.handle.values[self.name] = value

    def clear(self):
        self.handle.values.pop(self.name, None)


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def processor(listed=True, emit=False):
    columns = ["id", "userEvents"] if listed else ["id", "part", "order", "event"]
    found, handle = collect.Sessions(None, columns, 30_000, emit, listed), FakeHandle()
    found.init(handle)
    return found, handle


def event_rows(*items):
    return iter([Row(_item=g, _closes=c, _order=o) for g, c, o in items])


@pytest.mark.parametrize("emit", [False, True])
def test_a_silent_key_expires(emit):
    found, handle = processor(emit=emit)
    assert list(found.handleInputRows((1,), event_rows(("a", False, None)), Clock(1000))) == []
    assert list(found.handleInputRows((1,), event_rows(("b", False, None)), Clock(9000))) == []
    assert handle.timers == {39_000}
    out = list(found.handleExpiredTimer((1,), Clock(40_000), None))
    assert [r["userEvents"] for r in out] == ([["a", "b"]] if emit else [])
    assert handle.lists == handle.values == {}


def test_events_are_written_once_and_closed_with_the_batch(monkeypatch):
    monkeypatch.setattr(collect, "APPENDED", 3)
    found, handle = processor(listed=False)
    for batch in range(20):
        list(found.handleInputRows((1,), event_rows(*[(f"{batch}-{i}", False, -i) for i in range(4)]), Clock(batch)))
    assert handle.writes == 80 and handle.timers == {30_019}
    out = list(found.handleInputRows((1,), event_rows(("x", True, 5), ("y", True, None), ("z", False, 1)), Clock(99)))
    assert [(r["part"], r["order"], r["event"]) for r in out][-4:] == [(19, -3, "19-3"), (20, 5, "x"), (20, None, "y"), (20, 1, "z")]
    assert len(out) == 83 and not (handle.lists or handle.values or handle.timers)


def test_an_array_is_in_order_within_a_batch(monkeypatch):
    for appended in (2, 100):
        monkeypatch.setattr(collect, "APPENDED", appended)
        found, handle = processor()
        list(found.handleInputRows((1,), event_rows(("b", False, 9), ("a", False, 3)), Clock(0)))
        [out] = found.handleInputRows((1,), event_rows(("n", False, None), ("d", True, 2), ("c", False, 1)), Clock(1))
        assert out["userEvents"] == ["a", "b", "c", "d", "n"]
        assert not (handle.lists or handle.values or handle.timers)


def line(key, greet, last, seq):
    return f"{{'id':{key},'greet':'{greet}','isLast':{str(last).lower()},'seq':{seq}}}"


def test_event_rows_make_the_same_sessions_as_arrays(spark, tmp_path):
    batches = [
        [line(1, "b", False, 2), line(1, "a", False, 1), line(2, "x", False, 1)],
        [line(1, "c", True, 4), line(1, "d", False, 3), line(2, "y", False, 2)],
        [line(1, "e", True, 5), line(2, "z", True, 3)],
    ]
    write_files(str(tmp_path), batches)
    events = parsing.valid(parsing.parse_session_event(text_stream(spark, str(tmp_path), 1), order="seq"))
    by_event = run_available_now(collect.closed_session_events(events, order="seq"), "by-event", timeouts=False)
    arrays = run_available_now(collect.complete_sessions(events, order="seq"), "arrays", timeouts=False)
    want = {(1, 1): "abdc", (1, 2): "e", (2, 2): "xyz"}
    for found in (collect.listed_sessions(by_event), arrays):
        assert {(r["id"], r["batch_id"]): "".join(e["greet"] for e in r["userEvents"]) for r in found.collect()} == want


def test_expiry_by_the_real_clock(spark, tmp_path):
    """A key without new events loses its open session while the query runs on, whatever other keys send."""
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    events = parsing.valid(parsing.parse_session_event(text_stream(spark, str(source), 1)))
    found = collect.closed_session_events(events, timeout_ms=1500, emit_on_timeout=True)
    writer = sinks.parquet(found, str(out), str(tmp_path / "checkpoint"), trigger={"processingTime": "200 milliseconds"})
    query = runner.start(writer, spark)
    try:
        write_files(str(source), [[line(1, "a", False, 1), line(1, "b", False, 2)]])
        deadline = time.time() + 60
        while sinks.read_batches(spark, str(out), found.schema).count() < 2 and time.time() < deadline:
            time.sleep(0.5)
        write_files(str(source), [[line(1, "c", True, 3)]], first=1)
        while sinks.read_batches(spark, str(out), found.schema).count() < 3 and time.time() < deadline:
            time.sleep(0.5)
    finally:
        query.stop()
    rows = sinks.read_batches(spark, str(out), found.schema).orderBy("batch_id").collect()
    assert [sorted(r["event"]["greet"] for r in rows if r["batch_id"] == b) for b in sorted({r["batch_id"] for r in rows})] == [["a", "b"], ["c"]]

"""Late rows, leaping clocks and backlogs over several micro-batches."""

import pytest
from helpers import BASE_S, ms, rows, vehicle, write_files
from test_stream_random import GAP, batches_of, fold_count, fold_span, fold_status, late_rows, line_stream, seconds, simulate

from sessionflow.functions import parsing
from sessionflow.operators import sessions
from sessionflow.sources.lines import text_stream, with_backlog
from sessionflow.streaming import cells, late, native, runner, stateful
from sessionflow.streaming.runner import run_available_now


def cell_end(width_ms):
    return lambda t: ((ms(t) // width_ms + 1) * width_ms - 1) / 1000 - BASE_S


def signals_of(spark, batches, partitions):
    lines = [[vehicle(v, t) for v, t in b] for b in batches]
    return parsing.valid(parsing.parse_vehicle(line_stream(spark, lines))).repartition(partitions)


@pytest.mark.parametrize("seed, partitions, held", [(1, 1, 1), (1, 7, 262_144), (3, 2, 7), (5, 7, 1)])
def test_lateness_does_not_depend_on_the_layout(spark, monkeypatch, seed, partitions, held):
    monkeypatch.setattr(cells, "ROWS_PER_REDUCTION", held)
    batches = batches_of(seed, 900)
    assert late_rows(batches)
    ended = lambda s, now: [(s[0], s[1], True)]

    found = run_available_now(stateful.trip_status(signals_of(spark, batches, partitions), pre_aggregate=True), "late")
    status = rows(found.select("batch_id", "vin", seconds("tripStartTime"), seconds("tripEndTime"), "isTripEnded"))
    assert status == simulate(batches, fold_status, ended, cell_end(GAP * 1000 + 1))

    found = run_available_now(stateful.pv_counts_expiring(signals_of(spark, batches, partitions), ["vin"], "createTime", pre_aggregate=True), "late")
    counted = rows(found.select("batch_id", "vin", "eventCount"))
    assert counted == simulate(batches, fold_count, lambda s, now: [], cell_end(stateful.CELL_MS))


def test_span_whose_deadline_has_passed(spark):
    """The watermark of the batch before lets bob in; the one of now is beyond the end of his span."""
    hour = 3600
    batches = [[("mike", hour)], [("eve", 10 * hour)], [("bob", 1.5 * hour), ("eve", 10 * hour + 60)], [("eve", 10 * hour + 120)]]
    for pre_aggregate in (True, False):
        spans = stateful.activity_span(signals_of(spark, batches, 2), "vin", "createTime", pre_aggregate=pre_aggregate)
        found = run_available_now(spans, "leap")
        bob = [r["expired"] for r in found.where("vin = 'bob'").orderBy("expired").collect()]
        assert bob == [False, True]


def test_backlog_is_read_before_live_lines(spark, tmp_path):
    recorded = [[vehicle("A", 1000 * i, i)] for i in range(8)]
    live = [[vehicle("A", 1_000_000 + 1000 * i, 8 + i)] for i in range(8)]
    for name, files, first in (("recorded", recorded, 0), ("live", live, 8)):
        (tmp_path / name).mkdir()
        write_files(tmp_path / name, files, first)
    both = with_backlog(spark, f"{tmp_path}/recorded", f"{tmp_path}/live", 1)
    trips = native.trips(parsing.valid(parsing.parse_vehicle(both)))
    assert run_available_now(trips, "backlog", "complete").count() == 16


def test_sessions_refuse_rows_without_order_and_keep_null_keys(spark):
    schema = "k string, o long, last boolean"
    found = sessions.closed_session_events(spark.createDataFrame([(None, 1, False), (None, 2, True)], schema), "k", "o", "last")
    assert rows(found.select("k", "o", "sessionNo")) == [(None, 1, 0), (None, 2, 0)]
    bad = spark.createDataFrame([("a", None, True)], schema)
    with pytest.raises(Exception, match="an event has no o"):
        sessions.closed_session_events(bad, "k", "o", "last").collect()


def test_late_rows_are_an_output(spark, tmp_path):
    """What is in time and what is late make all rows; the state sees the rows in time, as it does without the split."""
    batches = [
        [vehicle("A", 0, 1), vehicle("A", 1000, 2)],
        [vehicle("B", 600, 3), vehicle("A", 700, 4), vehicle("A", 701, 5), vehicle("A", 1010, 6)],
        [vehicle("B", 2000, 7)],
        [vehicle("A", 1500, 8), vehicle("B", 1700, 9), vehicle("C", 1701, 10)],
    ]
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    write_files(str(source), batches)
    signals = parsing.valid(parsing.parse_vehicle(text_stream(spark, str(source), 1)))
    writer = late.split(signals, "createTime", 300_000, out, str(tmp_path / "checkpoint"), {"availableNow": True})
    runner.start(writer, spark).awaitTermination()
    missed = late.late_rows(spark, out, signals.schema)
    got = {(r["mileage"], r["watermark_ms"] // 1000 - BASE_S) for r in missed.collect()}
    assert got == {(3, 700), (4, 700), (8, 1700), (9, 1700)}
    kept = late.in_time(spark, out, signals.schema)
    assert sorted(r["mileage"] for r in kept.collect()) == [1, 2, 5, 6, 7, 10]
    # the marks are kept: a micro-batch that runs again is split as before
    assert late._mark(spark, out, 0) == (BASE_S + 700) * 1000 and late._mark(spark, out, 3) == (BASE_S + 1700) * 1000

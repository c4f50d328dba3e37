"""Streaming operators over several micro-batches, one file each."""

import random
import tempfile
from datetime import datetime, timedelta, timezone

import pytest
from helpers import BASE_S, DRIVEN, drive_lines, line_stream, ms, rows, split_by_gaps, vehicle, write_files
from pyspark.sql import functions as F

from sessionflow.functions import parsing
from sessionflow.sources.lines import text_stream
from sessionflow.streaming import cells, collect, jobs, native, runner, sinks
from sessionflow.streaming.runner import run_available_now


def trip_rows(result, *columns):
    """(batch, key, start s, end s, ...) relative to the base."""
    second = [((F.col(c) / 1000).cast("bigint") - BASE_S) for c in ("tripStartTime", "tripEndTime")]
    return rows(result.select("batch_id", "vin", *second, *columns))


def test_recorded_drives(spark):
    result = run_available_now(jobs.trips(line_stream(spark, [drive_lines(["92", "15"])])), "t")
    ended = [(b, v, *d, True) for b, ds in ((0, DRIVEN[:2]), (1, DRIVEN[2:])) for v in ("15", "92") for d in ds]
    assert rows(result.select("batch_id", *result.columns[:-1])) == ended


def test_recorded_drives_with_status(spark):
    result = run_available_now(jobs.trip_status(line_stream(spark, [drive_lines(["92"])])), "t")
    got = rows(result.select("batch_id", *result.columns[:-1]))
    progress = (0, "92", *DRIVEN[2], False)
    assert got == [(0, "92", *DRIVEN[0], True), (0, "92", *DRIVEN[1], True), progress, (1, "92", *DRIVEN[2], True)]


@pytest.mark.parametrize("pre_aggregate", [True, False])
def test_timeout_splits_trips_and_late_rows_are_dropped(spark, pre_aggregate):
    batches = [
        [vehicle("A", 0), vehicle("B", 0)],
        [vehicle("A", 15), vehicle("B", 15)],
        [vehicle("B", 16)],
        [vehicle("A", 20), vehicle("B", 20)],
        [vehicle("B", 21)],
        [vehicle("A", -400)],
        [vehicle("B", 22)],
    ]
    found = jobs.trips(line_stream(spark, batches), pre_aggregate=pre_aggregate)
    assert trip_rows(run_available_now(found, "t")) == [(2, "A", 0, 15)]


def test_late_rows_are_reported(spark, tmp_path):
    found = jobs.trips(line_stream(spark, [[vehicle("A", 0)], [vehicle("A", 1)], [vehicle("A", -400)]]))
    writer = sinks.parquet(found, f"{tmp_path}/out", f"{tmp_path}/checkpoint", trigger={"availableNow": True})
    query = runner.start(writer, spark)
    query.awaitTermination()
    assert sinks.late_rows(query) == 1


@pytest.mark.parametrize("recede", [False, True])
def test_rows_behind_the_end(spark, recede):
    """The second batch lies behind the first; the third is 25 s after the end, 45 s after the second."""
    batches = [
        [vehicle("A", 0, 1), vehicle("A", 20, 5)],
        [vehicle("A", 0, 2), vehicle("A", 1, 3)],
        [vehicle("A", 45, 9)],
        [vehicle("B", 45)],
    ]
    found = jobs.trips(line_stream(spark, batches), timeout_ms=10**13, end_may_recede=recede)
    got = trip_rows(run_available_now(found, "t"), "startMileage", "endMileage")
    # With an end of 1 s the third batch opens a trip.
    assert got == ([(2, "A", 0, 1, 1, 3)] if recede else [])


def test_progress_rows_over_batches(spark):
    batches = [
        [vehicle("A", 0, 0), vehicle("A", 1, 1)],
        [vehicle("A", 10, 2)],
        [vehicle("A", 100, 3)],
        [vehicle("A", 101, 4)],
    ]
    found = jobs.trip_status(line_stream(spark, batches), timeout_ms=10**13)
    got = trip_rows(run_available_now(found, "t"), "endMileage", "isTripEnded")
    assert got == [
        (0, "A", 0, 1, 1, False),
        (1, "A", 0, 10, 2, False),
        (2, "A", 0, 10, 2, True),
        (3, "A", 100, 101, 4, False),
    ]


@pytest.mark.parametrize("pre_aggregate", [True, False])
def test_batches_in_order_give_the_plain_split(spark, pre_aggregate):
    """With a timeout out of reach only gaps split, in however many batches the rows come."""
    rng = random.Random(7)
    times = {vin: sorted(rng.sample(range(0, 3000), n)) for vin, n in {"A": 120, "B": 40}.items()}
    cuts = [0, 700, 1400, 1401, 2200, 3000]
    batches = [
        [vehicle(v, t, t) for v, ts in times.items() for t in ts if a <= t < b]
        for a, b in zip(cuts, cuts[1:])
    ]
    found = jobs.trips(line_stream(spark, batches), timeout_ms=10**13, pre_aggregate=pre_aggregate)
    got = trip_rows(run_available_now(found, "t"), "startMileage", "endMileage")
    expected = [(v, p[0], p[-1], p[0], p[-1]) for v, ts in times.items() for p in split_by_gaps(ts, 30)[:-1]]
    assert sorted(r[1:] for r in got) == sorted(expected)


def test_state_survives_a_restart(spark):
    folder, data = tempfile.mkdtemp(prefix="restart-"), tempfile.mkdtemp(prefix="restart-")
    run = lambda: run_available_now(jobs.trips(text_stream(spark, data, 1), timeout_ms=10**13), "t", folder=folder)
    write_files(data, [[vehicle("A", 0, 1)]])
    assert trip_rows(run()) == []
    write_files(data, [[vehicle("A", 5, 2)], [vehicle("A", 50, 3)]], first=1)
    assert [r[1:] for r in trip_rows(run(), "endMileage")] == [("A", 0, 5, 2)]


def clock(second):
    """Wall clock eight hours ahead of UTC."""
    return (datetime.fromtimestamp(BASE_S + second, timezone.utc) + timedelta(hours=8)).strftime("%Y-%m-%d %H:%M:%S")


def station(second):
    return f"{{'station_id':'S','data_time':'{clock(second)}'}}"


def test_station_messages(spark):
    found = jobs.station_messages(line_stream(spark, [[station(s) for s in (0, 10, 50, 60)]]))
    result = run_available_now(found, "s")

    def message(start, end, status):
        return f'{{"stationId":"S","startTime":{start},"endTime":{end},"status":{status}}}'

    assert rows(result.select("batch_id", "key", "value")) == [
        (0, "S", message(ms(50), ms(10), "true")),
        (0, "S", message(ms(50), ms(60), "false")),
        # the timeout takes its start from the watermark, five minutes behind
        (1, "S", message(ms(-240), ms(60), "true")),
    ]


def user(name, kind, second):
    return f"{{'userId':'{name}','eventType':'{kind}','eventTime':'{clock(second)}'}}"


def test_running_counts(spark):
    clicks = [user("1", "login" if i == 29 else "click", i) for i in range(60)]
    result = run_available_now(jobs.counts(line_stream(spark, [clicks[:20], clicks[20:]])), "c")
    assert rows(result.select("batch_id", "userId", "eventType", "eventCount")) == [
        (0, "1", "click", 20),
        (1, "1", "click", 59),
        (1, "1", "login", 1),
    ]
    newest = sinks.latest(result, ["userId", "eventType"])
    assert rows(newest) == [("1", "click", 59), ("1", "login", 1)]


@pytest.mark.parametrize("pre_aggregate", [True, False])
def test_expiring_counts_restart(spark, pre_aggregate):
    bad_time = "{'userId':'1','eventType':'click','eventTime':'?'}"
    batches = [
        [user("1", "click", 0), user("1", "click", 0), bad_time, user("2", "click", 0)],
        [user("1", "click", 1), user("2", "click", 400)],
        [user("2", "click", 401)],
        [user("1", "click", 402)],
    ]
    found = jobs.expiring_counts(line_stream(spark, batches), pre_aggregate=pre_aggregate)
    result = run_available_now(found, "c")
    assert rows(result.select("batch_id", "userId", "eventType", "eventCount")) == [
        (0, "1", "click", 3),
        (0, "2", "click", 1),
        (1, "1", "click", 4),
        (1, "2", "click", 2),
        # the watermark is at 100 s: user 1 has expired, without a row, and starts again
        (2, "2", "click", 3),
        (3, "1", "click", 1),
    ]


def login(minute, name="mike"):
    return f'{{"event_time": "2018-01-01T{minute // 60:02d}:{minute % 60:02d}:00", "user_id": "{name}"}}'


def test_spans(spark):
    start = 1514764800000
    batches = [[login(0), login(1), login(5)], [login(45)], [login(200, "eve")]]
    result = run_available_now(jobs.spans(line_stream(spark, batches)), "s")
    columns = ["batch_id", "userId", "startTimestampMs", "endTimestampMs", "durationMs", "expired"]
    eve = start + 200 * 60_000
    assert rows(result.select(*columns)) == [
        (0, "mike", start, start + 300_000, 300_000, False),
        (1, "mike", start, start + 2_700_000, 2_700_000, False),
        (2, "eve", eve, eve, 0, False),
        # a row of eve moves the watermark to 2:20, past 0:45 and half an hour
        (3, "mike", start, start + 2_700_000, 2_700_000, True),
    ]


def test_sessions_close_with_a_batch(spark):
    def event(greet, last, key=1):
        return f"{{'id':{key},'greet':'{greet}','isLast':{str(last).lower()}}}"

    batches = [
        [event("a", False), event("x", False, 2)],
        [event("b", False), event("c", True), event("d", False)],
        [event("e", True)],
    ]
    batches[0].append("{'id':1,'isLast':false}")
    result = run_available_now(jobs.sessions(line_stream(spark, batches)), "s", timeouts=False)
    got = {r["batch_id"]: sorted(e["greet"] or "-" for e in r["userEvents"]) for r in result.collect()}
    assert got == {1: ["-", "a", "b", "c", "d"], 2: ["e"]}


def test_sessions_keep_order_nulls_and_types(spark, tmp_path):
    schema = "id int, seq long, n int, isLast boolean"
    events = [(1, 2, None, False), (1, 1, 7, False), (1, 4, 9, True), (1, 3, None, None)]
    spark.createDataFrame(events, schema).write.json(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).json(f"{tmp_path}/in")
    found = collect.complete_sessions(stream, order="seq", event=["seq", "n"])
    [row] = run_available_now(found, "s", timeouts=False).collect()
    assert [(e["seq"], e["n"]) for e in row["userEvents"]] == [(1, 7), (2, None), (3, None), (4, 9)]


def test_native_trips_append_what_the_watermark_has_passed(spark):
    lines = line_stream(spark, [[vehicle("A", 0, 1), vehicle("A", 30, 2)], [vehicle("A", 61, 3)], [vehicle("A", 1000, 4)]])
    found = native.trips(parsing.valid(parsing.parse_vehicle(lines)), tiebreak="mileage")
    got = trip_rows(run_available_now(found, "n", "append"), "startMileage", "endMileage")
    assert [r[1:] for r in got] == [("A", 0, 30, 1, 2), ("A", 61, 61, 3, 3)]


def test_native_trips_take_late_rows_in(spark):
    lines = line_stream(spark, [[vehicle("A", 0, 1), vehicle("A", 50, 3)], [vehicle("A", 25, 2)], [vehicle("A", 1000, 4)]])
    found = native.trips(parsing.valid(parsing.parse_vehicle(lines)), tiebreak="mileage")
    got = trip_rows(run_available_now(found, "n", "append"), "startMileage", "endMileage")
    assert [r[1:] for r in got] == [("A", 0, 50, 1, 3)]


def test_pre_aggregation_keeps_types_and_counts(spark):
    """Integer keys, several small reductions, rows of a cell in several tasks."""
    df = spark.range(0, 5000, 1, 3).select(
        (F.col("id") % 3).cast("int").alias("k"), F.timestamp_millis(F.col("id") * 7).alias("ts"), F.col("id").alias("m")
    )
    got = cells.as_cells(df, ["k"], "ts", 1000, "5 minutes", "m", "m", pre_aggregate=True)
    plain = df.groupBy("k", F.expr("(m * 7) div 1000").alias("c")).agg(
        F.min("m").alias("m0"), F.max("m").alias("m1"), F.count("*").alias("n")
    )
    named = got.select("k", *[F.col("cell")[i].alias(f) for i, f in enumerate(cells.FIELDS)])
    merged = named.groupBy("k", F.expr("t0 div 1000").alias("c")).agg(F.min("m0"), F.max("m1"), F.sum("n"))
    assert rows(merged) == rows(plain)
    assert got.count() < 120


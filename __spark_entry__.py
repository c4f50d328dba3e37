"""Registered queries over the ``events`` table, and the same questions in SQL.

Users stand for vehicles and stations, ``event_id`` for the odometer and the order of events, a
purchase closes a session. Users pause for hours, so trips are split by gaps of six hours. A query
that parses lines first writes its events as JSON lines.
"""

from __future__ import annotations

import sys
from importlib import import_module
from importlib.util import find_spec
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sessionflow.functions import parsing  # noqa: E402
from sessionflow.functions.envelope import envelope  # noqa: E402
from sessionflow.functions.timeconv import epoch_ms, from_wall_clock  # noqa: E402
from sessionflow.operators import counts, incremental, sessions, spans, stations, trips  # noqa: E402
from sessionflow.plans.ranks import lower_median  # noqa: E402
from sessionflow.sources.lines import text_stream  # noqa: E402
from sessionflow.sources.paced import paced_stream  # noqa: E402
from sessionflow.sources.tables import parquet_stream, parquet_table, zoned  # noqa: E402
from sessionflow.streaming import collect, jobs, late, native, ordered, sinks, stateful, upsert  # noqa: E402
from sessionflow.streaming.runner import run_available_now, run_until_idle, start  # noqa: E402
from sessionflow.workdir import shared_dir  # noqa: E402

#: In front of the line of an error it makes a line that cannot be parsed.
SPOILT = "broken "
GAP_MS = 21_600_000
TRIP = dict(key="user_id", ts="ts", measure="event_id", tiebreak="event_id", gap_ms=GAP_MS)


def entry(spark: SparkSession) -> DataFrame:
    """Trips of all users at the smallest scale."""
    return q_trips(spark, "/root/testdata/sf0.001")


# --- inputs --------------------------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return zoned(parquet_table(spark, f"{sf_dir}/events.parquet"), "ts")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return zoned(parquet_stream(spark, f"{sf_dir}/events.parquet"), "ts")


def _json_lines(events: DataFrame, spoil: bool = False, **fields) -> DataFrame:
    """Events as lines; with ``spoil`` those of errors cannot be parsed."""
    line = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    spoilt = F.concat(F.lit(SPOILT), line)
    bad = F.lit(spoil) & (F.col("event_type") == "error")
    return events.select(F.when(bad, spoilt).otherwise(line).alias("value"))


def _vehicle_lines(events: DataFrame, spoil: bool = False) -> DataFrame:
    return _json_lines(
        events,
        spoil,
        vin=F.col("user_id").cast("string"),
        createTime=epoch_ms("ts").cast("string"),
        mileage=F.col("event_id"),
    )


def _wall_clock(ts: str = "ts"):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def _user_lines(events: DataFrame, spoil: bool = False) -> DataFrame:
    return _json_lines(
        events,
        spoil,
        userId=F.col("user_id").cast("string"),
        eventType=F.col("event_type"),
        eventTime=_wall_clock(),
    )


def _station_lines(events: DataFrame, spoil: bool = False) -> DataFrame:
    return _json_lines(events, spoil, station_id=F.col("user_id").cast("string"), data_time=_wall_clock())


def _session_lines(events: DataFrame, spoil: bool = False) -> DataFrame:
    return _json_lines(
        events,
        spoil,
        id=F.col("user_id"),
        greet=F.col("event_type"),
        isLast=F.col("event_type") == "purchase",
        seq=F.col("event_id"),
    )


def _login_lines(events: DataFrame, spoil: bool = False) -> DataFrame:
    return _json_lines(
        events,
        spoil,
        event_time=F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"),
        user_id=F.col("user_id").cast("string"),
    )


def _line_stream(spark: SparkSession, lines: DataFrame, name: str) -> DataFrame:
    """Lines written to text files and read as a stream."""
    folder = shared_dir(spark, f"{name}-lines")
    lines.write.text(folder)
    return text_stream(spark, folder)


# --- tables --------------------------------------------------------------------------------------


def q_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.trips(_events(spark, sf_dir), **TRIP)


#: Partitions by time in which a table is added.
PARTS = 3


def q_trips_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of a table that grew by partitions of time, each read once."""
    events = _events(spark, sf_dir)
    folder = shared_dir(spark, "trips-incremental")
    first, last = events.agg(F.min("event_id"), F.max("event_id")).first()
    part = F.floor((F.col("event_id") - first) * PARTS / (last - first + 1))
    for i in range(PARTS):
        incremental.add_partition(events.where(part == i), folder, i, **{n: v for n, v in TRIP.items()})
    return incremental.stored_trips(events, folder, PARTS - 1, "user_id", "event_id")


def q_trip_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.trip_status(_events(spark, sf_dir), **TRIP)


def q_station_outages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations.station_outages(_events(spark, sf_dir), "user_id", "ts", GAP_MS)


def q_outage_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations.outage_ms(q_station_outages(spark, sf_dir)).drop("status")


def q_pv_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.pv_counts(_events(spark, sf_dir), ["user_id", "event_type"])


def q_complete_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sessions.complete_sessions(
        _events(spark, sf_dir),
        "user_id",
        "event_id",
        F.col("event_type") == "purchase",
        ["event_id", "event_type"],
    )
    return _session_text(found, "user_id", "sessionNo")


def _session_text(found: DataFrame, *columns: str) -> DataFrame:
    ids = F.transform("userEvents", lambda e: e["event_id"].cast("string"))
    types = F.transform("userEvents", lambda e: e["event_type"])
    return found.select(
        *columns,
        F.size("userEvents").cast("bigint").alias("n"),
        F.concat_ws(",", ids).alias("event_ids"),
        F.concat_ws(",", types).alias("event_types"),
    )


def q_closed_session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).select("user_id", "event_id", "event_type")
    return sessions.closed_session_events(
        events, "user_id", "event_id", F.col("event_type") == "purchase"
    )


def q_activity_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.activity_span(_events(spark, sf_dir), "user_id", "ts")


def q_activity_span_expiring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.activity_span_expiring(_events(spark, sf_dir), "user_id", "ts")


def q_envelope_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope(_events(spark, sf_dir), "user_id", ["event_id", "user_id", "event_type"])


def q_parse_vehicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = parsing.valid(parsing.parse_vehicle(_vehicle_lines(_events(spark, sf_dir), spoil=True)))
    return good.select("vin", epoch_ms("createTime").alias("create_ms"), "mileage")


def q_parse_user_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = parsing.valid(parsing.parse_user_event(_user_lines(_events(spark, sf_dir), spoil=True)))
    return good.select(epoch_ms("eventTime").alias("event_ms"), "eventType", "userId")


def q_parse_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = parsing.valid(parsing.parse_station(_station_lines(_events(spark, sf_dir), spoil=True)))
    return good.select("stationId", epoch_ms("dataTime").alias("data_ms"))


def q_parse_session_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _session_lines(_events(spark, sf_dir), spoil=True)
    return parsing.valid(parsing.parse_session_event(lines, order="seq"))


def q_parse_login(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = parsing.valid(parsing.parse_login(_login_lines(_events(spark, sf_dir), spoil=True)))
    return good.select(epoch_ms("event_time").alias("event_ms"), "user_id")


def q_read_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["event_id", "user_id", "event_type"]
    lines = envelope(_events(spark, sf_dir), "event_id", columns)
    return parsing.read_json(lines, "event_id BIGINT, user_id BIGINT, event_type STRING")


def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.quarantine(parsing.parse_vehicle(_vehicle_lines(_events(spark, sf_dir), spoil=True)))


def q_local_time_to_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _events(spark, sf_dir).select("event_id", _wall_clock().alias("text"))
    return text.select("event_id", epoch_ms(from_wall_clock("text")).alias("utc_ms"))


# --- streams -------------------------------------------------------------------------------------


def q_stream_trips_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = native.trips(_event_stream(spark, sf_dir), **TRIP)
    return run_available_now(found, "trips-native", "complete").drop("batch_id")


def q_stream_trips_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = native.trips(_event_stream(spark, sf_dir), **TRIP)
    return run_available_now(found, "trips-append", "append").drop("batch_id")


def q_stream_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stateful.trips(_event_stream(spark, sf_dir), **TRIP)
    return run_available_now(found, "trips").drop("batch_id")


def q_stream_trip_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stateful.trip_status(_event_stream(spark, sf_dir), **TRIP)
    return run_available_now(found, "trip-status").drop("batch_id")


def q_stream_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stateful.station_outages(_event_stream(spark, sf_dir), "user_id", "ts", GAP_MS)
    return run_available_now(found, "station").drop("batch_id")


def q_stream_pv_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stateful.pv_counts_expiring(
        _event_stream(spark, sf_dir), ["user_id", "event_type"], "ts"
    )
    return run_available_now(found, "pv-ttl").drop("batch_id")


def q_stream_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = native.pv_counts(_event_stream(spark, sf_dir), ["user_id", "event_type"])
    return run_available_now(found, "pv").drop("batch_id")


def q_stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collect.closed_session_events(
        _event_stream(spark, sf_dir),
        "user_id",
        "event_id",
        F.col("event_type") == "purchase",
        ["event_id", "event_type"],
    )
    events = run_available_now(found, "sessions", timeouts=False)
    return _session_text(collect.listed_sessions(events, "user_id"), "user_id")


def q_stream_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stateful.activity_span(_event_stream(spark, sf_dir), "user_id", "ts")
    return run_available_now(found, "span").drop("batch_id")


# --- many micro-batches --------------------------------------------------------------------------

#: Micro-batches that a paced stream of a whole table makes at least.
BATCHES = 12
#: Fewer where each one rewrites a table.
UPSERT_BATCHES = 4


def _paced_vehicles(spark: SparkSession, sf_dir: str, name: str, backlog: bool = False) -> DataFrame:
    """Vehicle signals of all events, a twelfth of them in a micro-batch; with ``backlog`` the first half from recorded files."""
    events = _events(spark, sf_dir)
    n = events.count()
    folder = shared_dir(spark, f"{name}-lines")
    live, recorded = f"{folder}/live", f"{folder}/recorded"
    half = lower_median(events, "event_id") if backlog else None
    late = F.coalesce(F.col("event_id") > F.lit(half), F.lit(True))
    # live lines are there before recorded ones
    _vehicle_lines(events.where(late)).write.text(live)
    if backlog:
        _vehicle_lines(events.where(~late)).write.text(recorded)
    lines = paced_stream(spark, live, recorded if backlog else (), max_rows=max(-(-n // BATCHES), 1))
    return parsing.valid(parsing.parse_vehicle(lines))


def q_stream_pv_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over many micro-batches: the newest count of each key."""
    events = _events(spark, sf_dir)
    folder = shared_dir(spark, "pv-batches-lines")
    _user_lines(events).write.text(folder)
    lines = paced_stream(spark, folder, max_rows=max(-(-events.count() // BATCHES), 1))
    found = run_until_idle(jobs.counts(lines), "pv-batches")
    return sinks.latest(found, ["userId", "eventType"])


def q_stream_trips_native_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = native.trips(_paced_vehicles(spark, sf_dir, "native-batches"), tiebreak="mileage", gap_ms=GAP_MS)
    return run_until_idle(found, "trips-native-batches", "append").drop("batch_id")


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All signals again, those in time and those that were late: each file but the first goes back to the start."""
    events = _events(spark, sf_dir)
    folder = shared_dir(spark, "late-rows")
    for i in range(4):
        _vehicle_lines(events.where(F.col("event_id") % 4 == i)).write.text(f"{folder}/lines/{i}")
    lines = paced_stream(spark, f"{folder}/lines", max_rows=max(-(-events.count() // 4), 1))
    signals = parsing.valid(parsing.parse_vehicle(lines))
    query = start(late.split(signals, "createTime", 300_000, f"{folder}/out", f"{folder}/checkpoint"), spark)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    in_time = late.in_time(spark, f"{folder}/out", signals.schema)
    missed = late.late_rows(spark, f"{folder}/out", signals.schema).drop("watermark_ms")
    return in_time.unionByName(missed).select("vin", epoch_ms("createTime").alias("create_ms"), "mileage")


def _ordered_trips(spark: SparkSession, sf_dir: str, name: str, backlog: bool = False) -> tuple[DataFrame, DataFrame]:
    """Trips that were closed, and those that the stored state holds."""
    signals = _paced_vehicles(spark, sf_dir, name, backlog)
    folder = shared_dir(spark, name)
    found = ordered.trips(signals, tiebreak="mileage", gap_ms=GAP_MS)
    closed = run_until_idle(found, name, "append", folder).drop("batch_id")
    return closed, ordered.open_trips(spark, f"{folder}/checkpoint")


def q_stream_trips_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed, running = _ordered_trips(spark, sf_dir, "trips-ordered")
    return closed.unionByName(running)


def q_stream_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips over recorded lines and live ones, although the live files are older."""
    closed, running = _ordered_trips(spark, sf_dir, "backlog", backlog=True)
    return closed.unionByName(running)


def q_open_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running trips out of the stored state."""
    return _ordered_trips(spark, sf_dir, "open-trips")[1]


# --- jobs from lines to results ------------------------------------------------------------------


def q_job_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _line_stream(spark, _vehicle_lines(_events(spark, sf_dir)), "trips")
    found = jobs.trips(lines, tiebreak="mileage", gap_ms=GAP_MS)
    return run_available_now(found, "job-trips").drop("batch_id")


def q_job_trip_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _line_stream(spark, _vehicle_lines(_events(spark, sf_dir)), "trip-status")
    found = jobs.trip_status(lines, tiebreak="mileage", gap_ms=GAP_MS)
    return run_available_now(found, "job-trip-status").drop("batch_id")


def q_job_station_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _line_stream(spark, _station_lines(_events(spark, sf_dir)), "station")
    found = jobs.station_messages(lines, gap_ms=GAP_MS)
    return run_available_now(found, "job-station").drop("batch_id")


def q_job_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _line_stream(spark, _user_lines(_events(spark, sf_dir)), "counts")
    return run_available_now(jobs.counts(lines), "job-counts").drop("batch_id")


def q_job_counts_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current count of each key, kept in a table over many micro-batches."""
    events = _events(spark, sf_dir)
    folder = shared_dir(spark, "counts-upsert")
    _user_lines(events).write.text(f"{folder}/lines")
    found = jobs.counts(paced_stream(spark, f"{folder}/lines", max_rows=max(-(-events.count() // UPSERT_BATCHES), 1)))
    query = start(upsert.upsert(found, ["userId", "eventType"], f"{folder}/table", f"{folder}/checkpoint", buckets=8), spark)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return upsert.current(spark, f"{folder}/table", found.schema)


def q_job_expiring_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _line_stream(spark, _user_lines(_events(spark, sf_dir)), "expiring-counts")
    return run_available_now(jobs.expiring_counts(lines), "job-expiring-counts").drop("batch_id")


def q_job_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines carry no order, so only the contents of a session are compared."""
    lines = _line_stream(spark, _session_lines(_events(spark, sf_dir)), "sessions")
    found = run_available_now(jobs.sessions(lines), "job-sessions", timeouts=False)
    greets = F.array_sort(F.transform("userEvents", lambda e: e["greet"]))
    closing = F.filter("userEvents", lambda e: e["isLast"])
    return found.select(
        F.col("userEvents")[0]["id"].alias("id"),
        F.size("userEvents").cast("bigint").alias("n"),
        F.size(closing).cast("bigint").alias("closing"),
        F.concat_ws(",", greets).alias("greets"),
    )


def q_job_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _line_stream(spark, _login_lines(_events(spark, sf_dir)), "spans")
    return run_available_now(jobs.spans(lines), "job-spans").drop("batch_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; the functions above named ``q_`` and the key.

    Queries over training data are added where their subpackage and the pipeline are installed.
    """
    found = {n[2:]: f for n, f in globals().items() if n.startswith("q_")}
    for module in _training_data():
        found |= module.queries()
    return found


def _training_data() -> list:
    names = ["sessionflow.llm", "corpus_pipeline"]
    if any(find_spec(n) is None for n in names):
        return []
    return [import_module("sessionflow.llm.queries"), import_module("corpus_pipeline")]


# --- the same in SQL -----------------------------------------------------------------------------

# One segment per run of rows at most six hours apart. Milliseconds are cut, not rounded.
_SEGMENTS = """
with e as ({source}),
s as (select *, lag(t) over (partition by k order by t, o) as p from e),
f as (select *, sum(case when p is null or t - p > 21600000 then 1 else 0 end)
        over (partition by k order by t, o rows unbounded preceding) as seg from s),
g as (select k, cast(seg as bigint) as seg, min(t) as a, max(t) as b, min(o) as m0, max(o) as m1,
        count(*) as n from f group by k, seg),
h as (select *, max(seg) over (partition by k) as last_seg from g)
"""
_EVENTS = "select user_id as k, epoch_us(ts) // 1000 as t, event_id as o from events"
_GOOD = "from events where event_type <> 'error'"
_SECOND_MS = "epoch_us(date_trunc('second', ts) - interval 8 hours) // 1000"

_TRIP = """a as "tripStartTime", b as "tripEndTime", m0 as "startMileage", m1 as "endMileage",
  (b - a) // 1000 as "tripDuration", m1 - m0 as "tripDistance" """
_NOT_JUST_OPENED = "not (seg = last_seg and seg > 1 and n = 1)"


def _segments(source: str = _EVENTS) -> str:
    return _SEGMENTS.format(source=source)


_TRIPS = f'{_segments()} select k as user_id, {_TRIP}, true as "isTripEnded" from h'
_STATUS = f"""{_segments()}
select k as user_id, {_TRIP}, seg < last_seg as "isTripEnded" from h where {_NOT_JUST_OPENED}"""
_STATION_ROWS = f"""
select k, t as "startTime", p as "endTime", true as status from f where t - p > 21600000
union all select k, a, b, false from h where {_NOT_JUST_OPENED} and seg = last_seg"""
_TIMED_OUT_STATION = """
union all select k, (select max(t) from e) - 300000, b, true from h where seg = last_seg"""
_COUNTS = """select user_id, event_type, count(*) as "eventCount" from events group by 1, 2"""
_CLOSED = """
with c as (
  select user_id, event_id, event_type, cast(coalesce(sum(cast(event_type = 'purchase' as int)) over (
    partition by user_id order by event_id rows between unbounded preceding and 1 preceding), 0)
    as bigint) as seg from events),
d as (select *, bool_or(event_type = 'purchase') over (partition by user_id, seg) as closed from c)
"""
_SESSION_TEXT = """count(*) as n, string_agg(cast(event_id as varchar), ',' order by event_id) as event_ids,
  string_agg(event_type, ',' order by event_id) as event_types"""
_SPAN = """
with e as (select user_id, epoch_us(ts) // 1000 as t from events),
s as (select user_id, min(t) as a, max(t) as b from e group by user_id)
"""
_SPAN_COLUMNS = """user_id, a as "startTimestampMs", b as "endTimestampMs", b - a as "durationMs" """
_SPAN_EXPIRING = f"""{_SPAN} select {_SPAN_COLUMNS}, false as expired from s
union all select {_SPAN_COLUMNS}, true from s
where b + 1800000 < (select max(b) from s) - 3600000"""
_VEHICLE_SOURCE = """select cast(user_id as varchar) as k, epoch_us(ts) // 1000 as t,
  event_id as o from events"""
# a trip is over once the watermark, five minutes behind, has passed its end by more than the gap
_ORDERED = f"""{_segments(_VEHICLE_SOURCE)} select k as vin, {_TRIP},
    b + 21600000 < (select max(b) from h) - 300000 as "isTripEnded" from h"""
_JOB_COUNTS = """select cast(user_id as varchar) as "userId", event_type as "eventType",
  count(*) as "eventCount" from events group by 1, 2"""
_STATION_SOURCE = f"select cast(user_id as varchar) as k, {_SECOND_MS} as t, 0 as o from events"


def oracle_sql() -> dict[str, str]:
    found = _own_sql()
    for module in _training_data():
        found |= module.oracle_sql()
    return found


def _own_sql() -> dict[str, str]:
    return {
        "trips": _TRIPS,
        "trips_incremental": _TRIPS,
        "trip_status": _STATUS,
        "station_outages": f"""{_segments()} select k as user_id, "startTime", "endTime", status
            from ({_STATION_ROWS})""",
        "outage_ms": f"""{_segments()} select k as user_id, t as "startTime", p as "endTime",
            t - p as "outageMs" from f where t - p > 21600000""",
        "pv_counts": _COUNTS,
        "complete_sessions": f"""{_CLOSED} select user_id, seg as "sessionNo", {_SESSION_TEXT}
            from d where closed group by user_id, seg""",
        "closed_session_events": f"""{_CLOSED} select user_id, event_id, event_type,
            seg as "sessionNo" from d where closed""",
        "activity_span": f"{_SPAN} select {_SPAN_COLUMNS}, false as expired from s",
        "activity_span_expiring": _SPAN_EXPIRING,
        "envelope_json": """select cast(user_id as varchar) as "key", cast(to_json(struct_pack(
            event_id := event_id, user_id := user_id, event_type := event_type)) as varchar)
            as "value" from events""",
        "parse_vehicle": f"""select cast(user_id as varchar) as vin, epoch_us(ts) // 1000 as create_ms,
            event_id as mileage {_GOOD}""",
        "parse_user_event": f"""select {_SECOND_MS} as event_ms, event_type as "eventType",
            cast(user_id as varchar) as "userId" {_GOOD}""",
        "parse_station": f"""select cast(user_id as varchar) as "stationId", {_SECOND_MS} as data_ms
            {_GOOD}""",
        "parse_session_event": f"""select cast(user_id as int) as id, event_type as greet,
            event_type = 'purchase' as "isLast", event_id as seq {_GOOD}""",
        "parse_login": f"""select epoch_us(ts) // 1000 as event_ms,
            cast(user_id as varchar) as user_id {_GOOD}""",
        "read_json": "select event_id, user_id, event_type from events",
        "quarantine": """select 'broken {"vin":"' || user_id || '","createTime":"' ||
            epoch_us(ts) // 1000 || '","mileage":' || event_id || '}'
            as "value" from events where event_type = 'error'""",
        "local_time_to_utc": f"select event_id, {_SECOND_MS} as utc_ms from events",
        "stream_trips_native": _TRIPS,
        # a trip is appended once the watermark, five minutes behind, has passed its window
        "stream_trips_append": f"""{_TRIPS} where b + 21600000 <= (select max(b) from h) - 300000""",
        "stream_trips": _TRIPS,
        "stream_trip_status": f"""{_STATUS}
            union all select k, {_TRIP}, true from h where seg = last_seg""",
        "stream_station": f"""{_segments()} select k as user_id, "startTime", "endTime", status
            from ({_STATION_ROWS} {_TIMED_OUT_STATION})""",
        "stream_pv_batches": _JOB_COUNTS,
        "stream_trips_native_batches": f"""{_segments(_VEHICLE_SOURCE)} select k as vin, {_TRIP}, true as "isTripEnded"
            from h where b + 21600000 <= (select max(b) from h) - 300000""",
        "stream_late_rows": """select cast(user_id as varchar) as vin, epoch_us(ts) // 1000 as create_ms,
            event_id as mileage from events""",
        "stream_trips_ordered": _ORDERED,
        "stream_backlog": _ORDERED,
        "open_trips": f"select * from ({_ORDERED}) where not \"isTripEnded\"",
        "stream_pv_ttl": _COUNTS,
        "stream_pv": _COUNTS,
        "stream_sessions": f"""select user_id, {_SESSION_TEXT} from events group by user_id
            having bool_or(event_type = 'purchase')""",
        "stream_span": _SPAN_EXPIRING,
        "job_trips": f"""{_segments(_VEHICLE_SOURCE)} select k as vin, {_TRIP}, true as "isTripEnded"
            from h""",
        "job_trip_status": f"""{_segments(_VEHICLE_SOURCE)}
            select k as vin, {_TRIP}, seg < last_seg as "isTripEnded" from h where {_NOT_JUST_OPENED}
            union all select k, {_TRIP}, true from h where seg = last_seg""",
        "job_station_messages": f"""{_segments(_STATION_SOURCE)}
            select k as "key", cast(to_json(struct_pack("stationId" := k, "startTime" := "startTime",
            "endTime" := "endTime", status := status)) as varchar) as "value"
            from ({_STATION_ROWS} {_TIMED_OUT_STATION})""",
        "job_counts": _JOB_COUNTS,
        "job_counts_upsert": _JOB_COUNTS,
        "job_expiring_counts": _JOB_COUNTS,
        "job_sessions": """select cast(user_id as int) as id, count(*) as n,
            count(*) filter (event_type = 'purchase') as closing,
            string_agg(event_type, ',' order by event_type) as greets from events group by user_id
            having bool_or(event_type = 'purchase')""",
        "job_spans": """with e as (select cast(user_id as varchar) as u, epoch_us(ts) // 1000 as t
            from events), s as (select u, min(t) as a, max(t) as b from e group by u),
            r as (select u, a, b, false as expired from s union all select u, a, b, true from s
            where b + 1800000 < (select max(b) from s) - 3600000)
            select u as "userId", a as "startTimestampMs", b as "endTimestampMs",
            b - a as "durationMs", expired from r""",
    }

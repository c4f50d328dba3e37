"""The complete jobs: lines of JSON in, sessions out.

Each job turns a stream of lines into its result; ``start_on_console`` runs it with the output
mode, trigger and query name the job is meant for. Any other sink of ``streaming.sinks`` takes the
same result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sessionflow import defaults
from sessionflow.functions import parsing
from sessionflow.functions.envelope import envelope
from sessionflow.streaming import collect, native, runner, sinks, stateful


@dataclass(frozen=True)
class Job:
    plan: Callable[..., DataFrame]
    trigger: dict = field(default_factory=dict)
    name: str | None = None
    truncate: bool = False

    def __call__(self, lines: DataFrame, **options) -> DataFrame:
        return self.plan(lines, **options)


def _trips(lines: DataFrame, **options) -> DataFrame:
    return stateful.trips(parsing.valid(parsing.parse_vehicle(lines)), **options)


def _trip_status(lines: DataFrame, **options) -> DataFrame:
    return stateful.trip_status(parsing.valid(parsing.parse_vehicle(lines)), **options)


def _station_messages(lines: DataFrame, **options) -> DataFrame:
    events = stateful.station_outages(parsing.valid(parsing.parse_station(lines)), **options)
    return envelope(events, "stationId")


def _expiring_counts(lines: DataFrame, **options) -> DataFrame:
    return stateful.pv_counts_expiring(parsing.valid(parsing.parse_user_event(lines)), **options)


def _counts(lines: DataFrame, **options) -> DataFrame:
    return native.pv_counts(parsing.valid(parsing.parse_user_event(lines)), **options)


def _sessions(lines: DataFrame, **options) -> DataFrame:
    events = parsing.valid(parsing.parse_session_event(lines))
    return collect.complete_sessions(events, **options).select("userEvents")


def _spans(lines: DataFrame, **options) -> DataFrame:
    spans = stateful.activity_span(parsing.valid(parsing.parse_login(lines)), **options)
    return spans.withColumnRenamed("user_id", "userId")


trips = Job(_trips)
trip_status = Job(_trip_status, {"processingTime": defaults.TRIP_STATUS_TRIGGER})
station_messages = Job(
    _station_messages,
    {"processingTime": defaults.STATION_TRIGGER},
    defaults.STATION_QUERY_NAME,
)
expiring_counts = Job(_expiring_counts)
counts = Job(_counts)
sessions = Job(_sessions)
spans = Job(_spans, name=defaults.SPAN_QUERY_NAME, truncate=True)


def start_on_console(job: Job, lines: DataFrame, checkpoint: str, **options) -> StreamingQuery:
    result = job(lines, **options)
    writer = sinks.console(
        result, checkpoint, "update", job.trigger or None, job.name, job.truncate
    )
    return runner.start(writer, lines.sparkSession)

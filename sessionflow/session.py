"""A Spark session with the settings these jobs expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(
    app_name: str,
    master: str | None = None,
    checkpoint_location: str | None = None,
    **settings: str,
) -> SparkSession:
    """Times without zone mean UTC, and plans adapt to the sizes they meet.

    ``checkpoint_location`` is the default for all streams of the session. ``settings`` take Spark's
    names with ``__`` for the dots.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if checkpoint_location:
        builder = builder.config("spark.sql.streaming.checkpointLocation", checkpoint_location)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()

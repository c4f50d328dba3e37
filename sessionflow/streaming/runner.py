"""Run a streaming plan over what its source holds now, and hand back the result as a table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from sessionflow.streaming import sinks
from sessionflow.workdir import remove_folder, shared_dir

# State lives in RocksDB, outside the heap of the executors, and checkpoints hold its changes
# instead of a snapshot per micro-batch. Session windows are joined in each task before the
# shuffle, so that a busy key arrives as a few sessions.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings for queries started inside the block; a query keeps what it was started with."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start(
    writer: DataStreamWriter,
    spark: SparkSession,
    timeouts: bool = True,
    settings: dict[str, str] | None = None,
) -> StreamingQuery:
    """Start a query with ``STREAM_SETTINGS``, or others.

    ``timeouts`` lets micro-batches without data run to set off timeouts.
    """
    wanted = STREAM_SETTINGS if settings is None else settings
    with _settings(spark, {**wanted, NO_DATA_BATCHES: str(timeouts).lower()}):
        return writer.start()


def run_available_now(
    df: DataFrame,
    name: str,
    mode: str = "update",
    folder: str | None = None,
    timeouts: bool = True,
) -> DataFrame:
    """Process everything available and read the output back.

    In complete mode, where each micro-batch holds the whole result, that of the last one is read. The
    result has a column ``batch_id``. With the same ``folder`` a later call goes on from the
    checkpoint of the one before. ``timeouts`` lets the watermark set off event-time timeouts at
    the end. Turn it off for processing-time timeouts: they would keep the query waiting for the
    clock for ever.
    """
    spark = df.sparkSession
    temporary = folder is None
    folder = folder or shared_dir(spark, name)
    now = {"availableNow": True}
    writer = sinks.parquet(df, f"{folder}/out", f"{folder}/checkpoint", mode, now)
    start(writer, spark, timeouts).awaitTermination()
    found = sinks.read_batches(spark, f"{folder}/out", df.schema)
    remove_folder(spark, f"{folder}/checkpoint") if temporary else None
    return found.where(F.col("batch_id") == found.agg(F.max("batch_id")).scalar()) if mode == "complete" else found


def run_until_idle(df: DataFrame, name: str, mode: str = "update", folder: str | None = None, timeouts: bool = True) -> DataFrame:
    """Process micro-batch after micro-batch until the source has nothing new, and read the output back with its ``batch_id``.

    For sources that pace themselves: ``availableNow`` would take all they hold as one micro-batch. With the same ``folder`` a later
    call goes on from the checkpoint of the one before. The checkpoint stays, for ``folder``/checkpoint holds the state.
    """
    spark = df.sparkSession
    folder = folder or shared_dir(spark, name)
    writer = sinks.parquet(df, f"{folder}/out", f"{folder}/checkpoint", mode, {"processingTime": "0 seconds"})
    query = start(writer, spark, timeouts)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return sinks.read_batches(spark, f"{folder}/out", df.schema)

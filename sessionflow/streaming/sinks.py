"""Where streaming results go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from sessionflow.workdir import folder_exists


def console(
    df: DataFrame,
    checkpoint: str | None = None,
    mode: str = "update",
    trigger: dict | None = None,
    name: str | None = None,
    truncate: bool = False,
) -> DataStreamWriter:
    """Print each micro-batch."""
    writer = df.writeStream.format("console").option("truncate", truncate)
    return _configured(writer, checkpoint, mode, trigger, name)


def parquet(
    df: DataFrame,
    out_dir: str,
    checkpoint: str,
    mode: str = "update",
    trigger: dict | None = None,
    name: str | None = None,
) -> DataStreamWriter:
    """Write each micro-batch to a partition ``batch_id`` of ``out_dir``.

    A micro-batch that is run again after a failure replaces its own partition, so a restart leaves
    every row once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    return _configured(df.writeStream.foreachBatch(write), checkpoint, mode, trigger, name)


def kafka(
    messages: DataFrame,
    topic: str,
    servers: str,
    checkpoint: str,
    mode: str = "update",
    trigger: dict | None = None,
    name: str | None = None,
) -> DataStreamWriter:
    """Send an envelope (``key``, ``value``) to Kafka; needs Spark's Kafka package."""
    writer = (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
    )
    return _configured(writer, checkpoint, mode, trigger, name)


def _configured(
    writer: DataStreamWriter,
    checkpoint: str | None,
    mode: str,
    trigger: dict | None,
    name: str | None,
) -> DataStreamWriter:
    writer = writer.outputMode(mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**trigger) if trigger else writer


def read_batches(spark, out_dir: str, schema: T.StructType) -> DataFrame:
    """What ``parquet`` has written so far, with the ``batch_id`` of each row; nothing at first."""
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    if not folder_exists(spark, out_dir):  # no micro-batch has run
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(out_dir)


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped because they were older than the watermark, over the recent micro-batches.

    ``LateRows`` counts over all of them.
    """
    return sum(
        int(op.get("numRowsDroppedByWatermark", 0))
        for progress in query.recentProgress
        for op in progress["stateOperators"]
    )


class LateRows(StreamingQueryListener):
    """Adds up the late rows of all queries it hears of: ``spark.streams.addListener(LateRows())``."""

    def __init__(self) -> None:
        self.total = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.total += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def latest(batches: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row of each key, as updates to a running value leave several."""
    rest = [c for c in batches.columns if c not in [*keys, "batch_id"]]
    newest = batches.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_row"))
    return newest.select(*keys, "_row.*")

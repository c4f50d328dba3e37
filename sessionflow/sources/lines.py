"""Sources of text lines: one column ``value``, as a table or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sessionflow import defaults


def text_table(spark: SparkSession, path: str) -> DataFrame:
    """Recorded lines as a table."""
    return spark.read.text(path)


def text_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Recorded lines as a stream; new files in the folder follow.

    ``max_files_per_trigger`` bounds a micro-batch.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def socket_options(host: str = defaults.SOCKET_HOST, port: int = defaults.SOCKET_PORT) -> dict[str, str]:
    return {"host": host, "port": str(port)}


def socket_stream(
    spark: SparkSession, host: str = defaults.SOCKET_HOST, port: int = defaults.SOCKET_PORT
) -> DataFrame:
    """Lines sent by a server. For trials only: a socket cannot be read again after a failure."""
    return spark.readStream.format("socket").options(**socket_options(host, port)).load()


def kafka_options(
    servers: str = defaults.KAFKA_SERVERS,
    topic: str = defaults.KAFKA_TOPIC,
    starting_offsets: str = defaults.KAFKA_STARTING_OFFSETS,
    max_offsets_per_trigger: int = defaults.KAFKA_MAX_OFFSETS_PER_TRIGGER,
    fail_on_data_loss: bool = defaults.KAFKA_FAIL_ON_DATA_LOSS,
    max_request_size: int = defaults.KAFKA_MAX_REQUEST_SIZE,
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": str(max_offsets_per_trigger),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "kafka.max.request.size": str(max_request_size),
    }


def kafka_stream(spark: SparkSession, **options) -> DataFrame:
    """Message values of a topic as text; needs Spark's Kafka package."""
    stream = spark.readStream.format("kafka").options(**kafka_options(**options)).load()
    return stream.selectExpr("cast(value as string) as value")


def with_backlog(
    spark: SparkSession, recorded: str, live: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Lines of a folder of recorded files, and after them those of a folder that live files come to.

    Both are folders of one parent and one source: files are taken by their age, so recorded ones, which
    are older, are read before live ones move the watermark.
    """
    parent, _, first = recorded.rstrip("/").rpartition("/")
    other, _, second = live.rstrip("/").rpartition("/")
    if parent != other:
        raise ValueError("recorded and live files need folders side by side")
    return text_stream(spark, f"{parent}/{{{first},{second}}}", max_files_per_trigger)

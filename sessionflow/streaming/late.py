"""Late rows as an output of their own.

Spark drops rows that are older than the watermark ahead of event-time state and only counts them. Here a stream is split
before: each micro-batch is written as rows in time and late ones, the latter with the watermark they missed. The watermark is the
one Spark would use: the newest time of all earlier micro-batches less the delay. It is kept beside the rows of each micro-batch, so that a micro-batch
which is run again is split as before. Rows in time can be read as a stream again, and none of them is late there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from sessionflow.sources.tables import parquet_stream
from sessionflow.workdir import folder_exists

_IN_TIME, _LATE, _MARKS = "in-time", "late", "marks"


def split(df: DataFrame, ts: str, delay_ms: int, out_dir: str, checkpoint: str, trigger: dict | None = None) -> DataStreamWriter:
    """Write the rows of a stream below ``out_dir`` as ``in-time`` and ``late`` ones. Rows without a time are in time."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = _mark(spark, out_dir, batch_id - 1)
        batch = batch.persist()
        try:
            late = F.coalesce(F.unix_micros(ts) <= F.lit(mark).cast("bigint") * 1000, F.lit(False))
            batch.where(~late).write.mode("overwrite").parquet(f"{out_dir}/{_IN_TIME}/batch_id={batch_id}")
            missed = batch.where(late).withColumn("watermark_ms", F.lit(mark).cast("bigint"))
            missed.write.mode("overwrite").parquet(f"{out_dir}/{_LATE}/batch_id={batch_id}")
            reached = F.greatest(F.max(F.unix_millis(ts)) - delay_ms, F.lit(mark).cast("bigint"))
            marked = batch.agg(reached.alias("watermark_ms"))
            marked.coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/{_MARKS}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger) if trigger else writer


def _mark(spark: SparkSession, out_dir: str, batch_id: int) -> int | None:
    """The watermark after a micro-batch."""
    folder = f"{out_dir}/{_MARKS}/batch_id={batch_id}"
    if not folder_exists(spark, folder):
        return None
    return spark.read.schema("watermark_ms long").parquet(folder).first()[0]


def in_time(spark: SparkSession, out_dir: str, schema: T.StructType) -> DataFrame:
    """All rows that were in time, with their ``batch_id``."""
    return _table(spark, f"{out_dir}/{_IN_TIME}", schema)


def late_rows(spark: SparkSession, out_dir: str, schema: T.StructType) -> DataFrame:
    """All rows that were late, with the watermark they missed and their ``batch_id``."""
    return _table(spark, f"{out_dir}/{_LATE}", T.StructType([*schema.fields, T.StructField("watermark_ms", T.LongType())]))


def _table(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(full).parquet(folder) if folder_exists(spark, folder) else spark.createDataFrame([], full)


def in_time_stream(spark: SparkSession, out_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The rows in time as a stream."""
    return parquet_stream(spark, f"{out_dir}/{_IN_TIME}", max_files_per_trigger)

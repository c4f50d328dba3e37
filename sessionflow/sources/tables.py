"""Typed rows from tables in files, as a table or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def parquet_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The files of a table as a stream, with the columns they have now.

    ``path`` is a folder of files or one file. The stream reader takes a plain path for a folder,
    so the name is given as a pattern that only it matches.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{parent}/{{{name}}}")


def zoned(df: DataFrame, ts: str) -> DataFrame:
    """Time without zone to an instant, in the zone of the session: watermarks need one."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))

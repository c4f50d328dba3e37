"""How intermediate tables are written: in small Arrow batches, or with the shuffles behind them deleted."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from sessionflow.workdir import write_table

#: Rows of an Arrow batch, where each has kilobytes: both ends of the pipe hold a few batches at a time.
LARGE_ROWS = 500
#: Bytes of an Arrow batch, where rows differ much in size.
SMALL_BYTES = 4 << 20
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting for what is executed inside the block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def small_batches(spark: SparkSession, rows: int = LARGE_ROWS):
    """Arrow batches of at most so many rows for what is executed inside the block."""
    return _set(spark, _ROWS, str(rows))


def light_batches(spark: SparkSession, size: int = SMALL_BYTES):
    """Arrow batches that end with the row that fills so many bytes, for what is executed inside the block."""
    return _set(spark, _BYTES, str(size))


def write_large(df: DataFrame, name: str, rows: int = LARGE_ROWS) -> DataFrame:
    with small_batches(df.sparkSession, rows):
        return write_table(df, name)


def write_step(df: DataFrame, name: str) -> DataFrame:
    """A table whose shuffles are deleted once it is there."""
    with _set(df.sparkSession, _CLEANUP, "true"):
        return write_table(df, name)

"""Folders and tables for intermediate results, where the driver and all executors see them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, the checkpoint folder of the session's streams or a folder below the
    warehouse takes its place. A warehouse on a local disk is refused unless Spark runs on one machine:
    each executor would write to its own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.streaming.checkpointLocation", None
    )
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and _is_local(named):
            raise ValueError(f"set spark.checkpoint.dir: executors do not share {named}")
    return f"{named.rstrip('/')}/sessionflow/{name}-{uuid.uuid4().hex}"


def _is_local(path: str) -> bool:
    return path.startswith(("file:", "/"))


def write_table(df: DataFrame, name: str) -> DataFrame:
    """The rows, written as Parquet to a new shared folder and read back: the lineage is cut there."""
    folder = shared_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder this run has made."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def drop_table(table: DataFrame) -> None:
    """Delete a table of ``write_table`` that no later read needs."""
    folders = {f.rpartition("/")[0] for f in table.inputFiles()}
    for folder in folders:
        remove_folder(table.sparkSession, folder)

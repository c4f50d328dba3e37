"""A table of current values that a stream keeps up to date.

Updates to a running value leave a row for every change. This table holds the newest row of each key only, in
folders by a hash of the key. A micro-batch rewrites the folders of its own keys, into new ones that carry its number, and a
small file names the folders that count. That file is replaced last, so readers see a micro-batch as a whole, and one that is run
again after a failure changes nothing twice.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from sessionflow.workdir import remove_folder

#: Folders of a table. A micro-batch with keys in all of them rewrites the table.
BUCKETS = 64
_NAMES = "current.json"


def upsert(df: DataFrame, keys: list[str], table: str, checkpoint: str, buckets: int = BUCKETS, trigger: dict | None = None) -> DataStreamWriter:
    """Keep the newest row of each key of an update stream in ``table``; of several in a micro-batch the largest one counts."""

    def write(batch: DataFrame, batch_id: int) -> None:
        merge(batch, batch_id, keys, table, buckets)

    writer = df.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger) if trigger else writer


def merge(batch: DataFrame, batch_id: int, keys: list[str], table: str, buckets: int = BUCKETS) -> None:
    """Take the rows of a micro-batch into the table."""
    spark = batch.sparkSession
    held = _names(spark, table)
    if held["batch_id"] >= batch_id:  # run again: this micro-batch is in
        return
    rest = [c for c in batch.columns if c not in keys]
    bucket = F.pmod(F.xxhash64(*keys), F.lit(held["buckets"] or buckets)).cast("int").alias("_bucket")
    fresh = batch.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row")).select(bucket, *keys, "_row.*")
    folder = f"{table}/batch-{batch_id}"
    fresh.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{folder}-new")
    new = spark.read.schema(_with_bucket(batch.schema)).parquet(f"{folder}-new")
    touched = sorted(r[0] for r in new.select("_bucket").distinct().collect())  # as many as there are buckets at most
    old = [held["folders"][str(b)] for b in touched if str(b) in held["folders"]]
    merged = new
    if old:
        before = spark.read.schema(batch.schema).parquet(*old).select(bucket, *batch.columns)
        merged = new.unionByName(before.join(new.select(*keys), _same(before, new, keys), "left_anti"))
    merged.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(folder)
    folders = {**held["folders"], **{str(b): f"{folder}/_bucket={b}" for b in touched}}
    _replace(spark, table, {"batch_id": batch_id, "buckets": held["buckets"] or buckets, "folders": folders})
    for gone in (*old, f"{folder}-new"):
        remove_folder(spark, gone)


def _same(before: DataFrame, new: DataFrame, keys: list[str]):
    same = F.lit(True)
    for k in keys:
        same = same & before[k].eqNullSafe(new[k])
    return same


def _with_bucket(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])


def current(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The newest row of each key."""
    folders = list(_names(spark, table)["folders"].values())
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _file_system(spark: SparkSession, table: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{_NAMES}")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, table: str) -> dict:
    path, system = _file_system(spark, table)
    # a crash between the two steps of a replacement leaves the new file under its other name
    for name in (path, path.suffix(".new")):
        if system.exists(name):
            return json.loads(spark.sparkContext.wholeTextFiles(name.toString()).values().first())
    return {"batch_id": -1, "buckets": 0, "folders": {}}


def _replace(spark: SparkSession, table: str, names: dict) -> None:
    path, system = _file_system(spark, table)
    fresh = path.suffix(".new")
    out = system.create(fresh, True)
    try:
        out.write(bytearray(json.dumps(names).encode()))
    finally:
        out.close()
    system.delete(path, False)
    if not system.rename(fresh, path):
        raise OSError(f"cannot replace {path.toString()}")

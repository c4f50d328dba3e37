"""Trips and outages of a table that grows by partitions, such as days.

A stored result has the islands that are over (``closed``, one folder for each partition added) and the last island of each key
(``open``), the only one that later rows can continue. Adding a partition reduces its rows alone, joins the first new island of a key to
the stored one where no gap lies between, and writes what is over now and what is last now. Neither earlier rows nor earlier
islands are read. Partitions are added in the order of time; a row that is not later than the end of its key's last island is refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionflow.functions.timeconv import time_ms
from sessionflow.operators.trips import trip_columns
from sessionflow.plans.islands import islands, key_list
from sessionflow.workdir import folder_exists

_FIELDS = ["start_ms", "end_ms", "n", "prev_end_ms", "first_value", "last_value"]


def _schema(keys: list[str], df: DataFrame, measure: str) -> T.StructType:
    longs = [T.StructField(c, T.LongType()) for c in _FIELDS[:4]]
    values = [T.StructField(c, df.schema[measure].dataType) for c in _FIELDS[4:]]
    return T.StructType([*[df.schema[k] for k in keys], *longs, *values])


def add_partition(
    df: DataFrame,
    folder: str,
    number: int,
    key: str | Sequence[str] = "vin",
    ts: str = "createTime",
    measure: str = "mileage",
    tiebreak: str | None = None,
    gap_ms: int = 30_000,
) -> None:
    """Take the rows of partition ``number`` (from 0, one by one) into the stored islands. Adding it again replaces it."""
    spark, keys = df.sparkSession, key_list(key)
    schema = _schema(keys, df, measure)
    fresh = islands(df, keys, time_ms(df, ts), gap_ms, measure, tiebreak)
    first = F.col("prev_end_ms").isNull()
    before = _read(spark, f"{folder}/open/part={number - 1}", schema)
    # the stored island of a key meets the first new one
    stored = before.select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct(*_FIELDS).alias("_stored"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = fresh.withColumn("_first", first).join(stored, same & F.col("_first"), "full_outer")
    new, old = F.col("start_ms").isNotNull(), F.col("_stored").isNotNull()
    late = new & old & (F.col("start_ms") <= F.col("_stored.end_ms"))
    meets = F.coalesce(new & old & (F.col("start_ms") - F.col("_stored.end_ms") <= gap_ms), F.lit(False))
    own = F.struct(*_FIELDS[:3], F.when(old, F.col("_stored.end_ms")).otherwise(F.col("prev_end_ms")).alias("prev_end_ms"), *_FIELDS[4:])
    both = F.struct(
        F.col("_stored.start_ms").alias("start_ms"),
        F.col("end_ms"),
        (F.col("n") + F.col("_stored.n")).alias("n"),
        F.col("_stored.prev_end_ms").alias("prev_end_ms"),
        F.col("_stored.first_value").alias("first_value"),
        F.col("last_value"),
    )
    refused = F.raise_error(F.lit("a partition begins before the stored islands end"))
    found = F.when(late, F.array(_with_last(refused.cast("boolean"), own))).when(meets, F.array(_with_last(F.col("is_last"), both)))
    found = found.when(new & old, F.array(_with_last(F.lit(False), F.col("_stored")), _with_last(F.col("is_last"), own)))
    found = found.when(new, F.array(_with_last(F.col("is_last"), own))).otherwise(F.array(_with_last(F.lit(True), F.col("_stored"))))
    named = [F.coalesce(F.col(k), F.col(f"_{k}")).alias(k) for k in keys]
    result = joined.select(*named, F.explode(found).alias("_i")).select(*keys, "_i.island.*", "_i.last").persist()
    try:
        for kind, part in (("closed", ~F.col("last")), ("open", F.col("last"))):
            rows = result.where(part).select(*[F.col(f.name).cast(f.dataType) for f in schema])
            rows.write.mode("overwrite").parquet(f"{folder}/{kind}/part={number}")
    finally:
        result.unpersist()


def _with_last(last: Column, island: Column) -> Column:
    return F.struct(island.alias("island"), last.alias("last"))


def _read(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(folder) if folder_exists(spark, folder) else spark.createDataFrame([], schema)


def stored_islands(spark: SparkSession, folder: str, number: int, schema: T.StructType) -> DataFrame:
    """All islands up to partition ``number``, with ``is_last``."""
    closed = spark.read.schema(schema).parquet(*[f"{folder}/closed/part={i}" for i in range(number + 1)])
    last = spark.read.schema(schema).parquet(f"{folder}/open/part={number}")
    return closed.withColumn("is_last", F.lit(False)).unionByName(last.withColumn("is_last", F.lit(True)))


def stored_trips(df: DataFrame, folder: str, number: int, key: str | Sequence[str] = "vin", measure: str = "mileage") -> DataFrame:
    """The trips up to partition ``number``; ``df`` gives the types of keys and measure."""
    keys = key_list(key)
    found = stored_islands(df.sparkSession, folder, number, _schema(keys, df, measure))
    return found.select(*keys, *trip_columns(F.lit(True)))

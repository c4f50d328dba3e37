"""Sharding by jump consistent hashing: a stable key finds its shard without a ring or a table.

The shard of a row follows from the hash of its id and the number of shards alone. From shard count to shard
count a key either stays or jumps into the newest shard, so that one more shard takes rows only into itself,
about one in ``shards + 1``. Within a shard rows stand in the order of their hashes and get slots without
gaps: the hashes are cut into chunks of bounded size, rows are numbered inside their chunk, and sums over
the chunks before give the first slot of each. Texts are shuffled once and nothing is sorted as a whole.

A histogram over the leading bits of the hashes shows where one id, however many rows it has, would fill a
chunk. Such rows are dealt out over several parts of the chunk, by their place in the input.

Defined results: a null id counts as an empty one and has a shard; rows of equal id share a shard and
have slots of their own, ordered by size and checksum of the text; a null text has no bytes and the checksum
of an empty one; an empty table gives an empty result; other columns pass through, but one with the name of
an added column is replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionflow.llm.mixing import HASH_BITS, id_hash
from sessionflow.workdir import write_table

_ADDED = ["shard_hash", "shard_no", "shard_grown", "shard_slot", "shard_size", "shard_crc32"]
#: Rows that a chunk holds about; a hash prefix with more is dealt out over parts.
CHUNK_ROWS = 1 << 13
#: Leading bits of the hash in the histogram: it has at most a million rows, whatever the corpus.
PREFIX_BITS = 20
#: First slots of so many parts at most are sent to all tasks; beyond that they are joined by a shuffle.
SMALL_ROWS = 1 << 20
#: Bytes that a row takes besides its text.
ROW_BYTES = 8


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key: jumps from shard to shard until the next one lies beyond the last."""
    key = keys.astype(np.uint64)
    found = np.zeros(len(key), dtype=np.int64)
    after = np.zeros(len(key), dtype=np.int64)
    moving = np.arange(len(key))
    while len(moving):
        found[moving] = after[moving]
        key[moving] = key[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((key[moving] >> np.uint64(33)).astype(np.float64) + 1.0)
        after[moving] = ((found[moving] + 1) * step).astype(np.int64)
        moving = moving[after[moving] < shards]
    return found


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a 64-bit key."""

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(dtype=np.int64), shards).astype(np.int32))

    return place(key)


def shard_rows(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with ``shard_no``, ``shard_slot`` (from 0 within the shard), ``shard_grown`` (the shard
    if there were one more), ``shard_size`` (bytes), ``shard_crc32`` and ``shard_hash``, by which a shard is ordered."""
    docs = docs.drop(*_ADDED)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    placed = (
        docs.withColumn("shard_hash", id_hash(id_col))
        .withColumn("shard_no", shard_of(F.col("shard_hash"), shards))
        .withColumn("shard_grown", shard_of(F.col("shard_hash"), shards + 1))
        .withColumn("shard_size", F.octet_length(text).cast("bigint") + ROW_BYTES)
        .withColumn("shard_crc32", F.crc32(text))
    )
    hashes = docs.select(id_hash(id_col).alias("hash"))
    counts = write_table(hashes.groupBy(_prefix("hash").alias("prefix")).agg(F.count("*").alias("n")), "shard-prefixes")
    total = counts.agg(F.sum("n")).first()[0] or 0
    chunks = min(max(math.ceil(total / shards / CHUNK_ROWS), 1), 1 << PREFIX_BITS)
    full = counts.where(F.col("n") > max(CHUNK_ROWS, 16 * total >> PREFIX_BITS))
    full = full.select(F.struct("prefix", F.ceil(F.col("n") / CHUNK_ROWS).alias("parts")).alias("_shard_at"))
    parted = placed.join(F.broadcast(full), _prefix("shard_hash") == F.col("_shard_at.prefix"), "left")
    chunk = F.shiftright(_prefix("shard_hash") * chunks, PREFIX_BITS)
    part = F.pmod(F.monotonically_increasing_id(), F.coalesce("_shard_at.parts", F.lit(1)))
    parted = parted.withColumn("_shard_at", F.struct(chunk.alias("chunk"), part.alias("part")))
    inside = Window.partitionBy("shard_no", "_shard_at").orderBy("shard_hash", "shard_size", "shard_crc32")
    local = write_table(parted.withColumn("shard_slot", F.row_number().over(inside).cast("bigint") - 1), "shards")
    firsts = local.groupBy("shard_no", "_shard_at").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("shard_no").orderBy("_shard_at"))
    firsts = write_table(firsts.select(F.struct("shard_no", "_shard_at", (upto - F.col("n")).alias("slot")).alias("_shard_first")), "shard-slots")
    hint = F.broadcast if firsts.count() <= SMALL_ROWS else (lambda df: df)
    same = (F.col("shard_no") == F.col("_shard_first.shard_no")) & (F.col("_shard_at") == F.col("_shard_first._shard_at"))
    joined = local.join(hint(firsts), same)
    return joined.withColumn("shard_slot", F.col("shard_slot") + F.col("_shard_first.slot")).drop("_shard_at", "_shard_first")


def _prefix(name: str) -> Column:
    return F.shiftright(name, HASH_BITS - PREFIX_BITS)


def write_shards(sharded: DataFrame, folder: str) -> DataFrame:
    """Write a folder for each shard, rows in slot order within a file; gives ``shard_no, rows, bytes`` of each."""
    held = sharded.sortWithinPartitions("shard_no", "shard_slot")
    held.write.partitionBy("shard_no").parquet(folder)
    written = sharded.sparkSession.read.parquet(folder)
    return written.groupBy("shard_no").agg(F.count("*").alias("rows"), F.sum("shard_size").alias("bytes"))

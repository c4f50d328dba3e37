"""Bounded samples of labelled documents for fitting classifiers on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of an id as text, modulo a divisor; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % divisor


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int, usable: Column | None = None) -> DataFrame:
    """``text, label`` of at most ``limit`` labelled documents, chosen by a hash of their ids.

    The chosen labels are few enough by ``limit`` to be sent to all tasks. Null labels are left out; of
    several labels of a document one counts, the largest.
    """
    rows = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if usable is not None:
        rows = rows.where(usable)
    chosen = rows.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "label")

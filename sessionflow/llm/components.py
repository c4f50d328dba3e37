"""Connected components of a graph given by its links, by rounds of star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.workdir import drop_table, write_table


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every id in the links ``a, b``: the smallest id that is reachable.

    Each round hangs the larger neighbours of every node onto its smallest neighbour, then the smaller
    ones, until every node hangs onto the smallest one of its component. A round writes its links to the
    shared folder, so a lost executor costs one round at most.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = write_table(edges, "links")
    seen = _mark(edges)
    while True:
        contracted = write_table(_small_star(_large_star(edges)), "links")
        drop_table(edges)
        edges, before, seen = contracted, seen, _mark(contracted)
        if before == seen:
            break
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots).distinct()


def _mark(edges: DataFrame) -> tuple:
    mark = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(mark), F.sum(F.shiftright(mark, 20))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    lower = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return lower.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()

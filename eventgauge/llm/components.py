"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventgauge.llm.shared import cell, stored, told


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """u, root for every node of an edge (u, v) that is not itself the root; roots are the least.

    A star moves only edges, one row each, so no neighbourhood is gathered; the edges of one node
    learn its least neighbour in salted cells.  Every round is
    stored; the loop ends when a round changes nothing.
    """
    current = stored(_downward(edges), "edges")
    before = _state(current)
    for _ in range(rounds):
        if not before[0]:
            break
        # Each star reads its edges several times, so the first is stored for the second.
        current = stored(_small(stored(_large(current), "edges")), "edges")
        after = _state(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("the components did not settle")
    return current.select("u", F.col("v").alias("root"))


def _downward(edges: DataFrame) -> DataFrame:
    return edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    upward = both.filter("v > u").withColumn("cell", cell("v"))
    return _downward(told(upward, least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = told(edges.withColumn("cell", cell("v")), least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _downward(moved.unionByName(least.select("u", F.col("m").alias("v"))))

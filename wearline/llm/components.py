"""Connected components of an edge table: a distributed union-find.

Large-star and small-star rounds alternate (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014). Each connects neighbours to the
least node known around them and keeps the components as they are; after about
log(n) rounds every node hangs directly on the least node of its component. A
round is one aggregate and one join on node ids, and its result is a written
table, so lineage stays short and no node's neighbours are gathered in one place;
the tables of the round before are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.workspace import discard, settle


def _state(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = settle(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    moved = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    found = settle(moved.distinct(), "large-star")
    discard(least)
    return found


def _small_star(edges: DataFrame) -> DataFrame:
    least = settle(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    found = settle(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
    discard(least, edges)
    return found


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) of every node on an edge ``a``, ``b``."""
    down = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = settle(down.distinct(), "edges")
    state = _state(current)
    while state[0]:
        last, current = current, _small_star(_large_star(current))
        discard(last)
        before, state = state, _state(current)
        if before == state:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
